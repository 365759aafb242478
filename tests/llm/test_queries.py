"""Registered queries: names, SQL where it exists, and the pipeline against brute force."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

import corpus_pipeline as C  # noqa: E402
from check_oracles import compare, duck  # noqa: E402
from tripkpi.llm import byte_convnet, queries as Q, source_mix  # noqa: E402
from tripkpi.llm.tables import staged, table  # noqa: E402

import __spark_entry__ as E  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in Q.QUERIES) == list(range(1, 14))
    assert set(Q.QUERIES) | {"pipeline"} <= set(E.queries()) and set(Q.ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, sf_small, name):
    assert compare(Q.QUERIES[name](spark, sf_small).toArrow(), duck(sf_small).sql(Q.ORACLES[name]).to_arrow_table()) is None


def test_pipeline_stage_by_stage(spark, sf_small):
    from test_decontaminate import brute as hits
    from test_minhash_hamming import brute as components

    docs = table(spark, sf_small, "documents")
    columns = docs.columns
    seen = []
    for name, stage in C.STAGES:
        before = docs
        docs = staged(stage(spark, before, sf_small), "test-pipeline")
        seen.append(name)
        b, a = before.toPandas(), docs.toPandas()
        if name != "sharding":
            assert docs.columns == columns
        if name == "quality_classifier":
            scores = byte_convnet.quality(before, table(spark, sf_small, "labels")).toPandas()
            assert set(a.doc_id) == set(scores.doc_id[scores.score >= 0.3])
        elif name == "minhash_near_dedup":
            comp = components(list(zip(b.doc_id, b.text)), percent=C.NEAR_PERCENT)
            assert sorted(a.doc_id) == sorted(i for i, c in comp.items() if i == c)
        elif name == "benchmark_decontamination":
            items = table(spark, sf_small, "benchmark").toPandas()
            found = hits(list(zip(b.doc_id, b.text)), list(zip(items.item_id, items.text)))
            was = dict(zip(b.doc_id, b.text))
            now = dict(zip(a.doc_id, a.text))
            for doc_id, (n, mask, _) in found.items():
                if not any(mask):
                    assert now[doc_id] == was[doc_id]
                elif all(mask):
                    assert doc_id not in now
                else:
                    assert len(now[doc_id]) < len(was[doc_id])
        elif name == "source_mix":
            size = {}
            for i, s, t in zip(b.doc_id, b.source, b.text):
                size.setdefault(s, {})[i] = len(WORD.findall(t or ""))
            goal = source_mix.targets([sum(size[s].values()) for s in sorted(size)],
                                      [(5.0, 2.0, 1.0)[k % 3] for k in range(len(size))])
            for s, g in zip(sorted(size), goal):
                taken = {}
                for i, t in zip(a.doc_id[a.source == s], a.text[a.source == s]):
                    taken[i] = taken.get(i, 0) + len(WORD.findall(t))
                assert abs(sum(taken.values()) - g) <= 1
                assert all(taken[i] <= 2 * size[s][i] for i in taken)
        else:
            assert len(a) == len(b) and set(a["shard"]) <= set(range(40))
            for _, part in a.groupby("shard"):
                assert sorted(part["slot"]) == list(range(len(part)))
    assert seen == [n for n, _ in C.STAGES] and len(seen) == 5


def test_pipeline_on_odd_documents(spark, odd, sf_small):
    docs = odd
    for _, stage in C.STAGES[1:]:
        docs = staged(stage(spark, docs, sf_small), "test-odd")
    assert docs.count() > 0
    empty = odd.limit(0)
    for _, stage in C.STAGES:
        empty = staged(stage(spark, empty, sf_small), "test-empty")
    assert empty.count() == 0

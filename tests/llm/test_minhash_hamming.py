import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripkpi.llm import minhash_hamming as M
from tripkpi.llm.components import components

LOW = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows, percent=85):
    """doc_id -> (set sizes, component) by comparing all pairs."""
    items = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in items}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, s) in enumerate(items):
        for j, t in items[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in items}


def check(df, rows):
    got = M.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert sorted((r.doc_id, r.n_shingles) for r in got if r.doc_id is not None) == \
        sorted((i, len(shingles(t))) for i, t in rows if i is not None)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is not None and r.doc_id == r.component_id)


def test_odd_documents(odd):
    check(odd, [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])


def test_empty_table(odd):
    assert M.near_duplicates(odd.limit(0)).count() == 0


def group(seed, n, edits):
    rng = random.Random(seed)
    base = ["v%d" % rng.randrange(500) for _ in range(150)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = "e%d" % rng.randrange(10_000)
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("block", [512, 16])
def test_large_group_of_near_copies(spark, monkeypatch, block):
    """Many near copies, most pairs under the similarity: links only partners far from the base have are found too."""
    monkeypatch.setattr(M, "BLOCK", block)
    rows = group(1, 150, 12) + [(1000 + i, t) for i, t in group(2, 40, 3)] + [(5000 + i, f"lonely {i} text of few words") for i in range(30)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_signature_join_finds_all_pairs_within_the_distance():
    rng = np.random.default_rng(3)
    sig = rng.integers(0, 3, (60, M.SYMBOLS)).astype(np.uint64)
    sig[30:] = sig[:30]
    for r in sig[30:]:
        r[rng.choice(M.SYMBOLS, rng.integers(0, 22), replace=False)] = 9
    by_no = [M._key(sig, no) for no in range(M.SYMBOLS)]
    for i in range(60):
        for j in range(i):
            same = sig[i] == sig[j]
            shared = [no for no in range(M.SYMBOLS) if by_no[no][i] == by_no[no][j]]
            if (~same).sum() <= M.MAX_DIFF:
                assert shared and M._first_key(same[None])[0] == shared[0]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(2, 61)) and all(got[100 + k] == 100 for k in range(1, 40)) and got[300] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_large_key_compares_only_what_is_outside_its_main_component(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)
    ids = spark.range(100).select(F.col("id").alias("rep"))
    labelled = ids.select("rep", F.when(F.col("rep") < 97, 0).otherwise(F.col("rep")).alias("component"), F.lit(9).alias("n"),
                          F.lit(b"").alias("signature"), F.lit(b"").alias("cells"))
    members = ids.select(F.lit(5).alias("key"), F.lit(1).alias("key_no"), "rep", F.lit(100).alias("members"))
    alone = M._units(members, labelled).collect()
    assert len(alone) == 100 and {r.side for r in alone} == {2} and len({r.unit for r in alone}) > 1
    main = F.struct(F.lit(97).alias("size"), F.lit(0).cast("long").alias("component"))
    rows = M._units(members.withColumn("main", main), labelled).collect()
    met = {}
    for r in rows:
        met.setdefault(r.unit, []).append(r)
    # the three outside are one block: once by themselves, once with each of the seven blocks inside
    assert sorted(r.rep for r in rows if r.side == 1) == list(range(97))
    assert all({r.rep for r in unit if r.rep >= 97} == {97, 98, 99} for unit in met.values()) and len(rows) == 97 + 3 * (1 + 7)

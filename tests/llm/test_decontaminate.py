import hashlib
import re

import pytest

from tripkpi.llm import decontaminate as D

LOW = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(docs, items, size=10):
    grams = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - size + 1, 1) if w else 0):
            grams.setdefault(tuple(w[k:k + size]), set()).add("null" if i is None else str(i))
    lengths = {len(g) for g in grams}
    out = {}
    for i, t in docs:
        w = words(t)
        mask, found = [False] * len(w), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k:k + n])) in grams:
                    mask[k:k + n] = [True] * n
                    found |= grams[g]
        out[i] = (len(w), mask, sorted(found))
    return out


ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (3, None), (4, ""),
         (5, "..!!.."), (None, "no id here"), (6, "alpha beta gamma delta epsilon zeta eta theta iota KAPPA, other end"), (7, "short item")]
TEXT = "see: ALPHA beta gamma-delta epsilon zeta eta theta iota kappa lambda! then a short   item and no id here."


@pytest.mark.parametrize("limit", [1 << 20, 2])
def test_against_brute_force(spark, odd, limit):
    from conftest import with_clashes
    docs = odd.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"])
    docs = with_clashes(docs.union(spark.createDataFrame([(100, TEXT), (101, "short item"), (102, "w short items w")], docs.schema)))
    items = with_clashes(spark.createDataFrame(ITEMS, "item_id long, text string"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], ITEMS)
    got = D.contamination(docs, items, max_windows=limit).collect()
    assert len(got) == len(want)
    for r in got:
        n, mask, names = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, sum(mask), len(names), any(mask)), r
        assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest() and r.item_ids == names
        flat = [False] * n
        for run in r.hit_words:
            flat[run.lo:run.hi] = [True] * (run.hi - run.lo)
        assert flat == mask
    cut = {r.doc_id: r.text for r in D.remove_spans(docs, items, max_windows=limit).collect()}
    assert 101 not in cut and cut[100] == "see: ! then a  and ."
    assert all(cut[i] == t for i, t in [(r.doc_id, r.text) for r in docs.collect()] if not any(want[i][1]))


def test_repeated_rows_and_empty_tables(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for limit in (1 << 20, 2):
        assert D.contamination(odd, items, max_windows=limit).count() == odd.count()
        assert D.remove_spans(odd, items, max_windows=limit).columns == odd.columns
    assert D.contamination(odd.limit(0), items).count() == 0
    assert D.contamination(odd, items.limit(0)).where("contaminated").count() == 0

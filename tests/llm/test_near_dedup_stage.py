"""The pipeline's near-dedup stage at its own similarity, 0.8."""

import random

import corpus_pipeline as C
import numpy as np
from test_minhash_hamming import group, shingles

from tripkpi.llm import minhash_hamming as M


def kept(rows, percent):
    """The smallest id of each component, by comparing all pairs."""
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return sorted({find(i) for i in up})


def pairs_between(n):
    """Pairs of texts whose similarity lies about 0.8, each pair with words of its own."""
    rng = random.Random(8)
    rows = []
    for k in range(n):
        w = [f"p{k}x{i}" for i in range(150)]
        rows.append((2 * k, " ".join(w)))
        for at in rng.sample(range(5, 145, 10), rng.choice((2, 3, 3, 3, 4))):
            w[at] = "other"
        rows.append((2 * k + 1, " ".join(w)))
    return rows


def test_stage_keeps_one_of_each_group_at_080(spark):
    rows = pairs_between(60) + [(1000 + i, t) for i, t in group(1, 60, 12)] + [(5000, ""), (5001, "two words")]
    want = kept(rows, 80)
    assert len(want) < len(kept(rows, 85))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in C.near_dedup_stage(spark, docs, "").collect()) == want


def test_symbols_follow_the_similarity():
    assert (M.symbols_for(85), M.symbols_for(80)) == (M.SYMBOLS, 60) == (40, 60)
    rng = np.random.default_rng(6)
    n = M.symbols_for(80)
    sig = np.repeat(rng.integers(0, 9, (40, n)).astype(np.uint64), 2, 0)
    for r in sig[1::2]:
        r[rng.choice(n, 2 * (n // M.SPAN) - 1, replace=False)] += np.uint64(9)
    same = sig[::2] == sig[1::2]
    for k, no in enumerate(M._first_key(same)):
        assert M._key(sig[2 * k:2 * k + 1], no) == M._key(sig[2 * k + 1:2 * k + 2], no)


def test_other_texts_under_one_id_are_documents_of_their_own(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(7, one), (7, two), (7, two), (3, one), (9, two + " more"), (4, None), (4, None), (4, ""), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in C.near_dedup_stage(spark, docs, "").collect()), key=str)
    assert got == sorted([(3, one), (7, two), (4, None), (4, ""), (None, one)], key=str)


def test_rows_that_differ_in_other_columns_only(spark):
    import corpus_pipeline as C
    text = "one two three four five six seven"
    rows = [(1, text, lang, source, 5) for lang, source in (("en", "b"), ("en", "a"), (None, "c"))] + [(2, "other words of its own here", "en", "a", 9)]
    seen = set()
    for parts in (1, 3, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)
        out = C.near_dedup_stage(spark, df, "")
        assert out.columns == df.columns
        seen.add(tuple(sorted(map(str, out.collect()))))
    assert len(seen) == 1 and len(next(iter(seen))) == 2

import hashlib

import numpy as np
import pytest

from tripkpi.llm import suffix_dedup as S


def brute(rows):
    """(rank, id, text) -> n_bytes, removed, spans, digest."""
    first = {}
    raw = [(rank, i, (t or "").encode()) for rank, i, t in rows]
    for rank, _, b in raw:
        for p in range(len(b) - 49):
            k = b[p:p + 50]
            first[k] = min(first.get(k, rank), rank)
    out = []
    for rank, i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < rank:
                gone[p:p + 50] = b"\1" * 50
        keep = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), len(b) - len(keep), spans, hashlib.sha256(keep).hexdigest()))
    return out


def key(r):
    return tuple("" if x is None else str(x) for x in r)


def check(df, rows):
    ranked = [(S.LAST if i is None else i, i, t) for i, t in rows]
    got = [tuple(r) for r in S.remove_repeats(df, texts=False).drop("kept", "spans").collect()]
    assert sorted(got, key=key) == sorted(brute(ranked), key=key)


def test_odd_documents(odd):
    """Nulls, repeated ids and rows, texts longer than a slice."""
    check(odd, [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_overlaps(spark, seed):
    rng = np.random.default_rng(seed)
    base = "".join(rng.choice(list("ab é"), 900))
    rows = []
    for i in range(60):
        a, n = rng.integers(0, 700), rng.integers(0, 200)
        extra = "".join(rng.choice(list("abcdef "), rng.integers(0, 80)))
        rows.append((int(i), base[a:a + n] + extra + base[a // 2:a // 2 + n // 2]))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


def test_kept_bytes_and_spans(spark):
    text = "abcdefghij" * 12
    rows = [(1, text), (2, "before " + text + " after")]
    got = {r.doc_id: r for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert bytes(got[2].kept) == b"before  after" and [(s.lo, s.hi) for s in got[2].spans] == [(7, 127)] and got[1].n_removed == 0


def test_empty_table(odd):
    assert S.remove_repeats(odd.limit(0)).count() == 0


def test_two_stage_sorting_against_plain_comparison():
    rng = np.random.default_rng(0)
    for _ in range(120):
        k, letters = rng.integers(1, 10), rng.integers(1, 4)
        base = rng.integers(0, letters + 1, 200).astype(np.uint8)
        strings = []
        for _ in range(k):
            n = rng.integers(50, 81)
            at = rng.integers(0, 200 - n + 1)
            s = base[at:at + n].copy() if rng.random() < 0.6 else rng.integers(0, letters + 1, n).astype(np.uint8)
            if rng.random() < 0.3:
                s[rng.integers(n)] = rng.integers(0, letters + 1)
            strings.append(s)
        owner = rng.integers(0, 100, k)
        out, _ = S.smallest_owner(np.concatenate(strings), np.array([len(s) for s in strings]), owner)
        low = {}
        for s, o in zip(strings, owner):
            for p in range(len(s) - 49):
                w = s[p:p + 50].tobytes()
                low[w] = min(low.get(w, o), o)
        assert out.tolist() == [low[s[p:p + 50].tobytes()] for s in strings for p in range(len(s) - 49)]


def test_suffixes_are_in_lexical_order():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 3, 400).astype(np.uint8)
    text, at = S._with_ends(data, np.array([150, 250]))
    start = np.concatenate([at[0] + np.arange(101), at[1] + np.arange(201)])
    order = S._two_stage(text, start, at + np.array([100, 200]))
    ends = [150, 401]
    suffix = [bytes(text[p:(ends[0] if p <= ends[0] else ends[1]) + 1])[:50] for p in order]
    assert suffix == sorted(suffix) and set(start.tolist()) <= set(order.tolist())


def test_equal_windows_share_an_anchor():
    rng = np.random.default_rng(1)
    d = rng.integers(0, 3, 3000).astype(np.uint8)
    d[1500:1700] = d[100:300]
    bounds = np.array([0, 700, 720, 2000, 2000, 3000])
    seen, windows = {}, 0
    for r, lo, n, h in zip(*S.anchors(d, bounds)):
        assert n <= S.SPAN
        for p in range(lo, lo + n):
            assert bounds[r] <= p and p + 50 <= bounds[r + 1]
            assert seen.setdefault(d[p:p + 50].tobytes(), h) == h
            windows += 1
    assert windows == sum(max(0, b - a - 49) for a, b in zip(bounds[:-1], bounds[1:]))

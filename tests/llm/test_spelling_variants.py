import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tripkpi.llm import spelling_variants as M

LOW = {c: c + 32 for c in range(65, 91)}


def brute_words(rows, least=5, letters=6):
    counts = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if n >= least and len(w) >= letters}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(words):
    near = defaultdict(list)
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
    form = {}
    for w in words:
        if near[w]:
            top = min(near[w], key=lambda x: (-words[x], x))
            if words[top] >= 5 * words[w]:
                form[w] = top

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in M.spelling_variants(df, **options).collect()}
    assert got == brute(brute_words(rows))
    return got


@pytest.mark.parametrize("cell_words", [8, 40, 1 << 14])
def test_against_brute_force(spark, cell_words):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 8))) for _ in range(12)]

    def variant(w):
        for _ in range(rng.choice([0, 0, 1, 2])):
            k = rng.randrange(len(w))
            w = w[:k] + rng.choice(["", "a", "bé", w[k]]) + w[k + rng.randrange(2):]
        return w

    rows = [(i, " ".join(rng.choice([variant(rng.choice(stems)), rng.choice(stems)]) for _ in range(60))) for i in range(120)]
    got = check(spark, rows, cell_words=cell_words, sample=64)
    assert any(v[0] for v in got.values()) and max(v[3] for v in got.values()) > 3


def test_chains_ties_and_anagrams(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "ccccccd": 30, "ccccccb": 30, "cccccc": 6,
              "abcdef": 5, "fedcba": 5, "bacdef": 9, "abcdeg": 9, "ÀÀÀÀÀÀ": 7, "×÷àáâã": 7}
    rows = [(None, " ".join([w] * n).upper() if w.isascii() else " ".join([w] * n)) for w, n in counts.items()]
    got = check(spark, rows)
    assert got["aaaaaa"][:2] == ("aaaaab", "aaabbb") and got["cccccc"][0] == "ccccccb"


def test_equal_vectors_and_crowded_cells(spark):
    rng = random.Random(5)
    letters = list("abcdefg")
    words = set()
    while len(words) < 300:                                # anagrams: one vector, a cell that no split parts
        rng.shuffle(letters)
        words.add("".join(letters))
    more = [w[:k] + "a" + w[k + 1:] for w in list(words)[:60] for k in (0, 3)] + [w[1:] for w in list(words)[:60]]
    rows = [(i, " ".join(list(words) + more)) for i in range(5)]
    check(spark, rows, cell_words=32, sample=64)


def test_odd_documents(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in M.spelling_variants(odd).collect()}
    assert got == brute(brute_words(rows))
    few = spark.createDataFrame([(1, None), (2, ""), (3, "x " * 9)], "doc_id long, text string")
    assert M.spelling_variants(few).count() == 0 and M.spelling_variants(odd.limit(0)).count() == 0


def test_vectors_and_pruning_lose_no_neighbour():
    rng = np.random.default_rng(0)
    p = rng.integers(0, 3, (400, M.WIDTH)).astype(np.int32) * (rng.random(M.WIDTH) < 0.1)
    nodes = M.fit_splits(p, 40)
    cell = M.home(nodes, p)
    assert len(set(cell.tolist())) > 20
    for over, under in ((1, 1), (1, 0)):
        seen = {(c, r) for c, rows in M.reached(nodes, p, over, under) for r in rows.tolist()}
        gap = p[:, None] - p[None]
        ok = (np.maximum(gap, 0).sum(2) <= over) & (np.maximum(-gap, 0).sum(2) <= under)
        for a, b in zip(*np.nonzero(ok)):
            assert (int(cell[b]), int(a)) in seen
    assert (M.vectors(["abca", "éþ"]).sum(1) == [4, 2]).all() and M.fit_splits(p[:1], 5) == []

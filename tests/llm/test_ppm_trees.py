"""Sparse context trees: all byte values, and one order for any number of languages."""

import random

import numpy as np
from test_ppm_langid import slow_bits

from tripkpi.llm import ppm_langid as M

SCRIPTS = [(0x61, 26), (0x3B1, 25), (0x430, 32), (0x5D0, 27), (0x627, 28), (0x905, 50), (0xE01, 46), (0x4E00, 200), (0xAC00, 200), (0x10D0, 33)]


def languages():
    """20 languages, two of each script, that differ in their words; law of bytes shared within a script."""
    out = {}
    for k, (base, n) in enumerate(SCRIPTS):
        for j in range(2):
            rng = random.Random(10 * k + j)
            out[f"{k}{'xy'[j]}"] = ["".join(chr(base + rng.randrange(n)) for _ in range(rng.randrange(2, 7))) for _ in range(60)]
    return out


def text(words, seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


def test_lengths_of_twenty_languages_follow_the_definition():
    train = {k: [text(w, s, 30).encode() for s in range(2)] for k, w in languages().items()}
    m = M.Trees(train)
    assert m.order == 3 and len(m.langs) == 20
    texts = [text(w, 9, 4).encode() for w in list(languages().values())[::3]] + [b"", b"T", b"z\x00q\xff"]
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = m.lengths(data, off)
    same = list(range(256))
    for i, t in enumerate(texts):
        assert np.allclose(M.lengths(m, data, off, i, i + 1, span=7), got[i], atol=1e-3)
        for j in (0, 5, 12, 19):
            assert abs(got[i, j] - slow_bits(train[m.langs[j]], t, 3, same, 256, 0x20, 0.0)) < 1e-3


def test_parts_add_up(monkeypatch):
    m = M.Trees({"x": [b"the cat sat"], "y": [b"der hund"]})
    data, off = np.frombuffer(b"the hund satz the dog der", np.uint8), np.array([0, 0, 3, 4, 20, 25, 25])
    whole = m.lengths(data, off)
    monkeypatch.setattr(M, "PART_CELLS", 10)
    assert np.allclose(m.lengths(data, off), whole)


def test_query_tells_twenty_languages_apart(spark):
    rows = [(100 * k + i, text(w, i, 25), lang) for k, (lang, w) in enumerate(languages().items()) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    assert M.fit(docs).order == 3
    got = M.languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 40 and sum(r.lang_pred == r.lang for r in got) / len(got) > 0.95

import math
import zlib

import numpy as np
from dense_ppm import Ppm

from tripkpi.llm import ppm_langid as M


def slow_bits(train, text, order, symbol, size, pad, shared):
    """Code length by the definition: counts in dictionaries, escapes by recursion."""
    seqs = [[symbol[b] for b in M.V.LOWER[np.frombuffer(t, np.uint8)]] for t in train]
    counts = {}
    for s in seqs:
        s = [pad] * order + s
        for i in range(order, len(s)):
            for k in range(order + 1):
                ctx = tuple(s[i - k:i])
                counts.setdefault(ctx, {}).setdefault(s[i], 0)
                counts[ctx][s[i]] += 1

    def prob(ctx, x):
        if ctx is None:
            return 1 / size
        shorter = ctx[1:] if ctx else None
        seen = counts.get(ctx)
        if not seen:
            return prob(shorter, x)
        total = sum(seen.values()) + len(seen)
        return seen[x] / total if x in seen else len(seen) / total * prob(shorter, x)

    s = [pad] * order + [symbol[b] for b in M.V.LOWER[np.frombuffer(text, np.uint8)]]
    return sum(-math.log2(prob(tuple(s[i - order:i]), s[i])) + (shared if s[i] == size - 1 else 0) for i in range(order, len(s)))


def test_code_lengths_follow_the_definition():
    train = {"x": [b"the cat sat on the mat", b"The bat"], "y": [b"der hund und die katze", "über".encode()]}
    m = Ppm(train, order=3, symbols=12)
    shared = math.log2(256 - (m.size - 1))
    for text in (b"the hat", b"z\x00q", "üb the die".encode(), b"T"):
        data = np.frombuffer(text, np.uint8)
        got = m.lengths(data, np.array([0, len(data)]))[0]
        for j, lang in enumerate(m.langs):
            assert abs(got[j] - slow_bits(train[lang], text, 3, m.symbol, m.size, m.pad, shared)) < 1e-3


def test_batches_spans_and_bounded_tables():
    m = Ppm({"x": [b"the cat sat"], "y": [b"der hund"]}, order=3)
    texts = [b"", b"t", b"the", b"the hund sat on", b"", b"x" * 300]
    data = np.frombuffer(b"".join(texts), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    all_ = m.lengths(data, off)
    for i, t in enumerate(texts):
        one = m.lengths(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
        assert np.allclose(all_[i], one) and np.allclose(M.lengths(m, data, off, i, i + 1, span=7), one)
    assert Ppm({str(k): [bytes(range(256))] for k in range(30)}, order=3).order == 2


def test_probabilities_are_a_law():
    m = Ppm({"x": [b"abracadabra " * 9]}, order=2, symbols=5)
    weight = np.ones(m.size)
    weight[-1] = 256 - (m.size - 1)
    assert ((2.0 ** -m.bits.reshape(-1, m.size)) @ weight <= 1 + 1e-6).all()


def test_odd_documents(odd):
    got = M.languages(odd).toPandas()
    assert len(got) == odd.count() and got.score.between(0, 1).all() and set(got.lang_pred) <= {"aa", "bb", "und"}
    texts = odd.select("doc_id", "text").toPandas()
    none = set(texts.doc_id[[t is None or not any(c.isalpha() for c in t) for t in texts.text]].dropna())
    assert set(got.doc_id[got.lang_pred == "und"].dropna()) == none
    assert got.held_out[got.doc_id.isna()].all()
    assert M.languages(odd.limit(0)).count() == 0
    assert set(M.languages(odd.withColumn("lang", odd.lang.substr(9, 1)).where("lang is null")).toPandas().lang_pred) <= {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = M.languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97


def test_no_language_is_lost(spark):
    """Languages of long texts only, of one short text, and many languages under a small budget for all."""
    rows = [(3 * i, "der hund und die katze gehen heute in den wald " * 4000, "de") for i in range(12)]
    rows += [(3 * i + 40, f"the dog and the cat number {i} go to the wood today", "en") for i in range(100)]
    rows += [(1000, "le chien et le chat vont au bois " * 3, "fr"), (1003, "le chat et le chien", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = M.fit(docs, fit_bytes=2000)
    assert model.langs in (["de", "en", "fr"], ["de", "en"]) and "de" in model.langs
    got = M.languages(docs, fit_bytes=2000)
    pred = {r.doc_id: r.lang_pred for r in got.collect()}
    assert all(pred[i] == lang for i, _, lang in rows if lang in ("de", "en"))


def test_a_thousand_languages(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(1000):
        words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(6)]
        rows += [(10 * k + j, " ".join(words * 2), f"l{k:04d}") for j in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = M.fit(docs, all_bytes=100_000)
    learned = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert set(model.langs) == learned and len(learned) > 980
    some = M.languages(docs.where("doc_id % 500 < 4"), all_bytes=100_000)
    assert some.count() == 80

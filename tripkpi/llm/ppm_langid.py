"""Language ID by prediction by partial matching over bytes.

For each language a tree of byte contexts of up to ``order`` bytes holds the
frozen counts of its training sample. A byte's probability comes from the
longest context seen; where the byte is new in a context, the escape
probability (method C: distinct bytes over all plus distinct) passes on to the
next shorter one, down to a uniform law. A text's code length under a language
is the exact sum over all its bytes; the shortest code wins and ``score`` is
its posterior among the languages.

A-Z is lower-cased; all 256 byte values are told apart. ``Trees`` holds only
the contexts and bytes seen, per order as sorted codes with one value for each
language that saw them, so that its size is bounded by the training bytes and
the order is the same for any number of languages. The training sample is
bounded, per language (``fit_bytes``) and over all (``all_bytes``, which many
languages share evenly), and every language with a text has some; texts are
chosen by a hash. Scoring reads each whole text once, without a shuffle.

Defined cases: null text, or text without a letter, is ``und`` with score 0,
and so is everything if no language could be learned; null ids count as held
out; rows with null lang teach nothing; ties go to the language first in code
point order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm import textvec as V
from tripkpi.llm.tables import Shared, bounded_batches, staged

ORDER = 3
FIT_BYTES = 400_000
ALL_BYTES = 32_000_000
MAX_ORDER = 7
PART_CELLS = 1 << 21


class Sparse:
    """Sorted codes, each with values for some of the languages."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        """``parts``: per language its codes, each once, and their values."""
        code = np.concatenate([c for c, _ in parts])
        order = np.argsort(code, kind="stable")
        self.codes, first = np.unique(code[order], return_index=True)
        self.first = np.append(first, len(code))
        self.lang = np.repeat(np.arange(len(parts), dtype=np.int32), [len(c) for c, _ in parts])[order]
        self.value = np.concatenate([v for _, v in parts])[order].astype(np.float32)

    def add(self, out: np.ndarray, wanted: np.ndarray) -> None:
        """Add the values of each wanted code to its row of ``out``, a column per language."""
        if not len(self.codes):
            return
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        row = np.flatnonzero(self.codes[at] == wanted)
        n = self.first[at[row] + 1] - self.first[at[row]]
        entry = np.repeat(self.first[at[row]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out[np.repeat(row, n), self.lang[entry]] += self.value[entry]


class Trees:
    """Code lengths (bits) of bytes after their contexts, from the contexts that each language's sample holds.

    A length is that of the byte alone, plus per order the escape bits of the
    context, where seen, plus, where the byte was seen in it, what the byte's
    own length differs from escaping.
    """

    def __init__(self, samples: dict[str, list[bytes]], order: int = ORDER):
        if order > MAX_ORDER:
            raise ValueError(f"contexts of at most {MAX_ORDER} bytes fit a code")
        self.langs = sorted(samples)
        self.order = order
        self.alone = np.empty((256, len(self.langs)))
        escapes, seen = [[] for _ in range(order)], [[] for _ in range(order)]
        for col, lang in enumerate(self.langs):
            texts = [V.LOWER[np.frombuffer(t, np.uint8)] for t in samples[lang]]
            for k in range(order + 1):
                codes, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *(self.codes(t, k) for t in texts)]), return_counts=True)
                context, first, group = np.unique(codes >> np.uint64(8), return_index=True, return_inverse=True)
                kinds = np.diff(np.append(first, len(codes)))
                whole = np.bincount(group, n, len(context)) + kinds
                escape, own = np.log2(whole / kinds), np.log2(whole[group] / n)
                if k == 0:
                    self.alone[:, col] = 8.0 + (escape[0] if len(codes) else 0.0)
                    self.alone[codes.astype(np.int64), col] = own
                else:
                    shorter = before[1][np.searchsorted(before[0], codes & np.uint64((1 << 8 * k) - 1))]
                    escapes[k - 1].append((context, escape))
                    seen[k - 1].append((codes, own - shorter - escape[group]))
                before = codes, own
        self.escapes, self.seen = [Sparse(p) for p in escapes], [Sparse(p) for p in seen]

    @staticmethod
    def codes(text: np.ndarray, order: int) -> np.ndarray:
        """Context and byte at each position as one number; the text is preceded by spaces."""
        full = np.concatenate([np.full(order, 0x20, np.uint8), text])
        code = np.zeros(len(text), np.uint64)
        for k in range(order + 1):
            code = (code << np.uint64(8)) | full[k:k + len(text)]
        return code

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Bits of each code (context and byte) under each language."""
        out = self.alone[(codes & np.uint64(255)).astype(np.int64)]
        for k in range(1, self.order + 1):
            short = codes & np.uint64((1 << 8 * (k + 1)) - 1)
            self.escapes[k - 1].add(out, short >> np.uint64(8))
            self.seen[k - 1].add(out, short)
        return out

    def sums(self, codes: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Bits of each run of codes beginning at ``start``; every code is looked up once."""
        out = np.zeros((len(start), len(self.langs)))
        step = max(1, PART_CELLS // len(self.langs))
        for at in range(0, len(codes), step):
            part = codes[at:at + step]
            each, which = np.unique(part, return_inverse=True)
            a, b = np.searchsorted(start, at, "right") - 1, np.searchsorted(start, at + len(part), "left")
            out[a:b] += np.add.reduceat(self.bits(each)[which], np.maximum(start[a:b] - at, 0), axis=0)
        return out

    def lengths(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits of each text (rows bounds[i] to bounds[i + 1] of ``data``) under each language."""
        text = V.LOWER[data]
        out = np.zeros((len(bounds) - 1, len(self.langs)))
        if not len(text):
            return out
        code = self.codes(text, self.order)
        # the first positions of a text must not see the text before it
        for k in range(self.order):
            at = bounds[:-1][np.diff(bounds) > k] + k
            head = np.zeros(len(at), np.uint64)
            for j in range(self.order, -1, -1):
                head = (head << np.uint64(8)) | (text[at - j] if j <= k else np.uint64(0x20))
            code[at] = head
        some = np.flatnonzero(np.diff(bounds))
        out[some] = self.sums(code, bounds[some])
        return out

    def more(self, text: np.ndarray) -> np.ndarray:
        """Bits of a text's bytes after its first ``order``, which are context only."""
        return self.sums(self.codes(V.LOWER[text], self.order)[self.order:], np.zeros(1, np.int64))[0]


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1):
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(folds)) == fold, F.lit(True))


def fit(docs: DataFrame, *, fit_bytes: int = FIT_BYTES, all_bytes: int = ALL_BYTES, order: int = ORDER) -> Trees | None:
    """Context trees from a sample of each language's texts that aren't held out.

    A language gets ``fit_bytes`` bytes, or its share of ``all_bytes`` where
    there are many languages: the texts of the smallest hashes, until they are
    enough. Every language gets its first text, so none is lost, however few
    or long its texts are. Of a text longer than a language's bytes, a window of
    so many is learned, at a hashed place.
    """
    text = F.col("text").cast("string")
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.cast("binary").alias("raw"))
    known = known.where(F.octet_length("raw") > 0).withColumn(
        "u", F.pmod(F.xxhash64("doc_id", "raw", F.lit("ppm")), F.lit(1 << 40)) / float(1 << 40))
    stats = known.groupBy("lang").agg(F.sum(F.octet_length("raw")).alias("bytes"), F.min("u").alias("first"))
    langs = stats.count()
    if not langs:
        return None
    own = max(1, min(fit_bytes, all_bytes // langs))
    # twice the bytes wanted on average, and the first text in any case; the driver keeps the smallest hashes of these
    # staged, a row per language: its true size decides the join, so that few languages don't make the texts move
    stats = staged(stats.select(F.col("lang").alias("fit_lang"), F.greatest("first", F.lit(2.0 * own) / F.col("bytes")).alias("upto")),
                   "ppm-languages")
    size = F.octet_length("raw")
    at = F.pmod(F.xxhash64("raw"), F.greatest(size - own, F.lit(1)))
    part = F.when(size > own, F.substring(F.col("raw"), (at + 1).cast("int"), F.lit(own))).otherwise(F.col("raw"))
    rows = known.join(stats, (F.col("lang") == F.col("fit_lang")) & (F.col("u") <= F.col("upto"))).select(
        "doc_id", "lang", "u", part.alias("raw")).collect()
    samples: dict[str, list[bytes]] = {}
    held: dict[str, int] = {}
    for r in sorted(rows, key=lambda r: (r["u"], r["doc_id"], r["raw"])):
        if held.get(r["lang"], 0) < own:
            samples.setdefault(r["lang"], []).append(bytes(r["raw"]))
            held[r["lang"]] = held.get(r["lang"], 0) + len(r["raw"])
    return Trees(samples, order)


def languages(docs: DataFrame, *, fit_bytes: int = FIT_BYTES, all_bytes: int = ALL_BYTES, order: int = ORDER) -> DataFrame:
    """Per document: whether it is held out, the predicted language and its posterior."""
    bounded_batches(docs)
    model = fit(docs, fit_bytes=fit_bytes, all_bytes=all_bytes, order=order)
    held = Shared(docs.sparkSession, model)
    text = F.col("text").cast("string")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                      F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def predict(batches):
        ppm = held.value
        for b in batches:
            letters = np.asarray(b.column(2).cast(pa.int8())).astype(bool)
            lang, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
            if ppm is not None:
                data, offsets, _ = V.utf8(b.column(1))
                for lo, hi in V.slices(offsets, 1 << 18):
                    bits = lengths(ppm, data, offsets, lo, hi)
                    best = bits.argmin(1)
                    post = 1 / np.exp2(np.clip(bits.min(1, keepdims=True) - bits, -1000, 0)).sum(1)
                    for i in range(lo, hi):
                        if letters[i]:
                            lang[i], score[i] = ppm.langs[best[i - lo]], post[i - lo]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return src.mapInArrow(predict, "doc_id long, lang_pred string, score double").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def lengths(ppm: Trees, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, span: int = 1 << 20) -> np.ndarray:
    """Code lengths of rows lo to hi; a long text is added up span by span with its true contexts."""
    base = offsets[lo]
    if offsets[hi] - base <= span:
        return ppm.lengths(data[base:offsets[hi]], (offsets[lo:hi + 1] - base).astype(np.int64))
    text = data[base:offsets[hi]]
    total = np.zeros((1, len(ppm.langs)))
    for at in range(0, len(text), span):
        if at == 0:
            total += ppm.lengths(text[:span], np.array([0, min(span, len(text))]))
        else:
            total += ppm.more(text[at - ppm.order:at + span])
    return total

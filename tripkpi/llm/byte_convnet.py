"""Quality classifier: a byte-level convolutional network in numpy.

Input are the text's UTF-8 bytes. ``filters`` learned filters of ``width``
bytes slide over the whole document; responses are max-pooled inside chunks of
``2 * BLOCK`` bytes that overlap by half, and the chunks' maxima, averaged and
maximised over the document, are combined by a logistic layer into one
probability. Filters are stored as one table per filter position (byte ->
response; for scoring, pairs of positions share one), so a response is a few
table rows added up.

The network is fitted on the driver from a bounded sample of labelled rows
(``fit_rows`` rows, chosen by a hash of the id, texts of at most ``FIT_CHARS``
code points); every document is then scored whole, without a shuffle.

Defined cases: null and empty text are scored as a text without bytes (one
chunk of padding); null ids count as held out; rows without a label are scored
only; labels that contradict each other for one id count as their smallest;
without any labelled row every score is 0.5; an empty table gives no rows;
other input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm import textvec as V
from tripkpi.llm.tables import Shared, bounded_batches

FILTERS = 16
WIDTH = 6
BLOCK = 128
FIT_ROWS = 3000
FIT_CHARS = 1 << 16
STEPS = 700
CHUNKS_PER_STEP = 6
THRESHOLD = 0.3
SEED = 11


class ConvNet:
    def __init__(self, filters: int = FILTERS, width: int = WIDTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.width, self.filters = width, filters
        self.p = {"table": rng.normal(0, 0.25, (width, 256, filters)).astype(np.float32),
                  "mean": rng.normal(0, 0.3, filters).astype(np.float32),
                  "top": rng.normal(0, 0.1, filters).astype(np.float32), "bias": np.zeros(1, np.float32)}
        self.freeze()

    def freeze(self) -> "ConvNet":
        """Tables over byte pairs: half the look-ups of single bytes."""
        t = self.p["table"]
        self.pairs = [(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(1 << 16, -1) if j + 1 < self.width
                      else np.repeat(t[j], 256, axis=0) for j in range(0, self.width, 2)]
        return self

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "pairs"}

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses at every position of a byte array (the last width - 1 have none)."""
        n = len(data) - self.width + 1
        pair = data.astype(np.uint16) << 8
        pair[:-1] |= data[1:]
        out = np.take(self.pairs[0], pair[:n], axis=0, mode="clip")
        more = np.empty_like(out)
        for j in range(1, len(self.pairs)):
            np.take(self.pairs[j], pair[2 * j:2 * j + n], axis=0, out=more, mode="clip")
            out += more
        return out

    def pooled(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Chunk maxima of several texts, and the text each chunk belongs to."""
        pad = np.zeros(self.width - 1, np.uint8)
        data = np.concatenate([x for t in texts for x in (t if len(t) else pad[:1], pad)])
        length = np.array([max(1, len(t)) for t in texts])
        start = np.concatenate([[0], np.cumsum(length + self.width - 1)])[:-1]
        blocks = -(-length // BLOCK)
        own = np.repeat(np.arange(len(texts)), blocks)
        no = np.arange(len(own)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        lo = start[own] + no * BLOCK
        hi = np.minimum(lo + BLOCK, start[own] + length[own])
        resp = self.responses(data)
        best = np.maximum.reduceat(resp, np.stack([lo, np.minimum(hi, len(resp) - 1)], 1).ravel(), axis=0)[::2]
        last = hi >= len(resp)          # reduceat leaves out its end: the very last position
        if last.any():
            best[last] = np.maximum(best[last], resp[-1])
        # a chunk is two neighbouring blocks of one text; a text of one block is one chunk
        pair = np.flatnonzero(own[:-1] == own[1:])
        single = np.flatnonzero(np.repeat(blocks == 1, blocks))
        chunk = np.concatenate([np.maximum(best[pair], best[pair + 1]), best[single]])
        owner = np.concatenate([own[pair], own[single]])
        order = np.argsort(owner, kind="stable")
        return chunk[order], owner[order]

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """One probability per text."""
        chunk, owner = self.pooled(texts)
        first = np.searchsorted(owner, np.arange(len(texts)))
        h = np.maximum(chunk, 0)
        count = np.diff(np.append(first, len(owner)))[:, None]
        z = (np.add.reduceat(h, first, axis=0) / count) @ self.p["mean"] + \
            np.maximum.reduceat(h, first, axis=0) @ self.p["top"] + self.p["bias"][0]
        return 1.0 / (1.0 + np.exp(-z.astype(np.float64)))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, batch: int = 48,
            rate: float = 0.01, decay: float = 1e-4, seed: int = SEED) -> "ConvNet":
        """Adam on the log loss; each step sees at most ``CHUNKS_PER_STEP`` random chunks of a text."""
        rng = np.random.default_rng(seed)
        size, w = 2 * BLOCK, self.width
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step, per_epoch = 0, -(-len(texts) // batch)
        total = -(-steps // per_epoch) * per_epoch
        while step < total:
            order = rng.permutation(len(texts))
            for at in range(0, len(order), batch):
                ids = order[at:at + batch]
                rows, owner = [], []
                for k, i in enumerate(ids):
                    t = texts[i]
                    n = max(1, -(-len(t) // BLOCK) - 1)
                    for c in rng.choice(n, min(n, CHUNKS_PER_STEP), replace=False):
                        part = t[c * BLOCK:c * BLOCK + size + w - 1]
                        rows.append(np.pad(part, (0, size + w - 1 - len(part))))
                        owner.append(k)
                x, owner = np.stack(rows), np.array(owner)
                resp = self.p["table"][0][x[:, :size]]
                for j in range(1, w):
                    resp += self.p["table"][j][x[:, j:j + size]]
                arg = resp.argmax(1)                                             # (chunks, filters)
                best = np.take_along_axis(resp, arg[:, None, :], 1)[:, 0]
                h = np.maximum(best, 0)
                first = np.searchsorted(owner, np.arange(len(ids)))
                count = np.diff(np.append(first, len(owner)))[:, None]
                mean = np.add.reduceat(h, first, axis=0) / count
                top = np.maximum.reduceat(h, first, axis=0)
                z = mean @ self.p["mean"] + top @ self.p["top"] + self.p["bias"][0]
                err = ((1 / (1 + np.exp(-z)) - labels[ids]) / len(ids)).astype(np.float32)
                back = err[owner, None] * (self.p["mean"] / count[owner] + self.p["top"] * (h == top[owner]))
                back *= best > 0
                grad = np.zeros_like(self.p["table"])
                f = np.broadcast_to(np.arange(self.filters), arg.shape)
                rowno = np.arange(len(x))[:, None]
                for j in range(w):
                    np.add.at(grad[j], (x[rowno, arg + j], f), back)
                grads = {"table": grad + decay * self.p["table"], "mean": mean.T @ err + decay * self.p["mean"],
                         "top": top.T @ err + decay * self.p["top"], "bias": err.sum(keepdims=True)}
                step += 1
                lr = rate * (1 - step / (total + 1))
                for k, g in grads.items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self.freeze()


def held_out(id_col: str = "doc_id", folds: int = 5, fold: int = 0):
    """True for rows never learned from: crc32 of the id's text modulo ``folds`` is ``fold``; null ids are."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(folds)) == fold, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS, fit_chars: int = FIT_CHARS,
        label_col: str = "quality") -> ConvNet | None:
    """A network fitted on at most about ``fit_rows`` labelled rows that aren't held out, of ``fit_chars`` characters at most."""
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("fit_id")).agg(F.min(F.col(label_col).cast("int")).alias("fit_label"))
    known = known.where(~held_out("fit_id"))
    rate = min(1.0, fit_rows / max(1, known.count()))
    u = F.pmod(F.xxhash64("fit_id", F.lit("fit")), F.lit(1 << 40)) / float(1 << 40)
    text = F.col("text").cast("string")
    src = docs.where(F.col("text").isNotNull() & (F.length("text") <= fit_chars)).select(
        F.col("doc_id").cast("long").alias("fit_id"), text.cast("binary").alias("raw"))
    # the sample is bounded by fit_rows, so its ids may be broadcast
    rows = src.join(F.broadcast(known.where(u < rate)), "fit_id").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["fit_id"], r["raw"]))
    rows = rows[:2 * fit_rows]
    return ConvNet().fit([np.frombuffer(r["raw"], np.uint8) for r in rows],
                         np.array([r["fit_label"] for r in rows], np.float32))


def scorer(net: ConvNet | None, spark):
    """A mapInArrow function that appends ``score`` to batches whose column ``text_at`` is the text."""
    held = Shared(spark, net)

    def score(batches, text_at: int):
        model = held.value and held.value.freeze()
        for b in batches:
            data, offsets, _ = V.utf8(b.column(text_at))
            out = [np.zeros(0)]
            for lo, hi in V.slices(offsets, 1 << 15):
                if model is None:
                    out.append(np.full(hi - lo, 0.5))
                elif offsets[hi] - offsets[lo] > 1 << 20:
                    out.append(np.array([_long_score(model, data[offsets[lo]:offsets[hi]])]))
                else:
                    out.append(model.scores([data[offsets[i]:offsets[i + 1]] for i in range(lo, hi)]))
            yield b.append_column("score", pa.array(np.concatenate(out), pa.float64()))
    return score


def _long_score(model: ConvNet, data: np.ndarray, span: int = 1 << 19) -> float:
    """The same score for a text too long to convolve at once: chunk maxima are gathered span by span."""
    total, top, n = np.zeros(model.filters), np.zeros(model.filters, np.float32), 0
    blocks = -(-len(data) // BLOCK)
    step = span // BLOCK
    for at in range(0, max(1, blocks - 1), step):
        # chunks at .. at + step - 1 need blocks up to at + step, and width - 1 bytes beyond them
        part = data[at * BLOCK:(min(at + step, blocks - 1) + 1) * BLOCK + model.width - 1]
        more = np.zeros(model.width - 1 if (at + step + 1) * BLOCK >= len(data) else 0, np.uint8)
        part = np.concatenate([part[:(min(at + step, blocks - 1) + 1) * BLOCK + model.width - 1], more])
        resp = model.responses(part)
        count = min(step, blocks - 1 - at)
        best = np.maximum.reduceat(resp, np.arange(0, (count + 1) * BLOCK, BLOCK)[:count + 1], axis=0)
        h = np.maximum(np.maximum(best[:-1], best[1:]), 0)
        total += h.sum(0, dtype=np.float64)
        top, n = np.maximum(top, h.max(0)), n + len(h)
    z = (total / n) @ model.p["mean"] + top @ model.p["top"] + model.p["bias"][0]
    return float(1 / (1 + np.exp(-float(z))))


def quality(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS,
            fit_chars: int = FIT_CHARS) -> DataFrame:
    """Per document: whether it is held out, its score and the prediction."""
    bounded_batches(docs)
    net = fit(docs, labels, fit_rows=fit_rows, fit_chars=fit_chars)
    score = scorer(net, docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for b in score(batches, 1):
            yield b.select(["doc_id", "score"])

    return src.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents (same columns) that score at least ``threshold``; the network learns from ``labelled_docs``."""
    bounded_batches(docs)
    net = fit(labelled_docs, labels)
    score = scorer(net, docs.sparkSession)
    text_at, width = docs.columns.index("text"), len(docs.columns)

    def run(batches):
        for b in score(batches, text_at):
            keep = np.asarray(b.column(width)) >= threshold
            yield pa.RecordBatch.from_arrays(list(b.columns)[:width], b.schema.names[:width]).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)

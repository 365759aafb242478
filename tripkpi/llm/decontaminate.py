"""Benchmark decontamination: a hash set of normalised test n-grams against token windows.

Text is lower-cased (A-Z) and cut into words of digits, letters and everything
beyond ASCII. Every run of 10 item words is a window; a shorter item is one
window. The fingerprints of all windows go to every task, each document's
windows are looked up (bitmap, then binary search) and a hit counts only if
its words equal the window's. No shuffle: documents are read once.

The broadcast is bounded: past ``max_windows`` windows the set is cut into
blocks by fingerprint, one scan each, and the blocks' hits are merged per
document, so a benchmark of any size gives the same rows.

Defined cases: null or wordless text has n_words 0 and no hits; null item
texts give no windows; a null item_id counts as an item named ``null``;
repeated documents each get their own row; an empty table gives no rows;
input columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm import textvec as V
from tripkpi.llm.tables import Shared, bounded_batches, staged

WINDOW = 10
MAX_WINDOWS = 1 << 18
BITS = 24

HITS_SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
               "contaminated boolean, item_ids array<string>, hit_words array<struct<lo:int,hi:int>>")


def _arrow_words(col: pa.Array) -> Iterator[tuple[int, V.Words]]:
    data, offsets, _ = V.utf8(col)
    for lo, hi in V.slices(offsets):
        yield lo, V.Words(data, offsets, lo, hi, V.ALNUM)


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """One row per window of an item: fingerprint, word count, normalised words, item."""
    def cut(batches):
        for b in batches:
            for lo, w in _arrow_words(b.column(1)):
                h = w.hashes()
                out = []
                for r in range(w.rows):
                    n = int(w.count[r])
                    if not n:
                        continue
                    size, at = min(window, n), int(w.first[r])
                    for i in range(at, at + n - size + 1):
                        words = b" ".join(w.text[w.start[k]:w.end[k]].tobytes() for k in range(i, i + size))
                        out.append((i, size, words, b.column(0)[lo + r].as_py()))
                rows: dict[int, np.ndarray] = {}
                for size in {o[1] for o in out}:
                    at, fp = w.windows(h, size)
                    rows[size] = dict(zip(at.tolist(), fp.view(np.int64).tolist()))
                yield pa.RecordBatch.from_pydict({
                    "fp": pa.array([rows[o[1]][o[0]] for o in out], pa.int64()),
                    "size": pa.array([o[1] for o in out], pa.int32()),
                    "words": pa.array([o[2] for o in out], pa.binary()),
                    "item_id": pa.array([o[3] for o in out], pa.string())})

    ids = F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item_id")
    return items.select(ids, F.col(text_col).cast("string").alias("text")).mapInArrow(
        cut, "fp long, size int, words binary, item_id string").distinct()


class Probe:
    """Looks up a batch of words in one block of the window set."""

    def __init__(self, rows: pa.Table):
        """``rows``: fp, size, words, item_id. Held as sorted arrays, about 90 bytes for a window of ten words."""
        fp = np.asarray(rows.column("fp")).astype(np.int64).view(np.uint64)
        sizes = np.asarray(rows.column("size"))
        names, item = np.unique(np.array(rows.column("item_id").to_pylist(), object), return_inverse=True)
        self.names = names.tolist()
        packed = rows.column("words").combine_chunks().cast(pa.large_binary())
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            own = own[np.argsort(fp[own], kind="stable")]
            words = packed.take(pa.array(own))
            _, off, data = words.buffers()
            offsets = np.frombuffer(off, np.int64)[words.offset:words.offset + len(own) + 1].copy()
            text = np.frombuffer(data, np.uint8).copy() if data is not None else np.zeros(0, np.uint8)
            bits = np.zeros(1 << BITS, bool)
            bits[fp[own] >> np.uint64(64 - BITS)] = True
            self.by_size[size] = fp[own], np.packbits(bits), offsets, text, item[own].astype(np.int32)

    def hits(self, w: V.Words) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, words, items) of each verified occurrence."""
        h = w.hashes()
        for size, (fps, bits, offsets, text, item) in self.by_size.items():
            at, fp = w.windows(h, size)
            top = fp >> np.uint64(64 - BITS)
            maybe = np.flatnonzero((bits[top >> np.uint64(3)] >> (7 - (top & np.uint64(7))).astype(np.uint8)) & 1)
            maybe = maybe[np.isin(fp[maybe], fps)] if len(maybe) else maybe
            for k in maybe:
                i = int(at[k])
                words = b" ".join(w.text[w.start[j]:w.end[j]].tobytes() for j in range(i, i + size))
                a, z = np.searchsorted(fps, fp[k], "left"), np.searchsorted(fps, fp[k], "right")
                items = [self.names[item[j]] for j in range(a, z) if text[offsets[j]:offsets[j + 1]].tobytes() == words]
                if items:
                    yield i, size, items


def _digest(n_words: int, runs: list[tuple[int, int]], items: set[str]) -> tuple:
    merged: list[list[int]] = []
    for lo, hi in sorted(runs):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    names = sorted(items)
    n_hit = sum(hi - lo for lo, hi in merged)
    return (n_words, n_hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), n_hit > 0, names,
            [{"lo": lo, "hi": hi} for lo, hi in merged])


def _batch(ids: list, digests: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*digests)) if digests else [[]] * 7
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()),
             pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))]
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids", "hit_words"]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())] + [pa.array(list(c), t) for c, t in zip(cols, types)],
                                      ["doc_id"] + names)


def _blocks(items: DataFrame, window: int, max_windows: int, item_id: str, item_text: str) -> list:
    """Broadcasts of at most about ``max_windows`` windows each."""
    grams = item_windows(items, window, item_id, item_text)
    blocks = max(1, -(-grams.count() // max_windows))
    if blocks > 1:
        grams = staged(grams, "windows")
    return [Shared(items.sparkSession, Probe(grams.where(F.pmod(F.xxhash64("fp"), F.lit(blocks)) == k).toArrow()))
            for k in range(blocks)]


def contamination(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, max_windows: int = MAX_WINDOWS,
                  id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """One row per document: words, hit words, items hit, and the hit word ranges."""
    bounded_batches(docs)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = _blocks(items, window, max_windows, item_id, item_text)
    if len(held) == 1:
        return src.mapInArrow(_scan(held[0]), HITS_SCHEMA)
    return _merged(src.withColumn("text_key", F.xxhash64("text")), [_scan(h) for h in held]).drop("text_key")


def _scan(held):
    def scan(batches):
        probe = held.value
        for b in batches:
            ids = b.column(0).to_pylist()
            for lo, w in _arrow_words(b.column(1)):
                runs: dict[int, list] = {}
                found: dict[int, set] = {}
                for i, size, names in probe.hits(w):
                    r = int(w.row[i])
                    at = i - int(w.first[r])
                    runs.setdefault(r, []).append((at, at + size))
                    found.setdefault(r, set()).update(names)
                yield _batch(ids[lo:lo + w.rows], [_digest(int(w.count[r]), runs.get(r, []), found.get(r, set()))
                                                   for r in range(w.rows)])
    return scan


def _merged(keyed: DataFrame, scans: list) -> DataFrame:
    """Hits of several blocks per row: equal rows (same id and text) share their merged result."""
    hit = None
    for scan in scans:
        def tagged(batches, scan=scan):
            for b in batches:
                at, keys = 0, b.column(2)
                for out in scan([b]):
                    yield out.append_column("text_key", keys.slice(at, out.num_rows))
                    at += out.num_rows
        part = keyed.mapInArrow(tagged, HITS_SCHEMA + ", text_key long").where("contaminated").dropDuplicates(
            ["doc_id", "text_key"])
        hit = part if hit is None else hit.unionByName(part)
    per_row = hit.groupBy("doc_id", "text_key").agg(F.collect_list("hit_words").alias("parts"),
                                                    F.collect_list("item_ids").alias("items")).alias("p")

    def sizes(batches):
        for b in batches:
            n = [int(c) for _, w in _arrow_words(b.column(1)) for c in w.count]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())],
                                             ["doc_id", "text_key", "n_words"])

    def merge(batches):
        for b in batches:
            rows = b.to_pylist()
            out = _batch([r["doc_id"] for r in rows],
                         [_digest(r["n_words"], [(x["lo"], x["hi"]) for part in r["parts"] or [] for x in part],
                                  {i for part in r["items"] or [] for i in part}) for r in rows])
            yield out.append_column("text_key", b.column(1))

    counted = keyed.mapInArrow(sizes, "doc_id long, text_key long, n_words long").alias("c")
    joined = counted.join(per_row, F.col("c.doc_id").eqNullSafe(F.col("p.doc_id"))
                          & F.col("c.text_key").eqNullSafe(F.col("p.text_key")), "left")
    return joined.select("c.doc_id", "c.text_key", "c.n_words", "p.parts", "p.items").mapInArrow(
        merge, HITS_SCHEMA + ", text_key long")


def remove_spans(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The documents (same columns) without their hit words; other documents keep their text to the byte.

    A hit range is cut from the start of its first word to the end of its last;
    the text around it stays as it is. A document whose words were all hit goes.
    ``n_chars``, where present, follows the text.
    """
    bounded_batches(docs)
    held = _blocks(items, window, max_windows, "item_id", "text")
    text_at = docs.columns.index("text")
    chars_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    if len(held) == 1:
        return docs.mapInArrow(_cutter(text_at, chars_at, len(docs.columns), held[0]), docs.schema)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = _merged(src.withColumn("text_key", F.xxhash64("text")), [_scan(h) for h in held]).where("contaminated")
    hits = hits.select(F.col("doc_id").alias("hit_id"), "text_key", F.col("hit_words").alias("_hit_words")).dropDuplicates(
        ["hit_id", "text_key"])
    d, h = docs.alias("d"), hits.alias("h")
    both = d.join(h, F.col("d.doc_id").cast("long").eqNullSafe(F.col("h.hit_id"))
                  & (F.xxhash64(F.col("d.text")) == F.col("h.text_key")), "left").select("d.*", "h._hit_words")
    return both.mapInArrow(_cutter(text_at, chars_at, len(docs.columns), None), docs.schema)


def _cutter(text_at: int, chars_at: int | None, width: int, held):
    """Cuts hit words: looked up in a block, or given as the last column."""
    def masks(b, lo: int, w: V.Words) -> dict[int, np.ndarray]:
        hit: dict[int, np.ndarray] = {}
        if held is not None:
            found = ((int(w.row[i]), i - int(w.first[w.row[i]]), size) for i, size, _ in held.value.hits(w))
        else:
            given = b.column(width).slice(lo, w.rows).to_pylist()
            found = ((r, x["lo"], x["hi"] - x["lo"]) for r, runs in enumerate(given) for x in runs or [])
        for r, at, size in found:
            hit.setdefault(r, np.zeros(int(w.count[r]), bool))[at:at + size] = True
        return hit

    def cut(batches):
        for b in batches:
            texts, gone = {}, set()
            for lo, w in _arrow_words(b.column(text_at)):
                for r, mask in masks(b, lo, w).items():
                    if mask.all():
                        gone.add(lo + r)
                        continue
                    a, z, f = int(w.bounds[r]), int(w.bounds[r + 1]), int(w.first[r])
                    keep = np.ones(z - a, bool)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                    for s, e in zip(edge[::2], edge[1::2]):
                        keep[w.start[f + s] - a:w.end[f + e - 1] - a] = False
                    texts[lo + r] = w.raw[a:z][keep].tobytes().decode()
            arrays = list(b.columns)[:width]
            if texts:
                for at, new in ((text_at, lambda t: t), (chars_at, len)):
                    if at is not None:
                        col = arrays[at].to_pylist()
                        for r, t in texts.items():
                            col[r] = new(t)
                        arrays[at] = pa.array(col, arrays[at].type)
            b = pa.RecordBatch.from_arrays(arrays, b.schema.names[:width])
            if gone:
                b = b.filter(pa.array([i not in gone for i in range(b.num_rows)]))
            yield b
    return cut

"""Sharding by sampled splitters; law ``bytes``: the shards' sizes are near equal.

A row's key is its text's 64-bit hash, so equal texts are neighbours. A
size-weighted sample of keys (of groups of rows alike in id and text, which are
summed map-side) gives quantile boundaries that cut the key space
into many ranges, far more than shards. The ranges' true bytes are summed over
all rows; a range above its allowance is subdivided, first by further sampled
splitters inside it, and where one key alone is too large (a hot group of
copies) by a second key, the hash of the id, and where rows are alike in both by
a third, a hash of their numbers in the staged table. Ranges are then dealt to shards, largest first to
the lightest shard. Slots number the rows of a shard gaplessly: the range's
offset plus the row's number inside the range.

The driver sees only samples and range totals, both bounded by parameters
(``shards * ranges_per_shard`` ranges, as many again from subdividing, and
``samples_per_range`` keys for each). No task sorts a whole shard.

Defined cases: null text has 0 bytes (size 16) and a key of its own; null and
repeated ids are ordinary rows, and rows alike in id and text are split like
any others (which of them goes where is not fixed); an empty table gives no rows; input columns
other than id and text are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripkpi.llm.tables import bounded_batches, staged

SHARDS = 40
OVERHEAD = 16
RANGES_PER_SHARD = 32
SAMPLES_PER_RANGE = 8
LOWEST = -(1 << 63)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, k1, k2, k3): the record's size and its three keys; no texts."""
    text = F.col(text_col).cast("string")
    raw = F.coalesce(text, F.lit("")).cast("binary")
    doc_id = F.col(id_col).cast("long")
    return docs.select(doc_id.alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(raw).cast("long").alias("text_crc32"),
                       F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text)).alias("k1"),
                       F.xxhash64(doc_id, F.lit(7)).alias("k2"),
                       F.xxhash64(F.monotonically_increasing_id()).alias("k3"))


def _sample(groups: DataFrame, key: str, rate: float) -> dict[int, dict[int, float]]:
    """Per range, keys of groups drawn with probability bytes * rate (at most 1) by a hash, and their weights.

    A group is all rows alike in both keys, so a hot one is drawn for certain, as one row.
    """
    u = F.pmod(F.xxhash64("k2", "k1", F.lit("sample")), F.lit(1 << 52)) / float(1 << 52)
    out: dict[int, dict[int, float]] = {}
    for r in groups.where(u < F.col("bytes") * rate).select("range_no", key, "bytes").collect():
        own = out.setdefault(r[0], {})
        own[r[1]] = own.get(r[1], 0.0) + max(r[2], 1.0 / rate)
    return out


def _quantiles(drawn: dict[int, float], pieces: int) -> list[int]:
    """Boundaries that cut the weighted sample into ``pieces`` equal parts; a key worth more than one is a part of its own."""
    total = sum(drawn.values())
    out: list[int] = []
    seen, goal = 0.0, 1
    for key in sorted(drawn):
        seen += drawn[key]
        passed = 0
        while goal < pieces and seen >= total * goal / pieces:
            passed, goal = passed + 1, goal + 1
        if passed > 1 and key > LOWEST and (not out or out[-1] < key - 1):
            out.append(key - 1)
        if passed:
            out.append(key)
    return out


def _even(pieces: int) -> list[int]:
    """Boundaries that cut the space of hashes into equal parts."""
    return [LOWEST + (1 << 64) * k // pieces for k in range(1, pieces)]


def ranges(keys: DataFrame, shards: int, ranges_per_shard: int, samples_per_range: int) -> DataFrame:
    """Adds ``range_no``: keys cut at sampled boundaries, overfull ranges subdivided."""
    pieces = shards * ranges_per_shard
    groups = staged(keys.groupBy("k1", "k2").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    placed = keys.withColumn("range_no", F.lit(0).cast("long"))
    if not total:
        return placed
    allowed = total / pieces
    groups = groups.withColumn("range_no", F.lit(0).cast("long"))
    # the whole key space, then ranges above twice their allowance; by the second key, which parts equal texts, and the
    # third, which parts equal rows, only those above a quarter of a shard
    large = max(2, ranges_per_shard / 4)
    for key, limit in (("k1", 2), ("k1", 2), ("k2", large), ("k3", large)):
        found = groups.groupBy("range_no").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).where(
            F.col("bytes") > limit * allowed)
        full = {r["range_no"]: r["bytes"] for r in (found if key != "k3" else found.where("n = 1")).collect()}
        if not full:
            continue
        if key == "k3":
            cuts = {k: _even(-(-v // max(1, int(allowed)))) for k, v in full.items()}
        else:
            drawn = _sample(groups.where(F.col("range_no").isin(list(full))), key, samples_per_range / allowed)
            cuts = {k: _quantiles(v, -(-full[k] // max(1, int(allowed)))) for k, v in drawn.items()}
            groups = _place(groups, key, cuts)
        placed = _place(placed, key, cuts)
    return placed


def _place(rows: DataFrame, key: str, cuts: dict[int, list[int]]) -> DataFrame:
    """Range numbers anew: ranges with boundaries are cut at them, numbers leave room for the new ones."""
    held = rows.sparkSession.sparkContext.broadcast({k: np.array(v, np.int64) for k, v in cuts.items() if v})
    room = max([len(v) + 1 for v in cuts.values()], default=1)

    def number(batches):
        for b in batches:
            at = b.schema.get_field_index("range_no")
            old, keys = np.asarray(b.column(at)), np.asarray(b.column(b.schema.get_field_index(key)))
            new = old * room
            for r in np.intersect1d(old, list(held.value)).tolist():
                m = old == r
                new[m] += np.searchsorted(held.value[r], keys[m], "left")
            yield b.set_column(at, "range_no", pa.array(new, pa.int64()))

    return rows.mapInArrow(number, rows.schema)


def deal(totals: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int]]:
    """(range, shard, first slot): ranges (number, bytes, rows) go largest first to the lightest shard."""
    heap = [(0, s) for s in range(shards)]
    rows = [0] * shards
    out = []
    for no, size, n in sorted(totals, key=lambda t: (-t[1], t[0])):
        load, s = heapq.heappop(heap)
        out.append((no, s, rows[s]))
        rows[s] += n
        heapq.heappush(heap, (load + size, s))
    return out


def shard(docs: DataFrame, *, shards: int = SHARDS, ranges_per_shard: int = RANGES_PER_SHARD,
          samples_per_range: int = SAMPLES_PER_RANGE) -> DataFrame:
    """One row per document: its size, shard and slot under the law ``bytes``."""
    bounded_batches(docs)
    spark = docs.sparkSession
    keys = staged(keyed(docs), "shard-keys")
    placed = ranges(keys, shards, ranges_per_shard, samples_per_range)
    totals = [(r["range_no"], r["bytes"], r["n"]) for r in
              placed.groupBy("range_no").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()]
    plan = spark.createDataFrame(deal(totals, shards), "range_no long, shard int, first_slot long")
    inside = Window.partitionBy("range_no").orderBy("k1", "k2", "doc_id", "k3")
    numbered = placed.withColumn("n", F.row_number().over(inside) - 1)
    return numbered.join(plan, "range_no").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first_slot") + F.col("n")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

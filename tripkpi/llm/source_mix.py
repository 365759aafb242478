"""Mixing sources to target weights by slots, permutations and blocks.

Each source's documents, in order of id, are one stream of tokens (words
between white space), packed into blocks of ``block`` tokens; the last block
of a source may be shorter. A source's target is its weighted share of the
mix, at most ``max_repeats`` times its size (the excess is shared again by
weight). The slots that fill the target are dealt to output shards: each
shard draws its source counts from a multinomial over what the sources still
owe (a multinomial conditioned on the totals, so that targets are met to the
token rather than on average). Slot k of a source reads block perm(k) of pass
k // blocks, where perm is a seeded Feistel permutation of the block numbers,
and blocks are joined by number. A source's last slot is cut to the tokens
still owed.

Only one row per source reaches the driver. Positions in a stream come from
two-level prefix sums (sub-streams of about sqrt(n) documents), so a source
that holds a third of all rows is spread over many tasks.

Defined cases: null or wordless text has size 0 and takes 0; null is a source
of its own, last in order; repeated ids are separate documents, told apart by
their text's hash (equal rows: the draws of their joint range are split in
order); sources without tokens have target 0; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripkpi.llm import textvec as V
from tripkpi.llm.tables import bounded_batches, staged

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEATS = 2.0
BLOCK = 256
SHARDS = 64
SEED = 20240229
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Source:
    source: str | None
    rank: int
    docs: int
    size: int
    target: float
    words: int
    blocks: int
    slots: int


def targets(sizes: list[int], weights: list[float], share: float = SHARE, cap: float = MAX_REPEATS) -> list[float]:
    """Shares of ``share`` times all sizes by weight, none above ``cap`` times its size."""
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = cap * float(sizes[i])
        open_ -= set(full)
        left = share * sum(sizes) - sum(out[i] for i in range(len(sizes)) if i not in open_)
    return out


def _round_keys(rank: int, turn: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(key=[seed, rank * 4 + turn])).integers(0, 1 << 62, 4, dtype=np.uint64)


def permute(k: np.ndarray, n: int, rank: int, turn: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 at k: a 4-round Feistel network, walked until it falls below n."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = _round_keys(rank, turn, seed)

    def once(x):
        a, b = x >> half, x & low
        for key in (keys if not inverse else keys[::-1]):
            if inverse:
                a, b = b ^ (V.mix(a ^ key) & low), a
            else:
                a, b = b, a ^ (V.mix(b ^ key) & low)
        return (a << half) | b

    out = once(k.astype(np.uint64))
    while (far := np.flatnonzero(out >= np.uint64(n))).size:
        out[far] = once(out[far])
    return out.astype(np.int64)


def plan_source(source, rank: int, docs: int, size: int, target: float, block: int, seed: int) -> Source:
    """Slots that reach round(target) tokens exactly, given where the short last block falls in each pass."""
    words = min(int(round(target)), int(MAX_REPEATS) * size) if size else 0
    n = -(-size // block)
    slots = 0
    if words:
        short = n * block - size
        tails = sorted(turn * n + int(permute(np.array([n - 1]), n, rank, turn, seed, inverse=True)[0]) for turn in (0, 1))
        slots = -(-words // block)
        for t in tails:
            if t < slots:
                slots = -(-(words + short * sum(x <= t for x in tails)) // block)
                slots = max(slots, t + 1)
        while slots and slots * block - short * sum(x < slots for x in tails) < words:
            slots += 1
        while slots and (slots - 1) * block - short * sum(x < slots - 1 for x in tails) >= words:
            slots -= 1
    return Source(source, rank, docs, size, target, words, n, slots)


def shard_counts(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each source in each shard: multinomial draws conditioned on the sources' totals."""
    rng = np.random.Generator(np.random.Philox(key=[seed, 1 << 40]))
    left = np.array(slots, np.int64)
    out = np.zeros((shards, len(slots)), np.int64)
    for s in range(shards):
        want = int(left.sum()) // (shards - s)
        if s == shards - 1:
            out[s] = left
        elif want:
            # sequential conditional draws: exact for any totals
            rest, total = want, int(left.sum())
            for i, n in enumerate(left.tolist()):
                total -= n
                if rest <= 0:
                    break
                got = _hypergeometric(rng, n, total, rest)
                out[s, i] = got
                rest -= got
        left = left - out[s]
    return out


def _hypergeometric(rng, good: int, bad: int, draws: int) -> int:
    if bad == 0:
        return min(good, draws)
    if good == 0:
        return 0
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    # beyond numpy's range: two binomial draws of one probability, given that they add up to ``draws``, have this law;
    # about sqrt(2 pi draws (1 - draws / (good + bad))) of them are needed
    p = draws / (good + bad)
    while True:
        own = rng.binomial(good, p, 1 << 16)
        hit = np.flatnonzero(own + rng.binomial(bad, p, 1 << 16) == draws)
        if len(hit):
            return int(own[hit[0]])


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, tie): no texts."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(F.col(source_col).cast("string"), text).alias("tie"))


def plan_sources(sizes: DataFrame, weights=WEIGHTS, share=SHARE, block=BLOCK, seed=SEED) -> list[Source]:
    rows = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("size")).collect()
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    goal = targets([r["size"] for r in rows], [weights[i % len(weights)] for i in range(len(rows))], share)
    return [plan_source(r.source, i, r.docs, r["size"], goal[i], block, seed) for i, r in enumerate(rows)]


def _sources_frame(spark, sources: list[Source]) -> DataFrame:
    schema = ("source string, rank int, docs long, source_size long, target double, words long, "
              "blocks long, slots long")
    return spark.createDataFrame([(s.source, s.rank, s.docs, s.size, s.target, s.words, s.blocks, s.slots)
                                  for s in sources], schema)


def sub_stream():
    """A document's sub-stream, by id and text: null or repeated ids of a source spread over all of them."""
    return F.pmod(F.xxhash64("doc_id", "tie"), F.ceil(F.sqrt("docs")).cast("long"))


def streams(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds each document's first token in its source's stream, documents in hashed sub-streams of about sqrt(n)."""
    src = sources.select(F.col("source").alias("s"), "rank", "docs", "source_size", "target")
    d = sizes.join(src, sizes.source.eqNullSafe(F.col("s"))).drop("s")
    d = d.withColumn("part", sub_stream())
    order = Window.partitionBy("rank", "part").orderBy("doc_id", "tie")
    d = d.withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    parts = d.groupBy("rank", "part").agg(F.sum("size").alias("part_size"))
    per_rank = Window.partitionBy("rank").orderBy("part")
    starts = parts.select("rank", "part", F.coalesce(F.sum("part_size").over(
        per_rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    d = d.join(starts, ["rank", "part"])
    return d.withColumn("start", F.col("part_start") + F.coalesce("before", F.lit(0))).drop("before", "part", "part_start")


def draws(spark, sources: list[Source], block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per slot: shard, source rank, pass, block number, tokens read from the block's start."""
    counts = shard_counts([s.slots for s in sources], shards, seed)
    first = np.concatenate([np.zeros((1, len(sources)), np.int64), np.cumsum(counts, axis=0)])
    runs = [(sh, s.rank, int(first[sh, s.rank]), int(counts[sh, s.rank]), s.blocks, s.slots, s.words, s.size)
            for sh in range(shards) for s in sources if counts[sh, s.rank]]
    frame = spark.createDataFrame(runs, "shard int, rank int, lo long, n long, blocks long, slots long, "
                                        "words long, size long")
    # slot ranges of at most 64 Ki, so that a large source is drawn by many tasks
    frame = frame.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / 65536))))
    # so many partitions in any case: the runs are few bytes, which Spark would take for one task's work
    ranges = sum(-(-r[3] // 65536) for r in runs)
    frame = frame.repartition(max(1, min(ranges, int(spark.conf.get("spark.sql.shuffle.partitions")))), "shard", "rank", "at")

    def slots(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                k = np.arange(r.lo + r.at * 65536, r.lo + min(r.n, (r.at + 1) * 65536))
                turn = k // r.blocks
                idx = np.empty(len(k), np.int64)
                for t in np.unique(turn):
                    m = turn == t
                    idx[m] = permute(k[m] - t * r.blocks, r.blocks, r.rank, int(t), seed)
                length = np.where(idx == r.blocks - 1, r.size - (r.blocks - 1) * block, block)
                if len(k) and k[-1] == r.slots - 1:
                    # the source's last slot: all before it are whole
                    tails = [t * r.blocks + int(permute(np.array([r.blocks - 1]), r.blocks, r.rank, t, seed, True)[0])
                             for t in (0, 1)]
                    short = r.blocks * block - r.size
                    done = (r.slots - 1) * block - short * sum(x < r.slots - 1 for x in tails)
                    length[-1] = min(length[-1], r.words - done)
                yield pd.DataFrame({"shard": r.shard, "rank": r.rank, "slot": k, "turn": turn, "block_no": idx,
                                    "take": length})

    return frame.mapInPandas(slots, "shard int, rank int, slot long, turn long, block_no long, take long")


def pieces(placed: DataFrame, drawn: DataFrame, block: int = BLOCK) -> DataFrame:
    """The drawn word ranges of each document: blocks joined by number, one row per document, block and draw."""
    own = placed.where("size > 0").select(
        "doc_id", "tie", "rank", "start", "size", F.explode(F.sequence(
            F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block_no"))
    # the draws grow with the corpus but come from a small table of runs: their estimated size must not
    # make Spark broadcast them
    both = own.join(drawn.hint("merge"), ["rank", "block_no"])
    lo = F.greatest(F.col("start"), F.col("block_no") * block) - F.col("start")
    hi = F.least(F.col("start") + F.col("size"), F.col("block_no") * block + F.col("take")) - F.col("start")
    return both.select("doc_id", "tie", "rank", "start", "shard", "slot", "turn", lo.alias("lo"),
                       hi.alias("hi")).where("hi > lo")


def mix(docs: DataFrame, *, weights=WEIGHTS, share: float = SHARE, block: int = BLOCK, shards: int = SHARDS,
        seed: int = SEED) -> DataFrame:
    """Per document: size, its source's size and target, and the words the mix takes from it."""
    bounded_batches(docs)
    spark = docs.sparkSession
    sizes = staged(sized(docs), "mix-sizes")
    sources = plan_sources(sizes, weights, share, block, seed)
    placed = streams(sizes, _sources_frame(spark, sources))
    taken = pieces(placed, draws(spark, sources, block, shards, seed), block).groupBy(
        "doc_id", "tie", "rank", "start").agg(F.sum(F.col("hi") - F.col("lo")).alias("got"))
    p, t = placed.alias("p"), taken.alias("t")
    # zero-size rows may share a start with their successor and must not take its words
    return p.join(t, F.col("p.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("p.rank") == F.col("t.rank"))
                  & F.col("p.tie").eqNullSafe(F.col("t.tie")) & (F.col("p.start") == F.col("t.start"))
                  & (F.col("p.size") > 0), "left").select(
        "p.doc_id", "p.size", "p.source_size", "p.target", F.coalesce("t.got", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, *, weights=WEIGHTS, share: float = SHARE, block: int = BLOCK,
                    shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix as documents (same columns): one row per document and pass, its text the drawn word ranges.

    Adjacent ranges are joined, others separated by a line feed; ``n_chars``
    follows the text. Documents of which nothing was drawn are left out.
    """
    bounded_batches(docs)
    spark = docs.sparkSession
    sizes = staged(sized(docs), "mix-sizes")
    sources = plan_sources(sizes, weights, share, block, seed)
    placed = streams(sizes, _sources_frame(spark, sources))
    got = pieces(placed, draws(spark, sources, block, shards, seed), block).groupBy(
        "doc_id", "tie", "rank", "start", "turn").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("runs"))
    # equal rows (id, source, text) are interchangeable: they are numbered on both sides
    no_id = F.lit(-(1 << 63)).cast("long")
    copies = Window.partitionBy("mix_id", "mix_key").orderBy("mix_start")
    got = got.select(F.coalesce("doc_id", no_id).alias("mix_id"), F.col("tie").alias("mix_key"),
                     F.col("start").alias("mix_start"), F.col("runs").alias("mix_runs"))
    got = got.withColumn("mix_copy", F.dense_rank().over(copies))
    names, fields = docs.columns, docs.schema
    text_at, chars_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    # the documents' columns go by number, so that none clashes with those of the mix
    own = docs.select(*[F.col(f"`{n}`").alias(f"mix_own_{i}") for i, n in enumerate(names)],
                      F.coalesce(F.col("doc_id").cast("long"), no_id).alias("mix_own_id"),
                      F.xxhash64(F.col("source").cast("string"), F.col("text").cast("string")).alias("mix_own_key"))
    own = own.withColumn("mix_no", F.row_number().over(
        Window.partitionBy("mix_own_id", "mix_own_key").orderBy(F.lit(0))))
    # the copy numbers stay out of the join keys: both sides keep the windows' partitioning
    both = own.join(got, (F.col("mix_own_id") == F.col("mix_id")) & (F.col("mix_own_key") == F.col("mix_key"))
                    & (F.col("mix_no") - F.col("mix_copy") == 0))

    def cut(batches):
        for pdf in batches:
            pdf = pdf.copy()
            new = [V.word_ranges(t, _joined(r)) for t, r in zip(pdf.iloc[:, text_at], pdf["mix_runs"])]
            pdf.isetitem(text_at, new)
            if chars_at is not None:
                pdf.isetitem(chars_at, [len(t) for t in new])
            pdf = pdf.iloc[:, :len(names)]
            pdf.columns = names
            yield pdf

    return both.select(*[f"mix_own_{i}" for i in range(len(names))], "mix_runs").mapInPandas(cut, fields)


def _joined(runs) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for r in runs:
        lo, hi = (r["lo"], r["hi"])
        if out and out[-1][1] == lo:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]

"""Approximate nearest neighbours by inner product: a hierarchical k-means tree searched best bin first.

The tree is fitted on the driver from a bounded sample (``SAMPLE`` vectors):
each node splits its sample into ``BRANCH`` clusters until ``LEAF`` vectors
are left. Every vector is then indexed by descending the tree. A query walks
the tree through a priority queue, always opening the node whose centre has
the largest inner product with it, and collects leaves in that order. How many
leaves it visits is calibrated: for ``CALIBRATION`` vectors the true
neighbours are found by scanning all rows, and the visits are widened until
their mean recall reaches ``TARGET`` (in the limit every leaf, which is exact).

Equal vectors are one class, indexed once with its ``k + 1`` smallest ids: no
other copy can be among a query's ``k`` nearest, ties going to smaller ids. So
a vector that a third of all rows share costs one row in the search, and its
queries are answered once. Leaves are packed into units of bounded size, large
leaves are split over several. A unit's vectors come first in its partition,
each sent once, and the queries that visit one of its leaves stream past them
in batches, however many they are; each query's best per unit are merged.
Scores are recomputed for the best on the original vectors, in double precision.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do vectors of another length than most rows have
(ties: the shorter) and rows with a null id; repeated ids are candidates once
for each distinct vector; fewer candidates give fewer rows; an empty table
gives no rows; input columns other than id and embedding are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripkpi.llm.tables import Shared, bounded_batches, staged

K = 20
QUERY_EVERY = 20
SAMPLE = 16384
BRANCH = 8
LEAF = 64
CALIBRATION = 128
TARGET = 0.96
SEED = 5


class Tree:
    """Nodes of a hierarchical k-means tree; ``children`` of node i are rows of ``centre``."""

    def __init__(self, sample: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.centre, self.children, self.leaf_no = [sample.mean(0)], [[]], [-1]
        self.leaves = 0
        todo = [(0, sample)]
        while todo:
            node, rows = todo.pop()
            parts = _split(rows, branch, rng) if len(rows) > leaf else []
            if len(parts) < 2:
                self.leaf_no[node] = self.leaves
                self.leaves += 1
                continue
            for centre, part in parts:
                self.children[node].append(len(self.centre))
                self.centre.append(centre)
                self.children.append([])
                self.leaf_no.append(-1)
                todo.append((len(self.centre) - 1, part))
        self.centre = np.stack(self.centre)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: at every node the child with the nearest centre."""
        out = np.full(len(x), -1)
        todo = [(0, np.arange(len(x)))]
        half = (self.centre ** 2).sum(1) / 2
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf_no[node]
                continue
            near = (x[rows] @ self.centre[kids].T - half[kids]).argmax(1)
            for i, kid in enumerate(kids):
                if (near == i).any():
                    todo.append((kid, rows[near == i]))
        return out

    def visit(self, queries: np.ndarray, count: int) -> list[list[int]]:
        """Best bin first: the first ``count`` leaves of each query."""
        score = -(queries @ self.centre.T)
        out = []
        for s in score.tolist():
            heap, found = [(s[0], 0)], []
            while heap and len(found) < count:
                _, node = heapq.heappop(heap)
                kids = self.children[node]
                if not kids:
                    found.append(self.leaf_no[node])
                for kid in kids:
                    heapq.heappush(heap, (s[kid], kid))
            out.append(found)
        return out


def _split(rows: np.ndarray, branch: int, rng, rounds: int = 8) -> list[tuple[np.ndarray, np.ndarray]]:
    """k-means clusters (centre, members) of the rows, without empty ones."""
    centre = rows[rng.choice(len(rows), branch, replace=False)]
    for _ in range(rounds):
        near = (rows @ centre.T - (centre ** 2).sum(1) / 2).argmax(1)
        used = np.unique(near)
        centre = np.stack([rows[near == i].mean(0) for i in used])
    near = (rows @ centre.T - (centre ** 2).sum(1) / 2).argmax(1)
    return [(rows[near == i].mean(0), rows[near == i]) for i in np.unique(near)]


def _stack(column, size: int) -> np.ndarray:
    """(rows, size) doubles of an Arrow list column without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, size)


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, vector) of the rows that take part, and the vectors' length."""
    v = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    v = v.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0)
                & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                & F.exists("vector", lambda x: x != 0))
    sizes = v.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = sizes["size"] if sizes else 0
    return v.where(F.size("vector") == size), size


def classes(vectors: DataFrame, copies: int) -> DataFrame:
    """(rep, first, vector, ids): distinct vectors, numbered, with their ``copies`` smallest ids."""
    first = Window.partitionBy("vector").orderBy("vec_id")
    some = vectors.distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= copies)
    ids = some.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    # a repeated id may stand for several vectors: the class number keeps them apart
    return ids.select(F.xxhash64("ids", "vector").alias("rep"), F.col("ids")[0].alias("first"), "vector", "ids")


def _scan(block: np.ndarray, queries: np.ndarray, first: np.ndarray, k: int, allowed: np.ndarray | None = None):
    """(query, row of block, score) of each query's best k rows, ties to the smaller ``first``.

    Scores are summed alike for all pairs; the matrix product only picks the
    rows that may be among the best, whatever its rounding.
    """
    got = queries @ block.T
    if allowed is not None:
        got[~allowed] = -np.inf
    if k < got.shape[1]:
        least = np.partition(got, got.shape[1] - k, axis=1)[:, -k]
        scale = np.sqrt((queries ** 2).sum(1) * (block ** 2).sum(1).max())
        q, r = np.nonzero((got >= (least - 1e-9 * scale)[:, None]) & np.isfinite(got))
    else:
        q, r = np.nonzero(np.isfinite(got))
    exact = np.einsum("ij,ij->i", queries[q], block[r])
    order = np.lexsort((first[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    top = np.arange(len(q)) - np.searchsorted(q, q, "left") < k
    return q[top], r[top], exact[top]


def calibrate(indexed: DataFrame, tree: Tree, size: int, k: int, queries: int = CALIBRATION, target: float = TARGET) -> int:
    """The number of leaf visits at which ``queries`` vectors find ``target`` of their true neighbours.

    The vectors, chosen by a hash, are few enough to broadcast; all rows are
    scanned in blocks and the best per task merged, so the driver gets
    ``queries * (k + 1)`` rows however large the index is.
    """
    spark = indexed.sparkSession
    picked = indexed.orderBy(F.xxhash64("rep", F.lit("calibrate"))).limit(queries).select("rep", "vector").collect()
    q = np.array([r["vector"] for r in picked], np.float64)
    names = [r["rep"] for r in picked]
    held = spark.sparkContext.broadcast(q)

    def scan(batches):
        for b in batches:
            block, reps = _stack(b.column(1), size), np.asarray(b.column(0))
            i, r, s = _scan(block, held.value, reps, k + 1)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(reps[r]),
                                              pa.array(np.asarray(b.column(2))[r]), pa.array(s)], ["q", "rep", "leaf", "score"])

    best = indexed.select("rep", "vector", "leaf").mapInArrow(scan, "q int, rep long, leaf int, score double")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    true = best.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).collect()
    places = [{leaf: i for i, leaf in enumerate(v)} for v in tree.visit(q, tree.leaves)]
    ranks = sorted(places[r["q"]][r["leaf"]] for r in true if r["rep"] != names[r["q"]])
    if not ranks:
        return tree.leaves
    return ranks[min(len(ranks) - 1, int(np.ceil(target * len(ranks))) - 1)] + 1


def _pack(counts: dict[int, int], rows: int) -> dict[int, tuple[int, int]]:
    """leaf -> (first unit, units): small leaves share a unit of about ``rows`` rows, large ones get several."""
    plan, unit, load = {}, 0, 0
    for leaf in sorted(counts):
        n = counts[leaf]
        if n > rows:
            if load:
                unit, load = unit + 1, 0
            parts = -(-n // rows)
            plan[leaf] = (unit, parts)
            unit += parts
            continue
        if load + n > rows:
            unit, load = unit + 1, 0
        plan[leaf] = (unit, 1)
        load += n
    return plan


def search(table: DataFrame, *, k: int = K, query_every: int = QUERY_EVERY, sample: int = SAMPLE, target: float = TARGET,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of every row whose id is divisible by ``query_every``."""
    bounded_batches(table)
    spark = table.sparkSession
    vectors, size = valid_vectors(table, id_col, vector_col)
    found = classes(vectors, k + 1)
    found = staged(found, "ann-classes")
    count = found.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not count:
        return spark.createDataFrame([], schema)

    u = F.pmod(F.xxhash64("rep", F.lit("tree")), F.lit(1 << 40)) / float(1 << 40)
    rows = found.where(u < min(1.0, sample / count)).select("rep", "vector").collect()
    rows = sorted(rows, key=lambda r: r["rep"])[:2 * sample] or found.limit(1).select("rep", "vector").collect()
    tree = Tree(np.array([r["vector"] for r in rows], np.float64))
    held = Shared(spark, tree)

    def index(batches):
        for b in batches:
            yield b.append_column("leaf", pa.array(held.value.assign(_stack(b.column(1), size)).astype(np.int32)))

    indexed = staged(found.select("rep", "vector", "first").mapInArrow(
        index, "rep long, vector array<double>, first long, leaf int"), "ann-index")
    visits = calibrate(indexed, tree, size, k, target=target)
    counts = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}
    # every unit a query visits returns k + 1 rows, so units grow with the index, up to what a task holds
    unit_rows = min(1 << 17, max(1 << 10, count // 16))
    plan = spark.sparkContext.broadcast(_pack(counts, unit_rows))

    # one search per distinct query vector
    asked = vectors.where(F.pmod("vec_id", F.lit(query_every)) == 0).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    by_vector = found.select(F.col("rep").alias("query"), F.col("vector").alias("v"))
    asked = staged(asked.join(by_vector, F.col("vector") == F.col("v")).select("query_id", "query"), "ann-queries")
    distinct = found.join(asked.select("query").distinct(), F.col("rep") == F.col("query"), "left_semi").select("rep", "vector")

    def place(batches):
        for b in batches:
            leaf, reps = np.asarray(b.column(3)), np.asarray(b.column(0))
            unit = np.array([plan.value[x][0] for x in leaf.tolist()])
            parts = np.array([plan.value[x][1] for x in leaf.tolist()])
            yield b.append_column("unit", pa.array((unit + (reps.view(np.uint64) % parts.astype(np.uint64)).astype(np.int64)).astype(np.int32)))

    def route(batches):
        for b in batches:
            vec, reps = _stack(b.column(1), size), b.column(0).to_pylist()
            for at in range(0, len(reps), 512):
                out = []
                for rep, x, leaves in zip(reps[at:], vec[at:at + 512], held.value.visit(vec[at:at + 512], visits)):
                    per_unit: dict[int, list[int]] = {}
                    for leaf in leaves:
                        unit, parts = plan.value.get(leaf, (0, 0))
                        for p in range(parts):
                            per_unit.setdefault(unit + p, []).append(leaf)
                    out += [(rep, x, leaf, unit) for unit, leaf in per_unit.items()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.float64())),
                    pa.array([o[2] for o in out], pa.list_(pa.int32())), pa.array([o[3] for o in out], pa.int32())],
                    ["rep", "vector", "leaves", "unit"])

    rows_ = indexed.mapInArrow(place, "rep long, vector array<double>, first long, leaf int, unit int").select(
        "unit", F.lit(0).alias("side"), "rep", "vector", "first", F.array("leaf").alias("leaves"))
    asks = distinct.mapInArrow(route, "rep long, vector array<double>, leaves array<int>, unit int").select(
        "unit", F.lit(1).alias("side"), "rep", "vector", F.lit(None).cast("long").alias("first"), "leaves")

    def nearest(batches):
        unit, parts, block = None, [], None
        for b in batches:
            t = pa.Table.from_batches([b])
            units, side = t.column("unit").to_numpy(), t.column("side").to_numpy()
            cuts = np.flatnonzero((np.diff(units) != 0) | (np.diff(side) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(units)]):
                if hi == lo:
                    continue
                rows = t.slice(lo, hi - lo).combine_chunks()
                if units[lo] != unit:
                    unit, parts, block = units[lo], [], None
                vec = _stack(rows.column("vector").combine_chunks(), size)
                if side[lo] == 0:
                    parts.append((vec, *(np.asarray(x) for x in (rows.column("rep"), rows.column("first"),
                                                                 rows.column("leaves").combine_chunks().flatten()))))
                    continue
                if not parts:
                    continue
                if block is None:
                    block = [np.concatenate(x) for x in zip(*parts)]
                    parts = [block]
                    kinds, col = np.unique(block[3], return_inverse=True)
                queries, leaves = np.asarray(rows.column("rep")), rows.column("leaves").to_pylist()
                step = max(16, (1 << 22) // len(block[0]))
                for at in range(0, len(queries), step):
                    seen = np.stack([np.isin(kinds, x) for x in leaves[at:at + step]])
                    i, r, s = _scan(block[0], vec[at:at + step], block[2], k + 1, seen[:, col])
                    yield pa.RecordBatch.from_arrays([pa.array(queries[at:at + step][i]), pa.array(block[1][r]), pa.array(s)],
                                                     ["query", "rep", "score"])

    hits = rows_.union(asks).repartition("unit").sortWithinPartitions("unit", "side").mapInArrow(
        nearest, "query long, rep long, score double")
    # equal scores of different classes are ordered by id below; keep all that tie with the last one wanted
    best = hits.withColumn("n", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(F.col("n") <= k + 1)
    ids = found.select("rep", "ids")
    listed = best.join(ids, "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    top = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1)
    lists = listed.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    answer = asked.join(lists, "query").select("query_id", F.posexplode(F.filter(
        "near", lambda x: x["vec_id"] != F.col("query_id"))).alias("pos", "x")).where(F.col("pos") < k)
    return answer.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                         F.col("x.score").alias("score"))

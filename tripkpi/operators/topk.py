"""Exact top-k per month without exchanging every key.

``kpis.top_k`` exchanges the count of every key that a task met. Here a
threshold decides which keys can be among the k at all:

1. An ``approx_top_k`` sketch per month (one bounded state a task) names
   candidates. They need not be the right ones.
2. One aggregation counts the candidates exactly and all other trips by a hash
   bucket of their key: at most ``candidates + buckets`` rows a task and month
   are exchanged. The k-th largest candidate count is a lower bound for the
   k-th largest count of all keys; a bucket's total is an upper bound for every
   key in it.
3. Only keys in buckets that reach the month's bound are counted one by one.
   Usually these are few, and months without any are not read (the buckets are
   a small join side from which Spark prunes the partitions).

The result is exact whatever the candidates. What is saved depends on the
data: much where few keys lead (station pairs), nothing where all keys are
about equally frequent, because then every bucket reaches the bound. It reads
the input three times, so give it a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.operators.kpis import MONTH
from tripkpi.session import scratch_path

TRACKED = 10_000            # keys a sketch follows per month
BUCKETS = 1 << 16           # hash buckets per month


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _candidates(rows: DataFrame, k: int, tracked: int) -> DataFrame:
    """``year, month, cand``: likely top keys of each month."""
    sketch = rows.groupBy(*MONTH).agg(F.expr(f"approx_top_k(key, {4 * k}, {tracked})").alias("tops"))
    return _written(sketch.select(*MONTH, F.explode("tops.item").alias("cand")), "topk-candidates")


def _tagged(rows: DataFrame, candidates: DataFrame, buckets: int) -> DataFrame:
    """Rows with ``is_cand`` and, for the others, ``bucket``."""
    own = candidates.withColumn("is_cand", F.lit(True)).withColumnsRenamed({"year": "_y", "month": "_m"})
    on = (F.col("year") == F.col("_y")) & (F.col("month") == F.col("_m")) & F.col("key").eqNullSafe(F.col("cand"))
    bucket = F.when(F.col("is_cand").isNull(), F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return rows.join(own, on, "left").select(*MONTH, "key", "is_cand", bucket.alias("bucket"))


def survivors(base: DataFrame, key: str, k: int = S.TOP_K, tracked: int = TRACKED,
              buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """(candidates' exact counts, trips of all other keys that can still reach the month's bound)."""
    rows = base.select(*MONTH, F.col(key).cast("string").alias("key"))
    candidates = _candidates(rows, k, tracked)
    tagged = _tagged(rows, candidates, buckets)
    counts = _written(tagged.groupBy(*MONTH, "is_cand", F.when(F.col("is_cand"), F.col("key")).alias("key"), "bucket")
                      .agg(F.count(F.lit(1)).alias("n")), "topk-counts")
    exact = counts.where("is_cand").select(*MONTH, "key", "n")
    rank = F.row_number().over(Window.partitionBy(*MONTH).orderBy(F.desc("n")))
    bound = (exact.withColumn("rk", rank).where(F.col("rk") <= k).groupBy(*MONTH)
             .agg(F.when(F.count("*") == k, F.min("n")).otherwise(F.lit(1)).alias("bound")))
    others = counts.where("is_cand is null")
    alive = (others.join(bound, MONTH, "left").where(F.col("n") >= F.coalesce("bound", F.lit(1)))
             .select(F.col("year").alias("_y"), F.col("month").alias("_m"), F.col("bucket").alias("_b")))
    alive = _written(alive, "topk-buckets")
    left = tagged.where("is_cand is null").join(
        alive, (F.col("year") == F.col("_y")) & (F.col("month") == F.col("_m")) & (F.col("bucket") == F.col("_b")), "left_semi")
    return exact, left.select(*MONTH, "key")


def threshold_top_k(base: DataFrame, key: str, k: int = S.TOP_K, tracked: int = TRACKED, buckets: int = BUCKETS) -> DataFrame:
    """``year, month, <key>, n, rk``: the rows of `kpis.top_k`, ties broken by key ascending, nulls last."""
    exact, rest = survivors(base, key, k, tracked, buckets)
    counts = exact.unionByName(rest.groupBy(*MONTH, "key").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy(*MONTH).orderBy(F.col("n").desc(), F.col("key").asc_nulls_last())
    return (counts.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)
            .select(*MONTH, F.col("key").cast(base.schema[key].dataType).alias(key), "n", "rk"))

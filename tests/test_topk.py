"""Exact top-k by bounds and survivors against the plain aggregation."""

import random

import pytest
from pyspark.sql import functions as F

from tripkpi.operators import kpis as K
from tripkpi.operators import topk as T

KEYS = "year int, month int, bike_id string"


def rows_of(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def skewed(spark, n=60_000):
    """Two months in which 40 keys lead and most keys occur once or twice, ties and null keys included."""
    i = F.col("id")
    lead = F.concat(F.lit("lead"), (F.pow(F.pmod(F.xxhash64(i), F.lit(1000)) / 1000.0, 3) * 40).cast("int"))
    key = F.when(i % 3 == 0, lead).when(i % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("rare"), F.pmod(F.xxhash64(i, F.lit(1)), F.lit(n))))
    return spark.range(n).select(F.lit(2016).alias("year"), (i % 2 + 1).cast("int").alias("month"), key.alias("bike_id")).repartition(7)


def test_skewed_keys_and_what_is_exchanged(spark):
    df = skewed(spark)
    assert rows_of(T.threshold_top_k(df, "bike_id", tracked=1000)) == rows_of(K.top_k(df, "bike_id"))
    all_keys = df.select("year", "month", "bike_id").distinct().count()
    _, rest = T.survivors(df, "bike_id", tracked=1000)
    assert rest.distinct().count() * 10 < all_keys


@pytest.mark.parametrize("tracked,buckets", [(10, 4), (64, 1), (1000, 1 << 16)])
def test_poor_candidates_and_few_buckets_stay_exact(spark, tracked, buckets):
    df = skewed(spark, 3000)
    got = T.threshold_top_k(df, "bike_id", k=3, tracked=max(tracked, 12), buckets=buckets)
    assert rows_of(got) == rows_of(K.top_k(df, "bike_id", 3))


def test_flat_counts_ties_and_short_months(spark):
    rng = random.Random(2)
    rows = [(2015, 1 + k % 4, rng.choice([None, "a", "b", "ä", ""] + [f"k{j}" for j in range(60)])) for k in range(900)]
    rows += [(2016, 1, "one"), (2016, 2, None), (2016, 3, "x"), (2016, 3, "y")]
    df = spark.createDataFrame(rows, KEYS).repartition(5)
    assert rows_of(T.threshold_top_k(df, "bike_id")) == rows_of(K.top_k(df, "bike_id"))
    assert T.threshold_top_k(df.limit(0), "bike_id").count() == 0


def test_other_key_types(spark):
    df = spark.createDataFrame([(2015, 1, i % 17 if i % 5 else None) for i in range(500)], "year int, month int, gender int")
    got = T.threshold_top_k(df, "gender")
    assert got.schema["gender"].dataType.simpleString() == "int"
    # ties order by the key as text here
    assert sorted(r.n for r in got.collect()) == sorted(r.n for r in K.top_k(df, "gender").collect())

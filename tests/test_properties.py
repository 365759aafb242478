"""Property tests (hypothesis) for the scalar and aggregate rules."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripkpi.functions import columns as C
from tripkpi.operators import kpis as K

cents = st.integers(min_value=0, max_value=144000)


@settings(max_examples=15, deadline=None)
@given(values=st.lists(cents, min_size=1, max_size=40), parts=st.integers(min_value=1, max_value=7))
def test_exact_mean_is_half_up_and_partition_independent(spark, values, parts):
    rows = [(2016, 1, v / 100.0) for v in values]
    df = spark.createDataFrame(rows, "year int, month int, x double").repartition(parts)
    df = df.withColumn("x_cents", F.rint(F.col("x") * 100).cast("bigint"))
    got = df.groupBy("year", "month").agg(K._avg_or_null("x_cents").alias("m")).first().m
    mean = (Decimal(sum(values)) / Decimal(len(values)) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got == (None if sum(values) == 0 else float(mean))


coord = st.tuples(st.floats(min_value=-80, max_value=80), st.floats(min_value=-179, max_value=179))


@settings(max_examples=10, deadline=None)
@given(pairs=st.lists(st.tuples(coord, coord), min_size=1, max_size=20))
def test_haversine_symmetric_and_zero(spark, pairs):
    rows = [(a[0], a[1], b[0], b[1]) for a, b in pairs]
    df = spark.createDataFrame(rows, "la1 double, lo1 double, la2 double, lo2 double")
    out = df.select(C.haversine_m("la1", "lo1", "la2", "lo2").alias("ab"),
                    C.haversine_m("la2", "lo2", "la1", "lo1").alias("ba"),
                    C.haversine_m("la1", "lo1", "la1", "lo1").alias("aa")).collect()
    for r in out:
        assert abs(r.ab - r.ba) <= 0.011 and r.aa == 0.0 and 0 <= r.ab <= 20037509


@settings(max_examples=10, deadline=None)
@given(hours=st.lists(st.integers(min_value=0, max_value=23), min_size=1, max_size=24),
       minutes=st.integers(min_value=0, max_value=59))
def test_time_slot_matches_hour_band(spark, hours, minutes):
    rows = [(f"2016-03-04 {h:02d}:{minutes:02d}:00", h) for h in hours]
    df = spark.createDataFrame(rows, "s string, h int")
    out = df.select("h", C.time_slot(C.parse_timestamp("s")).alias("slot")).collect()
    labels = ["00:00-06:00", "06:00-12:00", "12:00-18:00", "18:00-24:00"]
    assert all(r.slot == labels[r.h // 6] for r in out)

"""KPI operators: one-pass report vs single KPIs, properties, edge months."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tripkpi.operators import kpis as K
from tripkpi.schemas import CLEAN_TRIP_SCHEMA
from tripkpi.sources import driver_tables as D


@pytest.fixture(scope="module")
def clean(spark, sf_small):
    return D.clean_trips(spark, sf_small).cache()


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_long_report_equals_single_kpis(spark, clean):
    base = K.kpi_base(clean)
    long = K.kpi_report_long(clean).cache()
    pairs = [("gender", K.gender_share(base), "gender", "pct"),
             ("age_group", K.age_share(base), "age_group", "pct"),
             ("time_slot", K.timeslot_share(base), "time_slot", "pct"),
             ("bike", K.top_bikes(base), "bike_id", "rk"),
             ("start_station", K.top_start_stations(base), "start_station_name", "rk"),
             ("end_station", K.top_end_stations(base), "end_station_name", "rk")]
    for kpi, single, key, extra in pairs:
        got = _rows(long.filter(F.col("kpi") == kpi), ["year", "month", "key", "n", extra])
        want = _rows(single.withColumn("key", F.col(key).cast("string")), ["year", "month", "key", "n", extra])
        assert got == want, kpi


def test_shares_sum_to_100(spark, clean):
    long = K.kpi_report_long(clean)
    sums = (long.filter(F.col("pct").isNotNull()).groupBy("year", "month", "kpi")
            .agg(F.sum("pct").alias("s")).collect())
    assert sums and all(abs(r.s - 100.0) <= 0.05 for r in sums)


def test_topk_bounded_and_ordered(spark, clean):
    tops = K.top_bikes(K.kpi_base(clean)).collect()
    by_month = {}
    for r in tops:
        by_month.setdefault((r.year, r.month), []).append((r.rk, r.n))
    for ranks in by_month.values():
        ranks.sort()
        assert len(ranks) <= 10
        assert [rk for rk, _ in ranks] == list(range(1, len(ranks) + 1))
        assert all(a[1] >= b[1] for a, b in zip(ranks, ranks[1:]))


def trip(bike, start_name="A", gender=1, birth=1980, month=1, hour=8):
    t0 = dt.datetime(2016, month, 3, hour, 0)
    return (12.0, t0, t0 + dt.timedelta(minutes=12), "1", start_name, "2", "B", bike, birth, gender,
            1500.0, "06:00-12:00" if 6 <= hour < 12 else "18:00-24:00", 2016, month)


def test_ties_at_rank_ten_break_by_key(spark):
    rows = [trip(f"b{i:02d}") for i in range(12)] + [trip("b11")]
    df = spark.createDataFrame(rows, CLEAN_TRIP_SCHEMA)
    tops = K.top_bikes(K.kpi_base(df)).orderBy("rk").collect()
    assert [r.bike_id for r in tops] == ["b11"] + [f"b{i:02d}" for i in range(9)]


def test_edge_months_in_wide_report(spark):
    rows = ([trip("x", gender=None, birth=None, month=1)] +                 # no gender, no age
            [trip("y", gender=2, birth=1990, month=2, hour=20), trip("z", gender=1, birth=1900, month=2)])
    df = spark.createDataFrame(rows, CLEAN_TRIP_SCHEMA)
    wide = {r.month: r for r in K.kpi_report_wide(df).collect()}
    jan, feb = wide[1], wide[2]
    assert jan.age_distribution == [] and jan.gender_1_pct is None and jan.n_trips == 1
    assert jan.timeslot_06_12_pct == 100.0 and jan.timeslot_18_24_pct is None
    assert [(a.age_group, a.pct) for a in feb.age_distribution] == [("20-29", 100.0)]   # 116 is out
    assert (feb.gender_1_pct, feb.gender_2_pct, feb.gender_0_pct) == (50.0, 50.0, None)
    assert [b.key for b in feb.top_bikes] == ["y", "z"]
    assert feb.avg_trip_duration_min == 12.0 and feb.avg_trip_distance_km == 1.5


def test_wide_report_has_every_month(spark, clean):
    months = clean.select("year", "month").distinct().count()
    assert K.kpi_report_wide(clean).count() == months


def test_avg_zero_is_null(spark):
    rows = [trip("x")]
    df = spark.createDataFrame(rows, CLEAN_TRIP_SCHEMA).withColumn("trip_distance_m", F.lit(0.0))
    assert K.avg_distance(K.kpi_base(df)).first().avg_trip_distance_km is None


def test_gender_pivot_discovers_codes(spark):
    rows = [trip("a", gender=1), trip("b", gender=7), trip("c", gender=None)]
    df = spark.createDataFrame(rows, CLEAN_TRIP_SCHEMA)
    fixed = K.gender_pivot(K.kpi_base(df), codes=[0, 1, 2]).first()
    found = K.gender_pivot(K.kpi_base(df)).first()
    wide = K.kpi_report_wide(df).first()
    assert [(g.code, g.pct) for g in wide.gender_distribution] == [(1, 50.0), (7, 50.0)]
    assert (fixed.gender_0_pct, fixed.gender_1_pct, fixed.gender_2_pct) == (None, 50.0, None)
    assert (found.gender_1_pct, found.gender_7_pct) == (50.0, 50.0)


def test_hot_key_is_preaggregated_and_exact(spark):
    """One bike and one station hold a third of all trips: counts stay exact and
    the hot key is combined map-side before any shuffle."""
    import contextlib
    import io
    rows = [trip(f"b{i % 200}", start_name=f"S{i % 50}") for i in range(1200)]
    rows += [trip("hot", start_name="HOT") for _ in range(600)]
    df = spark.createDataFrame(rows, CLEAN_TRIP_SCHEMA).repartition(6)
    wide = K.kpi_report_wide(df)
    r = wide.first()
    assert (r.top_bikes[0].key, r.top_bikes[0].n) == ("hot", 600)
    assert (r.top_start_stations[0].key, r.top_start_stations[0].n) == ("HOT", 600)
    assert r.n_trips == 1800 and len(r.top_bikes) == 10
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        wide.explain()
    plan = buf.getvalue()
    # the first aggregate below the first exchange is the partial one
    assert re.search(r"HashAggregate\(keys=\[.*spark_grouping_id.*functions=\[partial_count", plan)

"""Validation (F1), station rules (F2, J1/J2) and quality reports."""

import datetime as dt

from pyspark.sql import functions as F

from tripkpi.operators import quality as Q
from tripkpi.operators.joins import join_station_coordinates
from tripkpi.schemas import CLEAN_TRIP_SCHEMA

T0 = dt.datetime(2016, 1, 1, 8, 0, 0)


def trip(dur=10.0, start=T0, end=T0 + dt.timedelta(minutes=10), s="1", e="2", dist=100.0, slot="06:00-12:00"):
    return (dur, start, end, s, "S", e, "E", "b", None, None, dist, slot, 2016, 1)


def n_valid(spark, rows):
    return Q.validate_trips(spark.createDataFrame(rows, CLEAN_TRIP_SCHEMA)).count()


def test_duration_bounds(spark):
    assert n_valid(spark, [trip(dur=0.99)]) == 0
    assert n_valid(spark, [trip(dur=1.0), trip(dur=1440.0)]) == 2
    assert n_valid(spark, [trip(dur=1440.01)]) == 0


def test_distance_bounds(spark):
    assert n_valid(spark, [trip(dist=0.0), trip(dist=50000.0)]) == 2
    assert n_valid(spark, [trip(dist=50000.01)]) == 0
    assert n_valid(spark, [trip(dist=None)]) == 0
    assert n_valid(spark, [trip(dist=float("nan"))]) == 0


def test_time_rules(spark):
    assert n_valid(spark, [trip(end=T0)]) == 0                       # end = start
    assert n_valid(spark, [trip(end=T0 - dt.timedelta(minutes=1))]) == 0
    assert n_valid(spark, [trip(end=None)]) == 0
    assert n_valid(spark, [trip(start=None)]) == 0


def test_station_ids_required(spark):
    assert n_valid(spark, [trip(s=None)]) == 0
    assert n_valid(spark, [trip(e=None)]) == 0


def test_reject_reasons_counts_each_conjunct(spark):
    rows = [trip(), trip(dur=0.5), trip(dist=None, s=None), trip(end=None)]
    r = Q.reject_reasons(spark.createDataFrame(rows, CLEAN_TRIP_SCHEMA)).first()
    assert r.n_rows == 4 and r.n_valid == 1
    assert r.n_bad_duration == 1 and r.n_bad_distance == 1 and r.n_missing_start_station == 1
    assert r.n_missing_end_ts == 1 and r.n_end_not_after_start == 1  # null end is "not after"


def test_station_master_rules(spark):
    st = spark.createDataFrame([("1", 42.0, -71.0), ("2", 95.0, -71.0), ("3", 42.0, -181.0),
                                (None, 42.0, -71.0), ("4", None, -71.0)],
                               "station_id string, latitude double, longitude double")
    assert [r.station_id for r in Q.valid_stations(st).collect()] == ["1"]


def test_station_join_fanout_and_unmatched(spark):
    st = spark.createDataFrame([("1", 42.0, -71.0), ("1", 42.5, -71.5), ("2", 42.1, -71.1)],
                               "station_id string, latitude double, longitude double")
    trips = spark.createDataFrame([("1", "2"), ("9", "2")], "start_station_id string, end_station_id string")
    j = join_station_coordinates(trips, st)
    assert j.filter(F.col("start_station_id") == "1").count() == 2      # duplicate id fans out
    un = j.filter(F.col("start_station_id") == "9").first()
    assert un.start_latitude is None and un.end_latitude == 42.1         # unmatched -> null coords
    dd = join_station_coordinates(trips, st, dedupe=True)
    assert dd.filter(F.col("start_station_id") == "1").first().start_latitude == 42.0
    assert Q.station_duplicates(st).first().station_id == "1"
    assert [r.station_id for r in Q.unmatched_stations(trips, st).collect()] == ["9"]


def test_required_columns_check(spark):
    import pytest
    df = spark.createDataFrame([(1,)], "year int")
    with pytest.raises(ValueError, match="missing required columns"):
        Q.check_required_columns(df)
    empty = spark.createDataFrame([], CLEAN_TRIP_SCHEMA)
    with pytest.raises(ValueError, match="empty"):
        Q.check_required_columns(empty)


def test_station_join_same_result_without_broadcast(spark):
    st = spark.createDataFrame([(str(i), 42.0 + i / 1000, -71.0) for i in range(50)],
                               "station_id string, latitude double, longitude double")
    trips = spark.createDataFrame([(str(i % 60) if i % 5 else None, str((i * 7) % 50)) for i in range(200)],
                                  "start_station_id string, end_station_id string")
    small = join_station_coordinates(trips, st)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = join_station_coordinates(trips, st)
        rows = big.collect()
        import contextlib
        import io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            big.explain()
        assert "SortMergeJoin" in buf.getvalue() and "BroadcastHashJoin" not in buf.getvalue()
        assert "SinglePartition" not in buf.getvalue()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    key = lambda r: tuple("" if v is None else str(v) for v in
                          (r.start_station_id, r.end_station_id, r.start_latitude, r.end_latitude))
    assert sorted(rows, key=key) == sorted(small.collect(), key=key)
    assert sum(r.start_station_id is None for r in rows) == 40          # null ids kept, unmatched
    assert all(r.start_latitude is None for r in rows if r.start_station_id is None)


def test_station_quality_and_unmatched_in_one_pass(spark):
    raw = spark.createDataFrame([("1", 42.0, -71.0), ("1", 42.1, -71.0), ("2", 95.0, -71.0), ("3", None, 0.0), (None, 1.0, 1.0)],
                                "station_id string, latitude double, longitude double")
    assert tuple(Q.station_quality(raw).first()) == (5, 2, 3, 1)
    assert tuple(Q.station_quality(raw.limit(0)).first()) == (0, 0, 0, 0)
    trips = spark.createDataFrame([("1", "9"), ("2", None), (None, "9")], "start_station_id string, end_station_id string")
    left = Q.unmatched_stations(trips, Q.valid_stations(raw))
    assert sorted(r.station_id for r in left.collect()) == ["2", "9"]
    assert left._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2

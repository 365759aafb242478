"""Physical-plan checks: pruning, pushdown, broadcast, one scan for the report."""

import re

import pytest

from tripkpi.operators import kpis as K
from tripkpi.plans import fixtures as X
from tripkpi.plans.queries import QUERIES
from tripkpi.sources import driver_tables as D
from tripkpi.sources import parquet as PQ


def formatted(df):
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def clean_path(spark, sf_small):
    return X.write_clean_table(spark, sf_small)


def test_month_slice_prunes_partitions(spark, clean_path):
    text = formatted(PQ.read_month(spark, clean_path, 1995, 3))
    assert re.search(r"PartitionFilters: \[.*year.*= 1995.*month.*= 3", text)


def test_station_join_broadcasts_small_dimension(spark, sf_small):
    tree = formatted(QUERIES["station_join"](spark, sf_small)).split("\n\n")[0]
    assert tree.count("BroadcastHashJoin LeftOuter") == 2


def test_report_scans_clean_table_once(spark, clean_path):
    wide = K.kpi_report_wide(PQ.read_clean_trips(spark, clean_path, validate=False))
    text = formatted(wide)
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    assert "Expand" in tree and "WindowGroupLimit" in tree
    # only the needed columns reach the scan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "trip_start_ts" not in schema and "start_station_id" not in schema


def test_long_report_scans_once(spark, clean_path):
    tree = formatted(K.kpi_report_long(PQ.read_clean_trips(spark, clean_path, validate=False)))
    tree = tree.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") <= 3
    assert "WindowGroupLimit" in tree       # only top-k rows per task reach the rank shuffle


def test_topk_uses_window_group_limit(spark, clean_path):
    base = K.kpi_base(PQ.read_clean_trips(spark, clean_path, validate=False))
    df = K.top_bikes(base)
    df.collect()
    assert "WindowGroupLimit" in formatted(df)


def test_clean_pipeline_stays_in_codegen(spark, sf_small):
    df = D.clean_trips(spark, sf_small)
    df.collect()                                          # AQE: final plan after execution
    text = formatted(df)
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert re.search(r"\* (Project|Filter|BroadcastHashJoin)", text)   # "*" = whole-stage codegen


def test_no_python_in_any_query_plan(spark, sf_small):
    for name in ["kpi_report_wide", "kpi_report_long", "reject_reasons", "unmatched_stations"]:
        text = formatted(QUERIES[name](spark, sf_small))
        assert "Python" not in text, name


def test_unmatched_stations_scans_each_table_once(spark, sf_small):
    text = formatted(QUERIES["unmatched_stations"](spark, sf_small))
    assert text.count("ReadSchema: struct<l_") == 1 and text.count("ReadSchema: struct<o_") == 1


def test_no_job_while_station_join_is_built(spark, sf_small):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "")
    try:
        before = len(tracker.getJobIdsForGroup("build-only"))
        from tripkpi.operators.joins import join_station_coordinates
        trips, st = D.trips_raw(spark, sf_small), D.station_raw(spark, sf_small)
        mark = len(tracker.getJobIdsForGroup("build-only"))
        join_station_coordinates(trips, st)
        assert len(tracker.getJobIdsForGroup("build-only")) == mark >= before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

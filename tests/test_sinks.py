"""Sinks: partitioned clean table (K1) with dynamic overwrite, KPI report (K2)."""

from pyspark.sql import functions as F

from tripkpi.operators import kpis as K
from tripkpi.sinks.parquet import read_kpi_report, write_clean_trips, write_kpi_report
from tripkpi.sources import driver_tables as D
from tripkpi.sources import parquet as PQ


def test_dynamic_overwrite_keeps_other_partitions(spark, sf_small, tmp_dir):
    clean = D.clean_trips(spark, sf_small)
    write_clean_trips(clean, tmp_dir)
    before = {(r.year, r.month): r.n for r in PQ.read_clean_trips(spark, tmp_dir)
              .groupBy("year", "month").agg(F.count("*").alias("n")).collect()}
    (y, m), n = sorted(before.items())[0]
    one = PQ.read_month(spark, tmp_dir, y, m).limit(1).toPandas()
    write_clean_trips(spark.createDataFrame(one, PQ.read_clean_trips(spark, tmp_dir).schema), tmp_dir)
    after = {(r.year, r.month): r.n for r in PQ.read_clean_trips(spark, tmp_dir)
             .groupBy("year", "month").agg(F.count("*").alias("n")).collect()}
    assert after[(y, m)] == 1
    assert {k: v for k, v in after.items() if k != (y, m)} == {k: v for k, v in before.items() if k != (y, m)}


def test_roundtrip_schema(spark, sf_small, tmp_dir):
    clean = D.clean_trips(spark, sf_small)
    write_clean_trips(clean, tmp_dir)
    back = PQ.read_clean_trips(spark, tmp_dir)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in clean.schema]
    assert back.count() == clean.count()


def test_kpi_report_sink(spark, sf_small, tmp_dir):
    wide = K.kpi_report_wide(D.clean_trips(spark, sf_small))
    write_kpi_report(wide, tmp_dir)
    back = read_kpi_report(spark, tmp_dir)
    assert back.count() == wide.count()
    assert dict(back.dtypes)["top_bikes"].startswith("array<struct")
    write_kpi_report(wide, tmp_dir + "-json", fmt="json")
    assert read_kpi_report(spark, tmp_dir + "-json", fmt="json").count() == wide.count()


def test_report_replaces_all_years(spark, sf_small, tmp_dir):
    wide = K.kpi_report_wide(D.clean_trips(spark, sf_small))
    write_kpi_report(wide, tmp_dir)
    years = {r.year for r in read_kpi_report(spark, tmp_dir).select("year").distinct().collect()}
    gone = min(years)
    write_kpi_report(wide.where(f"year > {gone}"), tmp_dir)
    assert {r.year for r in read_kpi_report(spark, tmp_dir).select("year").distinct().collect()} == years - {gone}

"""Job entry points (E1-E4) for spark-submit.

    python -m tripkpi.plans.jobs clean-new  --base-path B --output-path P
    python -m tripkpi.plans.jobs clean-old  --base-path B [--stations-path S] --output-path P
    python -m tripkpi.plans.jobs kpis       --input-path P --output-path R [--format parquet|json]
    python -m tripkpi.plans.jobs rebuild    --new-base B1 [--old-base B2] --clean-path P --state-path T
                                            [--kpi-state-path K]
    python -m tripkpi.plans.jobs build-all  --new-base B1 --old-base B2 [--stations-path S]
                                            --clean-path P --kpi-path R [--quality-path Q]

Each job is one Spark application. Raw CSV is read once per layout:
``build-all`` types both layouts and writes the clean table from there; where
it also makes the quality report or the per-file counts, the typed rows are
staged in the shared scratch folder (``spark.checkpoint.dir``) and all of them
come from there. Both layouts are unioned before a single dynamic-overwrite
write, so a month present in both keeps the rows of both.

``--headers discover`` (default) binds every file's columns by its own header;
``known`` reads natively, in one pass, and fails if a file's header differs.

``--quality-path`` gets one folder per report: ``months`` (reject reasons per
month), ``stations`` (station rows read, valid, rejected; duplicated ids),
``station_duplicates`` and ``unmatched_stations`` (ids that trips name and the
station master lacks).
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.operators import kpis
from tripkpi.operators import quality as Q
from tripkpi.plans import incremental, layouts
from tripkpi.session import scratch, shuffles_deleted
from tripkpi.sinks.parquet import write_clean_trips, write_kpi_report
from tripkpi.sources import csv_layouts
from tripkpi.sources.parquet import read_clean_trips
from tripkpi.sources.stations import broadcast_if_few, read_station_csv, read_station_master, station_master

HEADER_MODES = ("discover", "known")


def _known(headers: str) -> bool:
    if headers not in HEADER_MODES:
        raise ValueError(f"headers must be one of {HEADER_MODES}")
    return headers == "known"


def _counted_write(raw: DataFrame, typed_of: Callable[[DataFrame], DataFrame], output: str, **write_options) -> dict[str, int]:
    """Type, validate and write raw rows; the counts are observed by the write itself, without a second scan.

    ``n_read`` raw rows; ``n_before`` typed rows before validation (duplicate
    station ids multiply rows); ``n_valid`` written; ``n_rejected``; and how
    many rows fail each condition. Observed counts are a report: where an
    executor is lost and its tasks run again, Spark may count their rows twice.
    """
    read, typed = Observation(), Observation()
    frame = typed_of(raw.observe(read, F.count(F.lit(1)).alias("n_read")))
    bad = {f"n_{name}": F.count_if(~F.coalesce(ok, F.lit(False))) for name, ok in Q.trip_conditions().items()}
    frame = frame.observe(typed, F.count(F.lit(1)).alias("n_before"),
                          F.count_if(F.coalesce(Q.is_valid_trip(), F.lit(False))).alias("n_valid"),
                          *[c.alias(name) for name, c in bad.items()])
    write_clean_trips(Q.validate_trips(frame), output, **write_options)
    counts = {**read.get, **typed.get}
    return {"n_read": counts["n_read"], "n_before": counts["n_before"], "n_valid": counts["n_valid"],
            "n_rejected": counts["n_before"] - counts["n_valid"], **{name: counts[name] for name in bad}}


def _file_report(typed: DataFrame, path: str) -> None:
    Q.file_counts(typed).write.mode("overwrite").parquet(path)


def clean_new_job(spark: SparkSession, base: str, output: str, headers: str = "discover", file_counts_path: str | None = None,
                  files: dict | None = None, **write_options) -> dict[str, int]:
    """New-layout CSV folders -> partitioned clean table; returns the counts (see `_counted_write`).

    ``files`` overrides the folder and file globs; ``file_counts_path`` gets raw and valid rows of each file.
    A file's folder names its trips' month, so the trips are written as they are read, without a shuffle.
    """
    write_options = {"clustered": True} | write_options
    raw = csv_layouts.scan_new_layout(spark, base, headers_known=_known(headers), **(files or {}))
    if not file_counts_path:
        return _counted_write(raw, layouts.typed_new_layout, output, **write_options)
    with scratch(spark, "typed-new") as path:
        return _counted_and_filed(raw, lambda r: layouts.typed_new_layout(r, passthrough=["source_file"]), path,
                                  output, file_counts_path, **write_options)


def clean_old_job(spark: SparkSession, base: str, output: str, stations_path: str | None = None,
                  dedupe: bool = False, headers: str = "discover", file_counts_path: str | None = None,
                  files: dict | None = None, **write_options) -> dict[str, int]:
    """Old-layout CSV folders + station master -> partitioned clean table; returns the counts, as `clean_new_job`."""
    stations = read_station_master(spark, stations_path or f"{base.rstrip('/')}/{S.STATIONS_FILE_NAME}")
    raw = csv_layouts.scan_old_layout(spark, base, headers_known=_known(headers), **(files or {}))
    if not file_counts_path:
        return _counted_write(raw, lambda r: layouts.typed_old_layout(r, stations, dedupe), output, **write_options)
    with scratch(spark, "typed-old") as path:
        return _counted_and_filed(raw, lambda r: layouts.typed_old_layout(r, stations, dedupe, passthrough=["source_file"]), path,
                                  output, file_counts_path, **write_options)


def _counted_and_filed(raw: DataFrame, typed_of, path: str, output: str, file_counts_path: str, **write_options) -> dict[str, int]:
    """As `_counted_write`, with the typed rows staged for the per-file counts."""
    read = Observation()
    typed_of(raw.observe(read, F.count(F.lit(1)).alias("n_read"))).write.parquet(path)
    typed = raw.sparkSession.read.parquet(path)
    _file_report(typed, file_counts_path)
    return _counted_write(typed, lambda t: t, output, **write_options) | {"n_read": read.get["n_read"]}


def kpi_job(spark: SparkSession, input_path: str, output: str, fmt: str = "parquet") -> DataFrame:
    """Clean table -> KPI report (one row per month, one folder per year)."""
    wide = kpis.kpi_report_wide(read_clean_trips(spark, input_path))
    write_kpi_report(wide, output, fmt)
    return wide


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_all(spark: SparkSession, new_base: str, old_base: str, clean_path: str, kpi_path: str,
              stations_path: str | None = None, quality_path: str | None = None,
              fmt: str = "parquet", headers: str = "discover", file_counts_path: str | None = None,
              new_files: dict | None = None, old_files: dict | None = None) -> None:
    """Both layouts -> one clean table -> KPI report, in one application.

    ``new_files`` / ``old_files`` override the folder and file globs of a layout.
    For the quality report and the file counts, the typed rows are staged once, and deleted at the end; the clean
    table alone takes them as they are read. Of the new layout a file's folder is its month, so those trips are not
    shuffled; the old layout's are, as a year's file holds twelve months.
    """
    with shuffles_deleted(spark):
        with scratch(spark, "typed") as path:
            _build_clean(spark, new_base, old_base, clean_path, stations_path, quality_path, headers, file_counts_path,
                         new_files, old_files, path)
        kpi_job(spark, clean_path, kpi_path, fmt)


def _build_clean(spark, new_base, old_base, clean_path, stations_path, quality_path, headers, file_counts_path,
                 new_files, old_files, path) -> None:
    stations_raw = read_station_csv(spark, stations_path or f"{old_base.rstrip('/')}/{S.STATIONS_FILE_NAME}")
    stations = broadcast_if_few(station_master(stations_raw))
    known = _known(headers)
    raw_new = csv_layouts.scan_new_layout(spark, new_base, headers_known=known, **(new_files or {}))
    raw_old = csv_layouts.scan_old_layout(spark, old_base, headers_known=known, **(old_files or {}))
    new = layouts.typed_new_layout(raw_new, passthrough=["source_file"])
    old = layouts.typed_old_layout(raw_old, stations, passthrough=["source_file"])
    if quality_path or file_counts_path:
        new, old = _staged(new, f"{path}/new"), _staged(old, f"{path}/old")
    by_month = Q.validate_trips(layouts.unify(old)).hint("rebalance", *S.PARTITION_COLUMNS)
    write_clean_trips(layouts.unify(Q.validate_trips(new), by_month), clean_path, clustered=True)
    if quality_path:
        reports = {
            "months": layouts.quality(new, from_folder=True).unionByName(layouts.quality(old, from_folder=False)),
            "stations": Q.station_quality(stations_raw),
            "station_duplicates": Q.station_duplicates(stations_raw),
            "unmatched_stations": Q.unmatched_stations(old, stations),
        }
        for name, report in reports.items():
            report.write.mode("overwrite").parquet(f"{quality_path.rstrip('/')}/{name}")
    if file_counts_path:
        Q.file_counts(new).unionByName(Q.file_counts(old)).write.mode("overwrite").parquet(file_counts_path)


def rebuild_job(spark: SparkSession, new_base: str | None, old_base: str | None, clean_path: str, state_path: str,
                stations_path: str | None = None, kpi_state_path: str | None = None, **write_options) -> DataFrame:
    """Clean only what has changed since the last run (see `plans.incremental`)."""
    sources = [incremental.RawSource(S.NEW_LAYOUT, new_base)] if new_base else []
    if old_base:
        stations = stations_path or f"{old_base.rstrip('/')}/{S.STATIONS_FILE_NAME}"
        sources.append(incremental.RawSource(S.OLD_LAYOUT, old_base, stations_path=stations))
    return incremental.rebuild(spark, sources, clean_path, state_path, kpi_state_path, **write_options)


def _report(counts: dict[str, int]) -> None:
    for name, n in counts.items():
        print(f"{name}: {n}")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tripkpi")
    ap.add_argument("--master", help="e.g. local[8]; omit under spark-submit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("clean-new")
    a.add_argument("--base-path", required=True)
    a.add_argument("--output-path", required=True)
    b = sub.add_parser("clean-old")
    b.add_argument("--base-path", required=True)
    b.add_argument("--stations-path")
    b.add_argument("--output-path", required=True)
    b.add_argument("--dedupe-stations", action="store_true")
    c = sub.add_parser("kpis")
    c.add_argument("--input-path", required=True)
    c.add_argument("--output-path", required=True)
    c.add_argument("--format", default="parquet", choices=["parquet", "json"])
    d = sub.add_parser("build-all")
    d.add_argument("--new-base", required=True)
    d.add_argument("--old-base", required=True)
    d.add_argument("--stations-path")
    d.add_argument("--clean-path", required=True)
    d.add_argument("--kpi-path", required=True)
    d.add_argument("--quality-path")
    d.add_argument("--file-counts-path")
    d.add_argument("--format", default="parquet", choices=["parquet", "json"])
    e = sub.add_parser("rebuild")
    e.add_argument("--new-base")
    e.add_argument("--old-base")
    e.add_argument("--stations-path")
    e.add_argument("--clean-path", required=True)
    e.add_argument("--state-path", required=True)
    e.add_argument("--kpi-state-path")
    for p in (a, b):
        p.add_argument("--file-counts-path")
    for p in (a, b, e):
        p.add_argument("--padded-months", action="store_true", help="write month=01 instead of month=1")
    for p in (a, b, d):
        p.add_argument("--headers", default="discover", choices=HEADER_MODES,
                       help="raw CSV headers: bound per file, or known to be alike (native read, fails if not)")
    args = ap.parse_args(argv)

    from tripkpi.session import get_spark
    spark = get_spark(args.master, app_name=f"tripkpi-{args.cmd}")
    if args.cmd == "clean-new":
        _report(clean_new_job(spark, args.base_path, args.output_path, args.headers, args.file_counts_path,
                              padded_months=args.padded_months))
    elif args.cmd == "clean-old":
        _report(clean_old_job(spark, args.base_path, args.output_path, args.stations_path, args.dedupe_stations,
                              args.headers, args.file_counts_path, padded_months=args.padded_months))
    elif args.cmd == "rebuild":
        rebuild_job(spark, args.new_base, args.old_base, args.clean_path, args.state_path, args.stations_path,
                    args.kpi_state_path, padded_months=args.padded_months)
    elif args.cmd == "kpis":
        kpi_job(spark, args.input_path, args.output_path, args.format)
    else:
        build_all(spark, args.new_base, args.old_base, args.clean_path, args.kpi_path,
                  args.stations_path, args.quality_path, args.format, args.headers,
                  args.file_counts_path)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

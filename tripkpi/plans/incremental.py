"""Incremental rebuild of the clean table: only periods whose raw files changed.

The state folder holds, per run, a snapshot of the raw files (path, size,
modification time) and the lineage: which months of the clean table each raw
period's trips went to, and how many. A run compares the files with the last
snapshot by a full outer join and then

1. cleans the periods that have files added or changed,
2. finds the months they touch now, and those that they or removed periods
   touched before,
3. reads again the unchanged periods that share such a month (both layouts can
   hold one month, and an old-layout year file can hold trips of the next), but
   keeps only their trips of these months,
4. replaces these months by dynamic partition overwrite, deletes the folders of
   months that have no trips left, and
5. writes the new lineage, then the snapshot. A run that fails before that is
   run again with the same result.

The old layout depends on the station master too: its file is part of the
snapshot, and if it changes all old-layout periods count as changed.

The driver sees periods and months, both bounded by the calendar, never files.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.operators.quality import validate_trips
from tripkpi.plans import layouts
from tripkpi.session import drop_path, scratch
from tripkpi.sinks.kpi_state import replace_months
from tripkpi.sinks.parquet import write_clean_trips
from tripkpi.sources import csv_layouts, landing
from tripkpi.sources.parquet import read_clean_trips
from tripkpi.sources.stations import read_station_master

LINEAGE = "source string, folder string, period string, year int, month int, n long"
STATIONS = "stations"
Period = tuple[str, str, str]       # source, folder, period


@dataclass(frozen=True)
class RawSource:
    """Raw CSV folders of one layout; ``stations_path`` for the old one."""

    layout: S.Layout
    base: str
    folder_glob: str | None = None
    file_glob: str = S.RAW_FILE_NAME
    stations_path: str | None = None

    def glob(self, folders: list[str] | None = None) -> str:
        names = "{" + ",".join(sorted(folders)) + "}" if folders else self.folder_glob or "[0-9]" * self.layout.period_digits
        return f"{self.base.rstrip('/')}/{names}/{self.file_glob}"

    def snapshot(self, spark: SparkSession) -> DataFrame | None:
        try:
            files = landing.file_snapshot(spark, self.glob(), self.layout.name, csv_layouts.period_regex(self.layout.period_digits))
        except AnalysisException:
            files = None                                  # no file is left
        if self.stations_path:
            # a folder of parts or one file: its name stands for a period
            own = landing.file_snapshot(spark, self.stations_path, STATIONS, r"([^/]+)/[^/]+$").withColumns(
                {"folder": F.lit(STATIONS), "period": F.lit(STATIONS)})
            files = own if files is None else files.unionByName(own)
        return files

    def clean(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        """Valid trips of the folders, with ``source, folder, period``."""
        raw = csv_layouts.scan_layout(spark, self.glob(folders), self.layout, csv_layouts.period_regex(self.layout.period_digits))
        more = ["period", "source_file"]
        typed = (layouts.typed_new_layout(raw, passthrough=more) if self.layout.has_coordinates else
                 layouts.typed_old_layout(raw, read_station_master(spark, self.stations_path), passthrough=more))
        folder = F.substring_index(F.substring_index("source_file", "/", -2), "/", 1)   # a pattern without a start costs microseconds a row
        return validate_trips(typed).withColumns({"source": F.lit(self.layout.name), "folder": folder}).drop("source_file")


def _state(spark: SparkSession, path: str) -> tuple[int, DataFrame | None, DataFrame | None]:
    """The last complete version: its number, snapshot and lineage."""
    try:
        snapshots = spark.read.parquet(f"{path}/snapshots")
    except AnalysisException:
        return 0, None, None
    version = snapshots.agg(F.max("version")).first()[0]
    if version is None:
        return 0, None, None
    lineage = spark.read.parquet(f"{path}/lineage")
    return version, *(t.where(F.col("version") == version).drop("version") for t in (snapshots, lineage))


def _keep(df: DataFrame, path: str, version: int) -> None:
    (df.withColumn("version", F.lit(version)).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("version").parquet(path))


def rebuild(spark: SparkSession, sources: list[RawSource], clean_path: str, state_path: str,
            kpi_state_path: str | None = None, **write_options) -> DataFrame:
    """Bring the clean table up to date; ``source, period, status`` of the periods that had changed.

    The first run cleans everything. ``kpi_state_path`` names a KPI state table
    (see `sinks.kpi_state`) whose months are replaced along with the table's.
    ``write_options`` go to `write_clean_trips`.
    """
    version, before, lineage = _state(spark, state_path)
    with scratch(spark, "snapshot") as now_path, scratch(spark, "changed-trips") as trips_path:
        found = [f for f in (s.snapshot(spark) for s in sources) if f is not None]
        if not found:
            raise ValueError("no raw file matches any source")
        reduce(DataFrame.unionByName, found).write.parquet(now_path)
        now = spark.read.parquet(now_path)
        before = now.limit(0) if before is None else before.select(*now.columns)
        lineage = spark.createDataFrame([], LINEAGE) if lineage is None else lineage
        changes = landing.changed_periods(landing.snapshot_changes(before, now)).collect()
        report = [(r.source, r.period, r.status) for r in changes]
        changed = {(r.source, r.folder, r.period): r.status for r in changes if r.source != STATIONS}
        if any(r.source == STATIONS for r in changes):
            held = now.where(F.col("source") == S.OLD_LAYOUT.name).select("source", "folder", "period").distinct()
            changed = {tuple(r): "changed" for r in held.collect()} | changed
        if changed:
            _replace(spark, sources, changed, lineage, clean_path, trips_path, kpi_state_path, write_options,
                     lambda new: _keep(new, f"{state_path}/lineage", version + 1))
            _keep(now, f"{state_path}/snapshots", version + 1)
        elif changes:
            _keep(lineage, f"{state_path}/lineage", version + 1)
            _keep(now, f"{state_path}/snapshots", version + 1)
    return spark.createDataFrame(report, "source string, period string, status string")


def _among(df: DataFrame, periods: list[Period]) -> F.Column:
    return F.concat_ws("/", "source", "folder", "period").isin(["/".join(p) for p in periods])


def _replace(spark, sources, changed: dict[Period, str], lineage: DataFrame, clean_path: str, trips_path: str,
             kpi_state_path: str | None, write_options: dict, keep_lineage) -> None:
    """Steps 1 to 5 for the changed periods."""
    fresh = [p for p, status in changed.items() if status != "removed"]
    parts = [s.clean(spark, [f for name, f, _ in fresh if name == s.layout.name]) for s in sources
             if any(name == s.layout.name for name, *_ in fresh)]
    months: set[tuple[int, int]] = set()
    if parts:
        reduce(DataFrame.unionByName, parts).write.parquet(trips_path)
        months |= {tuple(r) for r in spark.read.parquet(trips_path).select("year", "month").distinct().collect()}
    was = lineage.where(_among(lineage, list(changed)))
    months |= {tuple(r) for r in was.select("year", "month").distinct().collect()}
    in_months = F.concat_ws("-", "year", "month").isin([f"{y}-{m}" for y, m in months])
    sharing = lineage.where(in_months & ~_among(lineage, list(changed))).select("source", "folder", "period").distinct().collect()
    trips = [spark.read.parquet(trips_path)] if parts else []
    for s in sources:
        folders = [r.folder for r in sharing if r.source == s.layout.name]
        if folders:
            trips.append(s.clean(spark, folders).where(in_months))
    kept: set[tuple[int, int]] = set()
    if trips:
        whole = reduce(DataFrame.unionByName, [t.select(*S.CLEAN_TRIP_COLUMNS) for t in trips])
        write_clean_trips(whole, clean_path, **write_options)
        others = lineage.where(in_months & ~_among(lineage, list(changed))).select("year", "month").distinct().collect()
        kept = {tuple(r) for r in others}
        if parts:
            kept |= {tuple(r) for r in spark.read.parquet(trips_path).select("year", "month").distinct().collect()}
    width = "02d" if write_options.get("padded_months") else "d"
    for y, m in sorted(months - kept):
        drop_path(spark, f"{clean_path.rstrip('/')}/year={y}/month={m:{width}}")
    if kpi_state_path:
        replace_months(spark, kpi_state_path, read_clean_trips(spark, clean_path, validate=False), sorted(months))
    new = lineage.where(~_among(lineage, list(changed)))
    if parts:
        counted = spark.read.parquet(trips_path).groupBy("source", "folder", "period", "year", "month").agg(F.count("*").alias("n"))
        new = new.unionByName(counted.select(*new.columns))
    keep_lineage(new)

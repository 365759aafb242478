"""Render the driver-table trips as raw CSV files in both layouts.

The file-source and sink queries need real files to read. These writers turn
the derived trips (``sources.driver_tables``) into the raw layouts with Spark
writes under the shared checkpoint folder (``spark.checkpoint.dir``), one
fresh folder per session, so the production readers run on them unchanged.
Spark names folders ``key=value`` and files ``part-*.csv``; the readers take
the matching folder/file globs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.operators import cleaning
from tripkpi.session import drop_path, scratch_path, shuffles_deleted
from tripkpi.sources import driver_tables as D
from tripkpi.sources.stations import few_stations, station_master

NEW_FOLDER_GLOB = "period=" + "[0-9]" * 6
OLD_FOLDER_GLOB = "period=" + "[0-9]" * 4
CSV_FILE_GLOB = "*.csv*"
# Months written with the columns in another order (files of one layout that
# disagree on column order must still be read by name).
REORDERED_MONTHS = [11, 12]

_cache: dict[tuple, str] = {}


def _key(spark: SparkSession, sf_dir: str, kind: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, kind)


def _csv_writer(df: DataFrame, mode: str = "overwrite"):
    return (df.write.mode(mode).option("header", True).option("quote", '"')
            .option("escape", "\\").option("compression", "gzip"))


def _per_folder(keys: DataFrame, months: int = 1) -> DataFrame:
    """Cluster the keys of trips by output folder, which holds so many months of a year, like the raw layout's one
    file per folder (AQE still splits a folder too big for one task). The texts are made after this shuffle."""
    start = D.start_ts()
    return keys.withColumn("_folder", (F.year(start) * 12 + F.month(start) - 1 - (F.month(start) - 1) % months)).hint("rebalance", "_folder")


def _staged_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of trips, joined, clustered by month and written once for all the passes that make raw files of them."""
    k = _key(spark, sf_dir, "keys")
    keys = D.trip_keys(spark, sf_dir)
    if k not in _cache:
        path = scratch_path(spark, "trip-keys")
        with shuffles_deleted(spark):
            _per_folder(keys).drop("_folder").write.option("compression", "zstd").parquet(path)
        _cache[k] = path
    return spark.read.schema(keys.schema).parquet(_cache[k])


def _drop_served_keys(spark: SparkSession, sf_dir: str) -> None:
    """Delete the staged keys once the raw files of both layouts are there."""
    new, old, keys = (_key(spark, sf_dir, kind) for kind in ("new", "old", "keys"))
    if new in _cache and old in _cache and keys in _cache:
        drop_path(spark, _cache.pop(keys))


def _located_per_folder(keys: DataFrame, stations: DataFrame, few: bool) -> DataFrame:
    """Keys of trips that are clustered by folder, with coordinates: broadcast stations leave the clusters as they are."""
    if few:
        return D.locate(keys, F.broadcast(stations))
    return _per_folder(D.locate(keys, stations))


def _in_order(keys: DataFrame, period: F.Column) -> DataFrame:
    """Sorted by the folder's ``period`` (a number) and start, as raw files are. Writing folders needs their rows in
    this order and would sort the texts, which are many times larger than the keys."""
    return keys.withColumn("period", period).sortWithinPartitions("period", D.start_ts())


def _month_number() -> F.Column:
    return F.year(D.start_ts()) * 100 + F.month(D.start_ts())


def _ts(col: str, fmt: str) -> F.Column:
    return F.date_format(F.col(col), fmt)


def new_layout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with station coordinates in the new layout's text form + ``period``."""
    return _new_layout_text(D.located_keys(spark, sf_dir, station_master(D.station_raw(spark, sf_dir))))


def _period(keys: DataFrame, fmt: str) -> tuple[list[str], F.Column]:
    """The period of keys that have one, and what to keep for it; else it comes from the start."""
    return (["period"], F.col("period")) if "period" in keys.columns else ([], _ts("start_ts", fmt).alias("period"))


def _new_layout_text(keys: DataFrame) -> DataFrame:
    lay = S.NEW_LAYOUT
    kept, period = _period(keys, "yyyyMM")
    return D.trips_of(keys, cleaning.COORDINATES + kept).select(
        F.col("dur_s").cast("string").alias(lay.duration),
        _ts("start_ts", "yyyy-MM-dd HH:mm:ss").alias(lay.start),
        _ts("end_ts", "yyyy-MM-dd HH:mm:ss").alias(lay.end),
        F.col("start_station_id").alias(lay.start_id),
        F.col("start_station_name").alias(lay.start_name),
        F.col("start_latitude").cast("string").alias(lay.start_lat),
        F.col("start_longitude").cast("string").alias(lay.start_lon),
        F.col("end_station_id").alias(lay.end_id),
        F.col("end_station_name").alias(lay.end_name),
        F.col("end_latitude").cast("string").alias(lay.end_lat),
        F.col("end_longitude").cast("string").alias(lay.end_lon),
        F.col("bike_id").alias(lay.bike),
        F.lit("Subscriber").alias("usertype"),
        F.col("birth_year_raw").alias(lay.birth_year),
        F.col("gender_raw").alias(lay.gender),
        period,
    )


def old_layout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in the old layout's text form (minute timestamps, ms durations) + ``period``."""
    return _old_layout_text(D.trip_keys(spark, sf_dir))


def _old_layout_text(keys: DataFrame) -> DataFrame:
    lay = S.OLD_LAYOUT
    kept, period = _period(keys, "yyyy")
    return D.trips_of(keys, kept).select(
        F.lit(1).alias("Seq"),
        (F.col("dur_s") * 1000).cast("string").alias(lay.duration),
        _ts("start_ts", S.OLD_LAYOUT_TS_FORMAT).alias(lay.start),
        F.col("start_station_name").alias(lay.start_name),
        F.col("start_station_id").alias(lay.start_id),
        _ts("end_ts", S.OLD_LAYOUT_TS_FORMAT).alias(lay.end),
        F.col("end_station_name").alias(lay.end_name),
        F.col("end_station_id").alias(lay.end_id),
        F.col("bike_id").alias(lay.bike),
        F.lit("Registered").alias("Member type"),
        F.col("gender_raw").alias(lay.gender),
        period,
        F.month("start_ts").alias("_month"),
    )


def write_new_layout(spark: SparkSession, sf_dir: str) -> str:
    """``<base>/period=yyyyMM/part-*.csv``; months 11 and 12 use another column order."""
    k = _key(spark, sf_dir, "new")
    if k in _cache:
        return _cache[k]
    base = scratch_path(spark, "raw-new")
    keys = _staged_keys(spark, sf_dir)
    stations = station_master(D.station_raw(spark, sf_dir))
    few = few_stations(stations)
    is_reordered = F.month(D.start_ts()).isin(REORDERED_MONTHS)
    regular, reordered = (_new_layout_text(_in_order(_located_per_folder(keys.where(some), stations, few), _month_number()))
                          for some in (~is_reordered, is_reordered))
    reordered = reordered.select(*reversed(reordered.columns[:-1]), "period")
    with shuffles_deleted(spark):
        _csv_writer(regular).partitionBy("period").csv(base)
        _csv_writer(reordered, "append").partitionBy("period").csv(base)
    _cache[k] = base
    _drop_served_keys(spark, sf_dir)
    return base


def write_old_layout(spark: SparkSession, sf_dir: str) -> str:
    """``<base>/period=yyyy/part-*.csv`` and the station master at ``<base>/stations``."""
    k = _key(spark, sf_dir, "old")
    if k in _cache:
        return _cache[k]
    base = scratch_path(spark, "raw-old")
    keys = _staged_keys(spark, sf_dir) if _key(spark, sf_dir, "keys") in _cache else _per_folder(D.trip_keys(spark, sf_dir), 12)
    rows = _old_layout_text(_in_order(keys, F.year(D.start_ts()))).drop("_month")
    with shuffles_deleted(spark):
        _csv_writer(rows).partitionBy("period").csv(base)
    write_stations(spark, sf_dir, f"{base}/stations")
    _cache[k] = base
    _drop_served_keys(spark, sf_dir)
    return base


def write_split_years(spark: SparkSession, sf_dir: str) -> str:
    """Old layout with every year split in two parts: ``<base>/year=yyyy/part=<n>/*.csv``."""
    k = _key(spark, sf_dir, "split")
    if k in _cache:
        return _cache[k]
    base = scratch_path(spark, "landing-split")
    rows = _old_layout_text(_per_folder(D.trip_keys(spark, sf_dir), 6))
    rows = (rows.withColumn("year", F.col("period"))
                .withColumn("part", F.when(F.col("_month") <= 6, 1).otherwise(2))
                .drop("period", "_month"))
    _csv_writer(rows).partitionBy("year", "part").csv(base)
    _cache[k] = base
    return base


def write_stations(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Raw stations (before F2) as a station CSV with the master's header names."""
    st = D.station_raw(spark, sf_dir)
    cols = S.STATION_COLUMNS
    out = st.select(F.col("station_id").alias(cols["id"]),
                    F.concat(F.lit("Station "), F.col("station_id")).alias("Station"),
                    F.col("latitude").cast("string").alias(cols["lat"]),
                    F.col("longitude").cast("string").alias(cols["lon"]))
    _csv_writer(out).csv(path)
    return path


def write_landing(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder of real files: new-layout months, old-layout years, a split part and a backup of each year."""
    k = _key(spark, sf_dir, "landing")
    if k in _cache:
        return _cache[k]
    base = scratch_path(spark, "landing")
    raw = D.trips_raw(spark, sf_dir).select("start_ts")
    months = raw.select(_ts("start_ts", "yyyyMM").alias("period")).distinct()
    years = raw.select(_ts("start_ts", "yyyy").alias("period")).distinct()
    names = [(months, S.LANDING_NEW_NAME), (years, S.LANDING_OLD_NAME), (years, S.LANDING_OLD_NAME + ".bak"),
             (years, S.LANDING_OLD_NAME.replace(".csv", "_1.csv"))]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path(base))
    for df, template in names:                            # as many files as calendar months; the name stands in for a download
        for r in df.collect():
            out = store.create(path(f"{base}/{template.format(period=r.period)}"))
            out.write(10)                                 # Spark's listing leaves empty files out
            out.close()
    _cache[k] = base
    return base


def write_changing_layout(spark: SparkSession, sf_dir: str) -> tuple[str, Callable[[], None]]:
    """A new-layout folder without the last month, and a function that changes it: the first month keeps only the
    trips of each hour's first half, the second goes, the last comes."""
    base = scratch_path(spark, "raw-changing")
    keys = D.located_keys(spark, sf_dir, station_master(D.station_raw(spark, sf_dir)))
    rows = _new_layout_text(keys)
    periods = sorted(r.period for r in rows.select("period").distinct().collect())
    first, second, last = periods[0], periods[1], periods[-1]
    _csv_writer(_new_layout_text(_per_folder(keys.where(F.date_format(D.start_ts(), "yyyyMM") != last)))).partitionBy("period").csv(base)

    def change() -> None:
        def month(period: str, df: DataFrame) -> None:
            _csv_writer(df.where(F.col("period") == period).drop("period")).csv(f"{base}/period={period}")

        month(first, rows.where(F.substring(S.NEW_LAYOUT.start, 15, 2) < "30"))
        month(last, rows)
        drop_path(spark, f"{base}/period={second}")

    return base, change


def write_searchable_table(spark: SparkSession, sf_dir: str) -> str:
    """The clean trips written once for look-ups: sorted inside months, Bloom filters on the bike."""
    from tripkpi.sinks.parquet import write_searchable_trips
    k = _key(spark, sf_dir, "searchable")
    if k not in _cache:
        path = scratch_path(spark, "searchable")
        write_searchable_trips(D.clean_trips(spark, sf_dir), path)
        _cache[k] = path
    return _cache[k]


def write_clean_table(spark: SparkSession, sf_dir: str) -> str:
    """The clean trips written once as the partitioned Parquet table (K1)."""
    from tripkpi.sinks.parquet import write_clean_trips
    k = _key(spark, sf_dir, "clean")
    if k in _cache:
        return _cache[k]
    path = scratch_path(spark, "clean")
    write_clean_trips(D.clean_trips(spark, sf_dir), path)
    _cache[k] = path
    return path

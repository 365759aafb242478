"""Validation filters and data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkpi import schemas as S

# Name of each F1 conjunct, in the order the reject report lists them.
REJECT_REASONS = [
    "missing_start_ts",
    "missing_end_ts",
    "end_not_after_start",
    "missing_time_slot",
    "bad_duration",
    "bad_distance",
    "missing_start_station",
    "missing_end_station",
]


def trip_conditions() -> dict[str, Column]:
    """The eight conjuncts of trip validity, keyed by reject reason.

    A null comparison is not true, and ``NaN BETWEEN 0 AND 50000`` is false,
    so null or NaN distances are rejected.
    """
    c = F.col
    return {
        "missing_start_ts": c("trip_start_ts").isNotNull(),
        "missing_end_ts": c("trip_end_ts").isNotNull(),
        "end_not_after_start": c("trip_end_ts") > c("trip_start_ts"),
        "missing_time_slot": c("time_slot").isNotNull(),
        "bad_duration": c("trip_duration_min").between(S.MIN_DURATION_MIN, S.MAX_DURATION_MIN),
        "bad_distance": c("trip_distance_m").between(S.MIN_DISTANCE_M, S.MAX_DISTANCE_M),
        "missing_start_station": c("start_station_id").isNotNull(),
        "missing_end_station": c("end_station_id").isNotNull(),
    }


def is_valid_trip() -> Column:
    return reduce(lambda a, b: a & b, trip_conditions().values())


def validate_trips(df: DataFrame) -> DataFrame:
    """keep only trips that satisfy all eight conjuncts."""
    return df.filter(is_valid_trip())


def reject_reasons(typed: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """one row per (year, month) of typed, not yet filtered trips.

    ``n_<reason>`` counts rows whose conjunct is not true (false or null); a row
    may count under several reasons. ``extra`` adds informational counts
    (``n_<name>`` = rows where the condition is true). One pass, partial
    aggregation map-side.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for reason, cond in trip_conditions().items():
        aggs.append(F.count_if(~F.coalesce(cond, F.lit(False))).alias(f"n_{reason}"))
    aggs.append(F.count_if(F.coalesce(is_valid_trip(), F.lit(False))).alias("n_valid"))
    for name, cond in (extra or {}).items():
        aggs.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(f"n_{name}"))
    return typed.groupBy("year", "month").agg(*aggs)


def period_mismatch() -> Column:
    """New layout: the trip started outside the month its folder names (informational)."""
    return ((F.year("trip_start_ts") != F.col("year")) | (F.month("trip_start_ts") != F.col("month")))


def file_counts(typed: DataFrame, file_col: str = "source_file") -> DataFrame:
    """A10 per file: raw rows and valid rows of each input file, in one pass
    (the per-file counts the source pipeline prints, as a table)."""
    return typed.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.coalesce(is_valid_trip(), F.lit(False))).alias("n_valid"))


def trip_counts(clean: DataFrame) -> DataFrame:
    """A10: valid trips per (year, month)."""
    return clean.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_trips"))


def valid_stations(stations: DataFrame) -> DataFrame:
    """id, latitude and longitude present and inside the globe's ranges."""
    lat_lo, lat_hi = S.STATION_LAT_RANGE
    lon_lo, lon_hi = S.STATION_LON_RANGE
    return stations.filter(
        F.col("station_id").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & F.col("latitude").between(lat_lo, lat_hi)
        & F.col("longitude").between(lon_lo, lon_hi)
    )


def station_duplicates(stations: DataFrame) -> DataFrame:
    """station ids that occur more than once, with their row count."""
    return (stations.groupBy("station_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def unmatched_stations(trips: DataFrame, stations: DataFrame,
                       start_col: str = "start_station_id",
                       end_col: str = "end_station_id") -> DataFrame:
    """Trip station ids (start or end, non-null) missing from the station master.

    One pass over the trips: each row yields its two ids, a distinct (combined
    map-side) shrinks them to the ids that occur, and an anti join against the
    dimension leaves those without a station.
    """
    ids = (trips.select(F.explode(F.array(F.col(start_col), F.col(end_col))).alias("station_id"))
           .filter(F.col("station_id").isNotNull())
           .distinct())
    return ids.join(stations.select("station_id"), "station_id", "left_anti")


def station_quality(raw: DataFrame) -> DataFrame:
    """Station master outcome in one row: raw, valid and rejected rows, duplicated ids."""
    ids = raw.select("station_id", "latitude", "longitude")
    lat_lo, lat_hi = S.STATION_LAT_RANGE
    lon_lo, lon_hi = S.STATION_LON_RANGE
    valid = (F.col("station_id").isNotNull() & F.coalesce(F.col("latitude").between(lat_lo, lat_hi), F.lit(False))
             & F.coalesce(F.col("longitude").between(lon_lo, lon_hi), F.lit(False)))
    per_id = ids.groupBy("station_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("v"))
    return per_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("v"), F.lit(0)).alias("n_valid"),
                      F.coalesce(F.sum(F.col("n") - F.col("v")), F.lit(0)).alias("n_rejected"),
                      F.count_if(F.col("n") > 1).alias("n_duplicated_ids"))


def check_required_columns(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Fail fast when columns are missing or the table is empty.

    ``isEmpty`` reads at most one row instead of counting the whole table.
    """
    required = required or S.KPI_REQUIRED_COLUMNS
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"input is missing required columns: {missing}")
    if df.isEmpty():
        raise ValueError("input data is empty")
    return df


def contract_report(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """S7 as a table: ``check, ok`` for each required column and for the table having rows (one row read at most)."""
    required = required or S.KPI_REQUIRED_COLUMNS
    spark = df.sparkSession
    columns = spark.createDataFrame([(f"has {c}", c in df.columns) for c in required], "check string, ok boolean")
    rows = df.select(F.lit(1)).limit(1).agg((F.count("*") > 0).alias("ok"))
    return columns.unionByName(rows.select(F.lit("has rows").alias("check"), "ok"))


def month_filter(df: DataFrame, year: int, month: int) -> DataFrame:
    """one month; on a partitioned table this prunes to one folder."""
    return df.filter((F.col("year") == year) & (F.col("month") == month))

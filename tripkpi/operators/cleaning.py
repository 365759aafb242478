"""Typing and conforming raw trips into the clean contract.

Every layout is first renamed to one *conformed raw* frame:

    dur_raw, start_raw, end_raw, start_station_id, start_station_name,
    end_station_id, end_station_name, bike_id, birth_year_raw, gender_raw,
    [start_latitude, start_longitude, end_latitude, end_longitude], [period]

and then goes through the same stages. All stages are column expressions or
joins, so the whole chain is one Catalyst plan per read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.functions import columns as C
from tripkpi.operators.joins import join_station_coordinates
from tripkpi.operators.quality import validate_trips

COORDINATES = ["start_latitude", "start_longitude", "end_latitude", "end_longitude"]


def computed_once(df: DataFrame, *names: str) -> DataFrame:
    """The same rows, with the columns ``names`` (moved to the end) computed before any filter on them.

    Spark moves a filter below the projection that computes its columns, and there it evaluates their expressions
    again in each conjunct: distance and both timestamps three times a row and more, in one method too large for the
    JIT compiler. A filter on what a generator has made stays above it.
    """
    return df.select(*[c for c in df.columns if c not in names], F.inline(F.array(F.struct(*names))))


def conform_layout(df: DataFrame, layout: S.Layout, extra: list[str] | None = None) -> DataFrame:
    """Rename one layout's header names to the conformed raw names (P12, input side)."""
    cols = [
        F.col(f"`{layout.duration}`").alias("dur_raw"),
        F.col(f"`{layout.start}`").alias("start_raw"),
        F.col(f"`{layout.end}`").alias("end_raw"),
        F.col(f"`{layout.start_id}`").cast("string").alias("start_station_id"),
        F.col(f"`{layout.start_name}`").cast("string").alias("start_station_name"),
        F.col(f"`{layout.end_id}`").cast("string").alias("end_station_id"),
        F.col(f"`{layout.end_name}`").cast("string").alias("end_station_name"),
        F.col(f"`{layout.bike}`").cast("string").alias("bike_id"),
        (F.col(f"`{layout.birth_year}`") if layout.birth_year else F.lit(None).cast("string"))
        .alias("birth_year_raw"),
        F.col(f"`{layout.gender}`").alias("gender_raw"),
    ]
    if layout.has_coordinates:
        for src, dst in zip([layout.start_lat, layout.start_lon, layout.end_lat, layout.end_lon],
                            COORDINATES):
            cols.append(F.col(f"`{src}`").alias(dst))
    for name in extra or []:
        cols.append(F.col(name))
    return df.select(*cols)


def add_temporal(df: DataFrame, divisor: float, ts_format: str | None,
                 period_from_folder: bool) -> DataFrame:
    """P1/P2 duration, P3/P4 timestamps, P5/P6 year and month, P7 time slot."""
    start = C.parse_timestamp("start_raw", ts_format)
    df = (df.withColumn("trip_duration_min", C.duration_minutes("dur_raw", divisor))
            .withColumn("trip_start_ts", start)
            .withColumn("trip_end_ts", C.parse_timestamp("end_raw", ts_format)))
    if period_from_folder:
        df = (df.withColumn("year", C.period_year("period"))
                .withColumn("month", C.period_month("period")))
    else:
        df = (df.withColumn("year", C.year_of("trip_start_ts"))
                .withColumn("month", C.month_of("trip_start_ts")))
    return df.withColumn("time_slot", C.time_slot("trip_start_ts"))


def to_clean_contract(df: DataFrame, keep_birth_year: bool = True,
                      passthrough: list[str] | None = None) -> DataFrame:
    """P8 distance, P9/P10 birth year, P11 gender, then the 14-column select
    (plus any ``passthrough`` columns, e.g. ``source_file`` for per-file counts)."""
    return df.select(
        F.col("trip_duration_min").cast("double").alias("trip_duration_min"),
        F.col("trip_start_ts"),
        F.col("trip_end_ts"),
        F.col("start_station_id"),
        F.col("start_station_name"),
        F.col("end_station_id"),
        F.col("end_station_name"),
        F.col("bike_id"),
        (C.birth_year("birth_year_raw") if keep_birth_year else F.lit(None).cast("int"))
        .alias("birth_year"),
        C.gender("gender_raw").alias("gender"),
        C.haversine_m(*(F.col(c).try_cast("double") for c in COORDINATES)).alias("trip_distance_m"),
        F.col("time_slot"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        *(passthrough or []),
    )


def type_trips(raw: DataFrame, divisor: float, ts_format: str | None,
               period_from_folder: bool, stations: DataFrame | None = None,
               keep_birth_year: bool = True, prefilter_station_ids: bool = False,
               dedupe: bool = False,
               passthrough: list[str] | None = None) -> DataFrame:
    """Conformed raw -> typed trips in the clean contract, *before* validation.

    ``stations`` is given for layouts without coordinates (J1, J2).
    ``prefilter_station_ids`` drops rows with a null station id before the
    join; validation drops them anyway, so this only shrinks the join input
    (and keeps all null keys out of one shuffle partition).
    """
    if prefilter_station_ids:
        raw = raw.filter(F.col("start_station_id").isNotNull()
                         & F.col("end_station_id").isNotNull())
    df = computed_once(add_temporal(raw, divisor, ts_format, period_from_folder), "trip_start_ts", "trip_end_ts")
    if stations is not None:
        df = join_station_coordinates(df, stations, dedupe=dedupe)
    typed = to_clean_contract(df, keep_birth_year, passthrough)
    return computed_once(typed, "trip_distance_m").select(*typed.columns)


def clean_trips(raw: DataFrame, divisor: float, ts_format: str | None,
                period_from_folder: bool, stations: DataFrame | None = None,
                keep_birth_year: bool = True, dedupe: bool = False) -> DataFrame:
    """Typed + validated trips (F1)."""
    return validate_trips(type_trips(raw, divisor, ts_format, period_from_folder, stations,
                                     keep_birth_year, prefilter_station_ids=True, dedupe=dedupe))

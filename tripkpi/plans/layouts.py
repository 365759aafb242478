"""Cleaning jobs per layout (E1, E2) and their union."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.operators import cleaning
from tripkpi.operators.quality import period_mismatch, reject_reasons
from tripkpi.sources import csv_layouts
from tripkpi.sources.stations import read_station_master


def typed_new_layout(raw: DataFrame, passthrough: list[str] | None = None) -> DataFrame:
    """New layout, typed but not validated: P1, P3, P5, P7, P8, P9, P11, P12.

    Year and month come from the period folder, not from the trip start.
    """
    return cleaning.type_trips(raw, S.NEW_LAYOUT.duration_divisor, S.NEW_LAYOUT.ts_format,
                               period_from_folder=True, passthrough=passthrough)


def clean_new(raw: DataFrame) -> DataFrame:
    """E1 (without I/O): conformed new-layout rows -> validated clean trips."""
    return cleaning.clean_trips(raw, S.NEW_LAYOUT.duration_divisor, S.NEW_LAYOUT.ts_format,
                                period_from_folder=True)


def typed_old_layout(raw: DataFrame, stations: DataFrame, dedupe: bool = False,
                     passthrough: list[str] | None = None) -> DataFrame:
    """Old layout, typed but not validated: P2, P4, P6, P7, P10, J1, J2, P8, P11, P12."""
    return cleaning.type_trips(raw, S.OLD_LAYOUT.duration_divisor, S.OLD_LAYOUT.ts_format,
                               period_from_folder=False, stations=stations,
                               keep_birth_year=False, dedupe=dedupe, passthrough=passthrough)


def clean_old(raw: DataFrame, stations: DataFrame, dedupe: bool = False) -> DataFrame:
    """E2 (without I/O): conformed old-layout rows + station master -> clean trips.

    Year and month come from the trip start; birth year is always null.
    """
    return cleaning.clean_trips(raw, S.OLD_LAYOUT.duration_divisor, S.OLD_LAYOUT.ts_format,
                                period_from_folder=False, stations=stations,
                                keep_birth_year=False, dedupe=dedupe)


def unify(*frames: DataFrame) -> DataFrame:
    """Bag union of clean frames by column name, in the contract order."""
    out = frames[0].select(*S.CLEAN_TRIP_COLUMNS)
    for f in frames[1:]:
        out = out.unionByName(f.select(*S.CLEAN_TRIP_COLUMNS))
    return out


def read_and_clean_new(spark: SparkSession, base: str, **scan_kw) -> DataFrame:
    return clean_new(csv_layouts.scan_new_layout(spark, base, **scan_kw))


def read_and_clean_old(spark: SparkSession, base: str, stations_path: str | None = None,
                       dedupe: bool = False, **scan_kw) -> DataFrame:
    stations_path = stations_path or f"{base.rstrip('/')}/{S.STATIONS_FILE_NAME}"
    stations = read_station_master(spark, stations_path)
    return clean_old(csv_layouts.scan_old_layout(spark, base, **scan_kw), stations, dedupe)


def quality(typed: DataFrame, from_folder: bool) -> DataFrame:
    """F6 of typed rows: reject reasons per (year, month), and for a layout whose month comes from the
    folder ``n_period_mismatch``: trips that started outside their folder's month (else 0)."""
    if from_folder:
        return reject_reasons(typed, {"period_mismatch": period_mismatch()})
    return reject_reasons(typed).withColumn("n_period_mismatch", F.lit(0).cast("bigint"))

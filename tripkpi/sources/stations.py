"""Station master source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.operators.quality import valid_stations

# Stations that are broadcast to the trips, whatever the session's size limit for broadcasts: some 100 bytes each on
# every executor. A larger master is joined by shuffling the trips.
BROADCAST_STATIONS = 500_000


def read_station_csv(spark: SparkSession, path: str) -> DataFrame:
    """Station CSV (header row) -> raw ``station_id, latitude, longitude``.

    Read as strings by header name and typed with ``try_cast``, so a junk
    coordinate becomes null (and is filtered) instead of failing the job.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [c for c in S.STATION_COLUMNS.values() if c not in raw.columns]
    if missing:
        raise ValueError(f"station file {path} is missing columns {missing}")
    return conform_stations(raw, S.STATION_COLUMNS["id"], S.STATION_COLUMNS["lat"],
                            S.STATION_COLUMNS["lon"])


def conform_stations(raw: DataFrame, id_col: str, lat_col: str, lon_col: str) -> DataFrame:
    return raw.select(F.col(id_col).cast("string").alias("station_id"),
                      F.col(lat_col).try_cast("double").alias("latitude"),
                      F.col(lon_col).try_cast("double").alias("longitude"))


def station_master(raw_stations: DataFrame) -> DataFrame:
    """F2 applied to a raw station frame."""
    return valid_stations(raw_stations)


def few_stations(stations: DataFrame) -> bool:
    """Whether the stations may be broadcast; one job that counts them."""
    return stations.count() <= BROADCAST_STATIONS


def broadcast_if_few(stations: DataFrame) -> DataFrame:
    """The same stations, marked for broadcast if there are few of them: else both station joins shuffle whole trips."""
    return F.broadcast(stations) if few_stations(stations) else stations


def read_station_master(spark: SparkSession, path: str) -> DataFrame:
    return broadcast_if_few(station_master(read_station_csv(spark, path)))

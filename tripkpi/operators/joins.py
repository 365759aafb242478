"""Trip -> station dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_stations(stations: DataFrame) -> DataFrame:
    """One row per station id, keeping the smallest (latitude, longitude)."""
    return (stations.groupBy("station_id")
            .agg(F.min(F.struct("latitude", "longitude")).alias("_p"))
            .select("station_id", F.col("_p.latitude").alias("latitude"),
                    F.col("_p.longitude").alias("longitude")))


def join_station_coordinates(trips: DataFrame, stations: DataFrame,
                             start_key: str = "start_station_id",
                             end_key: str = "end_station_id",
                             dedupe: bool = False) -> DataFrame:
    """J1 + J2: left-join start and end coordinates from the station master.

    Adds ``start_latitude, start_longitude, end_latitude, end_longitude``.
    Unmatched ids give null coordinates (and later a null distance). Duplicate
    station ids fan trips out, as in the source pipeline, unless ``dedupe``.
    Keys are strings on both sides. One join condition and no hint: Spark
    broadcasts the dimension while its size in bytes is under
    ``autoBroadcastJoinThreshold`` (known, or measured by AQE at run time);
    beyond it, trips of a hot station or without one are split by AQE's
    skew-join handling.
    """
    st = stations.select(F.col("station_id").cast("string").alias("station_id"),
                         F.col("latitude").cast("double").alias("latitude"),
                         F.col("longitude").cast("double").alias("longitude"))
    if dedupe:
        st = dedupe_stations(st)
    start = st.select(F.col("station_id").alias("_start_ref"),
                      F.col("latitude").alias("start_latitude"),
                      F.col("longitude").alias("start_longitude"))
    end = st.select(F.col("station_id").alias("_end_ref"),
                    F.col("latitude").alias("end_latitude"),
                    F.col("longitude").alias("end_longitude"))
    return (trips
            .join(start, F.col(start_key) == F.col("_start_ref"), "left")
            .join(end, F.col(end_key) == F.col("_end_ref"), "left")
            .drop("_start_ref", "_end_ref"))

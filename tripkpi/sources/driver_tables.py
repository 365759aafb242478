"""Trips and stations derived from the benchmark tables.

The benchmark tables hold no trips, so a deterministic view derives them from
``lineitem JOIN orders`` (one trip per line item) and stations from
``supplier``. The rules plant every case the cleaning must handle: missing end
times, negative / short / long durations, out-of-range and duplicate stations,
unmatched station ids, '\\N' and '0' markers. The view is what the CSV
fixtures are rendered from, and what the oracle SQL derives independently.

The derivation is plain column arithmetic plus one equi-join on the order key.
No hint: Spark broadcasts ``orders`` only while its size is under
``autoBroadcastJoinThreshold`` (sf0.1); at scale it is a sort-merge join of
the two largest tables, both shuffled on the order key (a unique key on the
orders side, at most seven line items per order, so no skew). Station joins
and the clustering by folder shuffle the keys (`trip_keys`), not the texts
that are derived from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.operators import cleaning
from tripkpi.operators.joins import join_station_coordinates

TRIPS_PERIOD_DIVISOR = S.NEW_LAYOUT_DURATION_DIVISOR  # the view's durations are seconds


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def station_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stations (before F2): every supplier, one bad latitude in 25, and a
    duplicate row for one supplier in 50."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    key = F.col("s_suppkey")
    base = s.select(
        key.cast("string").alias("station_id"),
        F.when(key % 25 == 7, F.lit(95.0))
         .otherwise(F.lit(42.3) + (key * 37 % 1000) / F.lit(10000.0)).alias("latitude"),
        (F.lit(-71.2) + (key * 53 % 1000) / F.lit(10000.0)).alias("longitude"),
    )
    dup = s.filter(key % 50 == 3).select(key.cast("string").alias("station_id"),
                                         F.lit(42.31).alias("latitude"),
                                         F.lit(-71.11).alias("longitude"))
    return base.unionByName(dup)


def _seconds(expr):
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), expr)


def trip_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trip: the keys and the date from which `trips_of` derives the trip, and both station ids.

    What joins and shuffles trips takes these few numbers; the texts are derived afterwards.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def start_ts():
    return F.col("o_orderdate") + _seconds((F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 86400)


def _start_station_id():
    return F.when(F.col("l_partkey") % 89 == 0, F.lit(None).cast("string")).otherwise(F.col("l_suppkey").cast("string"))


def _end_station_id():
    return (F.col("l_partkey") % 110).cast("string")


def trips_of(keys: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Raw trips of `trip_keys`; ``extra`` columns are kept."""
    ok, pk, ln, cust = (F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber"), F.col("o_custkey"))
    marker = F.lit(S.NULL_MARKER)
    x = keys.select(
        ok.alias("trip_order"), ln.alias("trip_line"),
        ((ok * 31 + ln * 7919 + pk * 17) % 90000 - 300).alias("dur_s"),
        start_ts().alias("start_ts"),
        _start_station_id().alias("start_station_id"),
        _end_station_id().alias("end_station_id"),
        pk.cast("string").alias("bike_id"),
        F.when(cust % 11 == 0, marker).when(cust % 11 == 1, F.lit("0"))
         .otherwise((F.lit(1890) + cust % 140).cast("string")).alias("birth_year_raw"),
        F.when(ok % 4 == 3, marker)
         .when(cust % 13 == 4, F.lit("3")).when(cust % 13 == 5, F.lit("7"))   # codes beyond the usual
         .otherwise((ok % 4).cast("string")).alias("gender_raw"),
        *(extra or []),
    )
    return x.select(
        "trip_order", "trip_line", "dur_s", "start_ts",
        F.when(F.col("trip_order") % 97 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("start_ts") + _seconds(F.col("dur_s"))).alias("end_ts"),
        "start_station_id",
        F.concat(F.lit("Station "), F.col("start_station_id")).alias("start_station_name"),
        "end_station_id",
        F.concat(F.lit("Station "), F.col("end_station_id")).alias("end_station_name"),
        "bike_id", "birth_year_raw", "gender_raw", *(extra or []),
    )


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips: ``dur_s, start_ts, end_ts, start/end station id+name, bike_id,
    birth_year_raw, gender_raw`` plus the line identity ``trip_order, trip_line``."""
    return trips_of(trip_keys(spark, sf_dir))


def located_keys(spark: SparkSession, sf_dir: str, stations: DataFrame, named_only: bool = False) -> DataFrame:
    """`trip_keys` with the coordinates of both stations; ``named_only`` leaves out trips without a station id."""
    return locate(trip_keys(spark, sf_dir), stations, named_only)


def locate(keys: DataFrame, stations: DataFrame, named_only: bool = False) -> DataFrame:
    keys = keys.withColumns({"start_station_id": _start_station_id(), "end_station_id": _end_station_id()})
    if named_only:
        keys = keys.where(F.col("start_station_id").isNotNull() & F.col("end_station_id").isNotNull())
    return join_station_coordinates(keys, stations).drop("start_station_id", "end_station_id")


def conformed_raw(raw: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The view in the conformed raw shape the cleaning stages take."""
    return raw.select(
        F.col("dur_s").alias("dur_raw"), F.col("start_ts").alias("start_raw"),
        F.col("end_ts").alias("end_raw"), "start_station_id", "start_station_name",
        "end_station_id", "end_station_name", "bike_id", "birth_year_raw", "gender_raw", *(extra or []))


def _located_raw(spark: SparkSession, sf_dir: str, stations: DataFrame, named_only: bool = False) -> DataFrame:
    """The conformed raw shape with coordinates: the station joins take the keys alone."""
    keys = located_keys(spark, sf_dir, stations, named_only)
    return conformed_raw(trips_of(keys, cleaning.COORDINATES), cleaning.COORDINATES)


def typed_trips(spark: SparkSession, sf_dir: str, stations: DataFrame | None = None) -> DataFrame:
    """Trips typed into the clean contract, not yet validated (for reject reports)."""
    from tripkpi.sources.stations import station_master
    stations = stations if stations is not None else station_master(station_raw(spark, sf_dir))
    return cleaning.type_trips(_located_raw(spark, sf_dir, stations), TRIPS_PERIOD_DIVISOR,
                               None, period_from_folder=False)


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated trips in the clean contract (the KPI job's input)."""
    from tripkpi.sources.stations import station_master
    stations = station_master(station_raw(spark, sf_dir))
    return cleaning.clean_trips(_located_raw(spark, sf_dir, stations, named_only=True), TRIPS_PERIOD_DIVISOR,
                                None, period_from_folder=False)

"""Reading the partitioned clean-trip table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.functions import columns as C
from tripkpi.operators.quality import check_required_columns, month_filter


def read_clean_trips(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    """Partition discovery gives int ``year``/``month``; S7 checks the contract.

    No cache: filters on year/month stay partition filters (a cached relation
    would hide them), and column pruning reaches the Parquet scan.
    """
    df = spark.read.parquet(path)
    df = df.withColumn("year", F.col("year").cast("int")).withColumn("month", F.col("month").cast("int"))
    if validate:
        check_required_columns(df, S.KPI_REQUIRED_COLUMNS)
    return df.select(*S.CLEAN_TRIP_COLUMNS)


def read_month(spark: SparkSession, path: str, year: int, month: int) -> DataFrame:
    """F5 as a partition-pruned read of one month folder."""
    return month_filter(read_clean_trips(spark, path, validate=False), year, month)


def clean_periods(spark: SparkSession, path: str) -> DataFrame:
    """A9 from the table's partition folders: ``year, month, year_month`` and the files and bytes of each, ascending.

    The folders' file listing is the input; no data file is opened, not even
    for its footer. A folder without files is no period.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path", "length"))
    year = F.regexp_extract("path", r"/year=(\d+)/month=\d+/[^/]+$", 1)
    month = F.regexp_extract("path", r"/year=\d+/month=(\d+)/[^/]+$", 1)
    found = files.where(year != "").select(year.cast("int").alias("year"), month.cast("int").alias("month"), "length")
    return (found.groupBy("year", "month").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))
            .withColumn("year_month", C.year_month_label("year", "month")).orderBy("year", "month"))


def bike_history(spark: SparkSession, path: str, bike_id: str) -> DataFrame:
    """All trips of one bike. The equality reaches the Parquet reader, which leaves out every row group whose
    dictionary, statistics or Bloom filter says that the bike is not in it (see ``write_searchable_trips``)."""
    return read_clean_trips(spark, path, validate=False).where(F.col("bike_id") == bike_id)

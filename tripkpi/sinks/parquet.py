"""Sinks: the partitioned clean-trip table (K1) and the KPI report (K2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripkpi import schemas as S


def write_clean_trips(df: DataFrame, path: str, dynamic: bool = True, padded_months: bool = False, clustered: bool = False,
                      sort_by: Sequence[str] = (), bloom: Mapping[str, int] | None = None,
                      row_group_bytes: int | None = None) -> None:
    """K1: Parquet partitioned by year/month, replacing only the partitions written.

    The REBALANCE hint clusters rows by (year, month) so a month folder gets a
    few large files instead of one small file per input split, and lets AQE
    split a month that is too big for one task into advisory-sized pieces
    (a plain ``repartition(year, month)`` would write a hot month from a
    single task). Dynamic partition overwrite is a per-write option, so a
    session default elsewhere can't turn this into a full-table overwrite.

    ``clustered``: each input file already holds one month, so the rows are not
    shuffled; a month gets at most as many files as it has input files or splits.

    ``padded_months`` writes ``month=01`` instead of ``month=1``, for readers
    that go by path; a table should keep to one form.

    For point and range reads inside a month: ``sort_by`` orders the rows of
    each file, so that the row groups and pages of a file cover narrow ranges
    of those columns; ``bloom`` gives columns a Parquet Bloom filter, with the
    distinct values expected in a row group; ``row_group_bytes`` sets how much
    a row group holds, which is what a reader can skip.
    """
    out = df.select(*S.CLEAN_TRIP_COLUMNS)
    if padded_months:
        out = out.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    if not clustered:
        out = out.hint("rebalance", *S.PARTITION_COLUMNS)
    if sort_by:
        out = out.sortWithinPartitions(*S.PARTITION_COLUMNS, *sort_by)
    writer = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
              .option("compression", "zstd"))
    for column, distinct in (bloom or {}).items():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct)))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.partitionBy(*S.PARTITION_COLUMNS).parquet(path)


def write_searchable_trips(df: DataFrame, path: str, bikes_per_row_group: int = 100_000,
                           row_group_bytes: int = 16 << 20) -> None:
    """K1 for look-ups: rows by start station inside a month, Bloom filters on the bike."""
    write_clean_trips(df, path, sort_by=["start_station_id", "trip_start_ts"], bloom={"bike_id": bikes_per_row_group},
                      row_group_bytes=row_group_bytes)


def write_kpi_report(wide: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K2: the wide KPI table, one folder per year (the workbook's sheets).

    Parquet keeps the lists as ``array<struct>``; ``fmt='json'`` gives one
    JSON object per month for text consumers. One row per month, so the
    report is small whatever the trip volume. A run replaces the whole report:
    years that are no longer in the data don't stay behind.
    """
    (wide.hint("rebalance", "year").write.mode("overwrite")
         .option("partitionOverwriteMode", "static")
         .partitionBy("year").format(fmt).save(path))


def read_kpi_report(spark, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """The report as written. JSON leaves out null values, so a column that is null throughout needs the ``schema``."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return df.withColumn("year", F.col("year").cast("int"))

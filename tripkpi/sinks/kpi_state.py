"""The KPI state table: mergeable monthly sums from which the report is derived.

One Parquet folder per month holds the rows of `kpis.month_state`. New trips
of a month are merged into its rows; a month that was cleaned anew replaces
them. Either way only the months concerned are read and written, so keeping
the report up to date costs as much as the new trips, not as much as all.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.operators import kpis
from tripkpi.session import drop_path


def _write(state: DataFrame, path: str) -> None:
    (state.hint("rebalance", *S.PARTITION_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*S.PARTITION_COLUMNS).parquet(path))


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state so far; None where there is none yet."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return None
    return df.withColumns({c: F.col(c).cast("int") for c in S.PARTITION_COLUMNS})


def _of_months(df: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Rows of the months, as a partition filter."""
    return df.where(F.concat_ws("-", "year", "month").isin([f"{y}-{m}" for y, m in months]))


def merge_trips(spark: SparkSession, path: str, trips: DataFrame) -> None:
    """Add trips that the state has not seen. Each trip must be merged once: a batch merged twice counts twice.

    The months' new rows are complete before the old ones go (dynamic
    overwrite commits at the end), so a failed merge can be run again.
    """
    new = kpis.month_state(trips)
    old = read_state(spark, path)
    if old is not None:
        months = [tuple(r) for r in trips.select("year", "month").distinct().collect()]
        new = kpis.merge_states(_of_months(old, months), new)
    _write(new, path)


def replace_months(spark: SparkSession, path: str, trips: DataFrame, months: list[tuple[int, int]]) -> None:
    """Derive the months anew from ``trips``, a table that holds them whole; months without trips leave the state."""
    _write(kpis.month_state(_of_months(trips, months)), path)
    state = read_state(spark, path)
    held = {tuple(r) for r in trips.transform(_of_months, months).select("year", "month").distinct().collect()}
    for y, m in set(months) - held:
        if state is not None:
            drop_path(spark, f"{path.rstrip('/')}/year={y}/month={m}")

"""Reading the tables and staging intermediate ones in the shared checkpoint folder."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from tripkpi.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write once to shared storage and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Shared:
    """An object broadcast as cloudpickle bytes, which carry classes of this subpackage by value.

    A plain broadcast names the classes only, and workers without the library
    could not load it. ``value`` unpacks once per task.
    """

    def __init__(self, spark: SparkSession, obj):
        self.held = spark.sparkContext.broadcast(cloudpickle.dumps(obj))
        self.obj = None

    @property
    def value(self):
        if self.obj is None:
            self.obj = cloudpickle.loads(self.held.value)
        return self.obj


BATCH_BYTES = "4m"


def bounded_batches(df: DataFrame) -> None:
    """Let Arrow batches between Spark and Python hold ``BATCH_BYTES`` at most, unless the session says otherwise.

    The default of 64 MB, held by the JVM and the worker of every running task
    at once, is much for executors of a few GB and texts of any length.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(key, None) is None:
        df.sparkSession.conf.set(key, BATCH_BYTES)

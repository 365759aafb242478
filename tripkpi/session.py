"""Session helpers: a local session for tests/bench, and the shared scratch root."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app_name: str = "tripkpi",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session for the library's jobs, tests and bench.

    Nothing the cluster configured is overridden: on a cluster (``master`` is
    None, spark-submit decides) only runtime SQL settings that are still
    unset get a default (UTC session zone, AQE with partition coalescing and
    skew-join splitting). JVM, UI and file-listing settings, and a small
    shuffle-partition count, are applied only to a local ``local[N]``
    session started here (tests, bench).
    """
    builder = SparkSession.builder.appName(app_name)
    local = bool(master) and master.startswith("local")
    if master:
        builder = builder.master(master)
    if local:
        # The cleaning stage fuses three joins and ~40 expressions into one
        # whole-stage-codegen method; HotSpot skips JIT for methods over 8 KB,
        # so let it compile them (2-3x on that stage). On a cluster, add the
        # flag to spark.executor.extraJavaOptions in the job's configuration.
        jit = "-XX:-DontCompileHugeMethods"
        builder = (builder
                   .config("spark.driver.extraJavaOptions", jit)
                   .config("spark.executor.extraJavaOptions", jit)
                   .config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false"))
        if "spark.driver.memory" not in builder._options:
            builder = builder.config("spark.driver.memory", os.environ.get("TRIPKPI_DRIVER_MEMORY", "8g"))
        cores = master[len("local["):-1] if master.startswith("local[") else ""
        if cores.isdigit():
            # Listing more than 32 paths runs a Spark job with one task per
            # path (up to 10000). That suits a cluster; locally cap it.
            builder = builder.config("spark.sql.sources.parallelPartitionDiscovery.parallelism", cores)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions or local:
        defaults["spark.sql.shuffle.partitions"] = str(
            shuffle_partitions or int(os.environ.get("TRIPKPI_SHUFFLE_PARTITIONS", "8")))
    configured = spark.sparkContext.getConf()
    for key, value in defaults.items():
        if not configured.contains(key) or (key == "spark.sql.shuffle.partitions" and shuffle_partitions):
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder;
    it is read from the session and never replaced. Only where it is unset and
    the master is ``local`` (tests on one machine) is a fresh temp folder used;
    elsewhere executors would not see it, so an unset folder is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    local = tempfile.mkdtemp(prefix="tripkpi-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it; a missing one is no error."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """Each job started inside deletes its shuffle files when it ends; else they stay on the executors' disks until the
    driver happens to collect its garbage, and the shuffles of a chain of writes add up."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A scratch folder that is deleted afterwards, for tables that nothing returned depends on."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        drop_path(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/tripkpi/{name}-{uuid.uuid4().hex[:12]}"

"""Landing-area manifest (S8, S9, S10): which downloaded file goes to which raw folder.

Instead of listing a local directory in Python and parsing names with ``re``,
the file names are a DataFrame column (``list_landing`` reads only the paths
of a folder through the ``binaryFile`` source, never the contents) and the
periods come from ``regexp_extract``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi import schemas as S


def list_landing(spark: SparkSession, landing_dir: str, glob: str = "*.csv") -> DataFrame:
    """Paths of the landing folder's files (content column pruned, never read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .load(landing_dir).select("path"))


def _file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*$", 0)


def landing_manifest(paths: DataFrame, raw_root: str = S.RAW_ROOT, path_col: str = "path") -> DataFrame:
    """S8 + S10: ``path, file_name, layout, period, target`` for each recognised file.

    New-layout names give a ``yyyyMM`` period, old-layout names a ``yyyy``
    period; any other name (split parts, backups, typos) is left out. The
    target is ``<raw_root>/<period>/data.csv``.
    """
    name = _file_name(F.col(path_col))
    new_p = F.regexp_extract(name, "^" + S.LANDING_NEW_PATTERN, 1)
    old_p = F.regexp_extract(name, "^" + S.LANDING_OLD_PATTERN, 1)
    out = paths.select(
        F.col(path_col).alias("path"), name.alias("file_name"),
        F.when(new_p != "", F.lit("new")).when(old_p != "", F.lit("old")).alias("layout"),
        F.when(new_p != "", new_p).when(old_p != "", old_p).alias("period"),
    )
    out = out.filter(F.col("layout").isNotNull())
    return out.withColumn("target", F.concat(F.lit(raw_root.rstrip("/") + "/"), F.col("period"),
                                             F.lit("/" + S.RAW_FILE_NAME)))


def split_year_parts(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Split-year parts (``…_YYYY_<n>.csv``) with the year they belong to (S11 grouping key)."""
    name = _file_name(F.col(path_col))
    year = F.regexp_extract(name, "^" + S.LANDING_SPLIT_PATTERN, 1)
    return (paths.select(F.col(path_col).alias("path"), name.alias("file_name"), year.alias("year"))
            .filter(F.col("year") != ""))


def month_spine(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Every year expanded to its twelve ``yyyyMM`` periods."""
    y = F.col(year_col).cast("int")
    return (years.select(y.alias("year")).distinct()
            .select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
            .withColumn("period", F.format_string("%04d%02d", F.col("year"), F.col("month"))))


SNAPSHOT = ["source", "path", "folder", "period", "length", "modified"]


def file_snapshot(spark: SparkSession, glob: str, source: str, period_regex: str) -> DataFrame:
    """``source, path, folder, period, length, modified`` of the files that match; their contents aren't read.

    ``folder`` is the name of the file's folder. Files without a period in their path are left out.
    """
    files = spark.read.format("binaryFile").load(glob)
    return files.select(F.lit(source).alias("source"), "path", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"),
                        F.regexp_extract("path", period_regex, 1).alias("period"), "length",
                        F.col("modificationTime").alias("modified")).where(F.col("period") != "")


def snapshot_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """Files of two snapshots by a full outer join on path: ``source, folder, period, path, status``.

    ``status`` is added, removed, changed (other size or modification time) or same.
    """
    a, b = before.alias("a"), now.alias("b")
    both = a.join(b, (F.col("a.source") == F.col("b.source")) & (F.col("a.path") == F.col("b.path")), "full")
    equal = (F.col("a.length") == F.col("b.length")) & (F.col("a.modified") == F.col("b.modified"))
    status = (F.when(F.col("a.path").isNull(), "added").when(F.col("b.path").isNull(), "removed")
              .when(equal, "same").otherwise("changed"))
    return both.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("source", "folder", "period", "path")], status.alias("status"))


def changed_periods(changes: DataFrame) -> DataFrame:
    """``source, folder, period, status`` of the periods with any file added, removed or changed.

    ``status`` is added (all files new), removed (no file left) or changed.
    """
    is_ = lambda s: F.count_if(F.col("status") == s)
    n = F.count("*")
    status = F.when(is_("added") == n, "added").when(is_("removed") == n, "removed").when(is_("same") == n, "same").otherwise("changed")
    return changes.groupBy("source", "folder", "period").agg(status.alias("status")).where("status != 'same'")

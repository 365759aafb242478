"""Raw trip CSV sources.

Folder discovery is a path glob, not a driver-side listing loop: Spark's file
index expands ``<base>/<period folder>/<file>`` and every row carries its
file path (``_metadata.file_path``), from which the period key is extracted
with ``regexp_extract``.

A multi-file CSV read binds columns by position, using the first file's
header for all files, so two files with the same columns in another order
would silently swap values. The reader therefore first makes an index of
headers: a job with one task per file, which takes the file's first lines and
stops. Then there is one native CSV scan per distinct header (normally one),
each with its own column order, united by name. Nothing is copied. Distinct
headers reach the driver, and file paths where there is more than one header.

Headers repeated inside a file (parts joined with ``cat``) are not data rows; a
header inside a file that differs from the file's own is an error, raised by
the index where it stands among the first lines, else by the scan that meets
it. ``headers_known=True`` does without the index: one native CSV read in which
Spark checks every file's header against the first (``enforceSchema=false``)
and fails rather than swap columns.
"""

from __future__ import annotations

import csv
import io
import re
from functools import reduce
from itertools import islice
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkpi import schemas as S
from tripkpi.operators import cleaning
from tripkpi.session import scratch_path

FIRST_LINES = 1000           # lines of a file that the header index takes
DRAINED = 200                # batches of so many lines that it reads on and drops, if the file ends there
WHOLE_FILE = 1 << 50         # no file is larger: none is split
CSV_OPTIONS = {"header": "true", "inferSchema": "false", "quote": '"', "escape": "\\"}


def period_regex(digits: int) -> str:
    # <folder>/<file>: folder is the period, optionally written Hive-style "key=".
    return rf"/(?:[^/=]+=)?([0-9]{{{digits}}})/[^/]+$"


def _default_folder_glob(digits: int) -> str:
    return "[0-9]" * digits


def _parse_header(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader(io.StringIO(line.lstrip("\ufeff")), quotechar='"', escapechar="\\")))


def _first_lines(names: tuple[str, ...]):
    """What `_header_index` keeps of a file's lines, as a function of its batches."""
    def first_lines(batches):
        for b in batches:
            kept = [line for line in b.column(1).to_pylist() if line and line.strip()]
            if not kept:
                continue
            own, path = kept[0], b.column(0)[0].as_py()
            heads = {line for line in kept if all(n in line for n in names)}
            yield pa.RecordBatch.from_pydict({"source_file": [path], "header": [own if own in heads else None],
                                              "others": [len(heads - {own}) > 0]})
            for _ in islice(batches, DRAINED):
                pass
            return

    return first_lines


def _header_index(spark: SparkSession, glob: str, layout: S.Layout, pattern: str) -> DataFrame:
    """``source_file, header, others`` per file with a period in its path: its first line that is not blank, and
    whether another header line than that follows among the first lines.

    Read in a session of its own, in which no file is split or packed with others, so that each task holds one
    file and ends after one small Arrow batch of its lines. A Python worker that leaves input unread is not used
    again, and the next task pays for a new one: so the rest of a small file is read and dropped.
    """
    probe = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        probe.conf.set(key, str(WHOLE_FILE))
    probe.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(FIRST_LINES))
    try:
        lines = probe.read.text(glob).select(F.col("_metadata.file_path").alias("source_file"), "value")
    except AnalysisException as e:
        raise ValueError(f"no {layout.name}-layout CSV files match {glob}") from e

    # the period is looked for once a file, not once a line
    found = lines.mapInArrow(_first_lines((layout.duration, layout.start, layout.end)), "source_file string, header string, others boolean").where(
        F.regexp_extract("source_file", pattern, 1) != "")
    path = scratch_path(spark, "header-index")
    found.write.parquet(path)                            # one row per file
    return spark.read.schema(found.schema).parquet(path)


def _checked_headers(index: DataFrame, layout: S.Layout, glob: str) -> dict[str, tuple[str, ...]]:
    """Distinct header line -> column names, after checking that every file starts with a header and has one kind.

    The driver gets the distinct header lines and, for an error, three paths.
    """
    for bad, what in ((F.col("header").isNull(), f"without a {layout.name}-layout header"),
                      (F.col("others"), "with different header lines")):
        some = [r.source_file for r in index.where(bad).limit(3).collect()]
        if some:
            raise ValueError(f"files {what}, e.g. {some}")
    found = {r.header: _parse_header(r.header) for r in index.select("header").distinct().collect()}
    if not found:
        raise ValueError(f"no {layout.name}-layout header found in files matching {glob}")
    for header in found.values():
        missing = [c for c in layout.required if c not in header]
        if missing:
            raise ValueError(f"a header of {glob} is missing required columns {missing}: {header}")
    return found


def _readable(path: str) -> str:
    """A file path as Spark's metadata gives it (a URI), in the form that its readers take: decoded, globs escaped."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(path))


def _native_scan(spark: SparkSession, paths: str | list[str], header: tuple[str, ...], layout: S.Layout) -> DataFrame:
    """One CSV scan of files with one header; header lines inside the files are left out."""
    names = [n if n not in header[:i] else f"{n}{i}" for i, n in enumerate(header)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.schema(schema).options(**{k: v for k, v in CSV_OPTIONS.items() if k != "inferSchema"}).csv(paths)
    duration, start = F.col(f"`{layout.duration}`"), F.col(f"`{layout.start}`")
    again = F.coalesce((duration == layout.duration) & (start == layout.start), F.lit(False))
    other = F.coalesce(duration.isin(layout.required) | start.isin(layout.required), F.lit(False)) & ~again
    wrong = F.raise_error(F.concat(F.lit("different header line inside "), F.col("_metadata.file_path"))).cast("boolean")
    return df.where(F.when(other, wrong).otherwise(~again)).withColumn("source_file", F.col("_metadata.file_path"))


def _united(spark: SparkSession, glob: str, layout: S.Layout, index: DataFrame, headers: dict[str, tuple[str, ...]]) -> list[DataFrame]:
    """The native scans, one for each distinct column order."""
    orders = list(dict.fromkeys(headers.values()))
    if len(orders) == 1:
        return [_native_scan(spark, glob, orders[0], layout)]
    files: dict[tuple[str, ...], list[str]] = {o: [] for o in orders}
    for r in index.select("source_file", "header").collect():
        files[headers[r.header]].append(_readable(r.source_file))
    return [_native_scan(spark, sorted(paths), order, layout) for order, paths in files.items()]


def scan_layout(spark: SparkSession, glob: str, layout: S.Layout, pattern: str,
                headers_known: bool = False) -> DataFrame:
    """Read all CSV files matching ``glob`` as strings, by header name.

    Returns the conformed raw frame (see ``operators.cleaning``) plus
    ``period`` (the key matched by ``pattern`` on the file path) and
    ``source_file``. Files whose path does not yield a key are left out, and
    so are header lines wherever they stand.
    """
    if headers_known:
        try:
            df = spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false").csv(glob)
        except AnalysisException as e:
            raise ValueError(f"no CSV files at {glob}") from e
        missing = [c for c in layout.required if c not in df.columns]
        if missing:
            raise ValueError(f"files at {glob} are missing required columns {missing}")
        scans = [df.withColumn("source_file", F.col("_metadata.file_path"))]
    else:
        index = _header_index(spark, glob, layout, pattern)
        scans = _united(spark, glob, layout, index, _checked_headers(index, layout, glob))
    period = F.regexp_extract("source_file", pattern, 1)
    parts = [cleaning.conform_layout(df.withColumn("period", period).where(F.col("period") != ""), layout, extra=["period", "source_file"])
             for df in scans]
    return reduce(DataFrame.unionByName, parts)


def scan_new_layout(spark: SparkSession, base: str, folder_glob: str | None = None,
                    file_glob: str = S.RAW_FILE_NAME, headers_known: bool = False) -> DataFrame:
    """S1 + S3: ``<base>/<yyyyMM>/data.csv`` files of the new layout."""
    folder_glob = folder_glob or _default_folder_glob(6)
    return scan_layout(spark, f"{base.rstrip('/')}/{folder_glob}/{file_glob}", S.NEW_LAYOUT,
                       period_regex(6), headers_known)


def scan_old_layout(spark: SparkSession, base: str, folder_glob: str | None = None,
                    file_glob: str = S.RAW_FILE_NAME, headers_known: bool = False) -> DataFrame:
    """S2 + S4: ``<base>/<yyyy>/data.csv`` files of the old layout."""
    folder_glob = folder_glob or _default_folder_glob(4)
    return scan_layout(spark, f"{base.rstrip('/')}/{folder_glob}/{file_glob}", S.OLD_LAYOUT,
                       period_regex(4), headers_known)


def scan_split_years(spark: SparkSession, landing_glob: str,
                     year_regex: str = S.LANDING_SPLIT_PATTERN) -> DataFrame:
    """Old-layout files split into parts of one year, read as one year each.

    Replaces concatenating the parts on disk: every part keeps its own header
    (no header rows left mid-file), and the year key comes from the path.
    """
    return scan_layout(spark, landing_glob, S.OLD_LAYOUT, year_regex)

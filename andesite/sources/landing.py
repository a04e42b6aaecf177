"""Landed files: which there are, which are new, and which cannot be read.

A *listing* is one row per file: its path as rows carry it in ``_metadata.file_path``, the path to read it
by, modification time and size.  Spark lists folders and reads no content for it.

A *ledger* is a folder of Parquet files that holds the listing rows of what was loaded.  A file is new
unless a row of the ledger has its path, time and size, so a changed file is new again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from andesite.sources.relations import empty_like, literal_table

IDENTITY = ["file_path", "modified", "size"]
# The time is in microseconds since 1970.
LISTING = "file_path string, path string, modified bigint, size bigint"
# Reasons of files without rows.
UNREADABLE = "file cannot be read"
# A Parquet file begins and ends with these bytes.
PARQUET_MARK = b"PAR1"


def _is_missing(e: AnalysisException) -> bool:
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def landed_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The listing of the files under a folder (or of some files); a missing folder has none."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if _is_missing(e):
            return empty_like(spark, LISTING)
        raise
    return files.select(
        "_metadata.file_path", "path", F.unix_micros("modificationTime").alias("modified"), F.col("length").alias("size"))


def ledger_rows(spark: SparkSession, ledger: str) -> DataFrame:
    """What the ledger holds; nothing before its first entry."""
    schema = f"{LISTING}, run_ts string"
    try:
        return spark.read.schema(schema).parquet(ledger)
    except AnalysisException as e:
        if _is_missing(e):
            return empty_like(spark, schema)
        raise


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """The listed files that the ledger does not hold as they are now."""
    return listing.join(ledger.select(*IDENTITY), IDENTITY, "left_anti")


def record(files: DataFrame, ledger: str, run_ts: str) -> None:
    """Add files to the ledger; call it after their rows are stored."""
    files.select("file_path", "path", "modified", "size", F.lit(run_ts).alias("run_ts")).write.mode("append").parquet(ledger)


def _as_text(path: str) -> str:
    """A path of which no character is read as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def read_files(
    spark: SparkSession, files: DataFrame, fmt: str, schema: str, base: str | None = None, **options
) -> DataFrame:
    """The rows of listed files with ``file_path``; a file that cannot be read has none.

    The paths go through the driver, where Spark keeps the list of files of any scan.  With
    ``base`` the ``key=value`` folders below it are columns, if ``schema`` names them.
    """
    paths = [_as_text(r.path) for r in files.select("path").collect()]
    if not paths:
        return empty_like(spark, f"{schema}, file_path string")
    reader = spark.read.format(fmt).schema(schema).options(
        ignoreCorruptFiles="true", ignoreMissingFiles="true", **options)
    if base is not None:
        reader = reader.option("basePath", base)
    return reader.load(paths).select("*", "_metadata.file_path")


def unreadable_files(files: DataFrame, rows: DataFrame, fmt: str = "text") -> DataFrame:
    """(file_path, size, error): listed files that have bytes and gave no rows.

    A Parquet file that begins and ends as one is empty instead.  Only the content of files
    without rows is looked at.  Damage behind the first rows of a file is not found here: lines
    cut off there are rejected where they are parsed.
    """
    spark = files.sparkSession
    seen = rows.select("file_path").distinct()
    suspects = files.filter("size > 0").join(seen, "file_path", "left_anti")
    if fmt == "parquet":
        paths = [_as_text(r.path) for r in suspects.select("path").collect()]
        if not paths:
            return empty_like(spark, "file_path string, size bigint, error string")
        mark, content = F.lit(PARQUET_MARK), F.col("content")
        whole = F.startswith(content, mark) & F.endswith(content, mark) & (F.col("length") > 8)
        reader = spark.read.format("binaryFile").options(ignoreCorruptFiles="true", ignoreMissingFiles="true")
        marked = reader.load(paths).filter(whole).select("_metadata.file_path")
        suspects = suspects.join(marked, "file_path", "left_anti")
    return suspects.select("file_path", "size", F.lit(UNREADABLE).alias("error"))


def read_isolated_files(
    spark: SparkSession, path: str, fmt: str, schema: str, **options
) -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of the files under a folder: a damaged file costs itself only, and is named.

    Rows have the ``key=value`` folders below ``path`` as columns, if ``schema`` names them.
    """
    files = landed_files(spark, path)
    rows = read_files(spark, files, fmt, schema, base=path, **options)
    return rows, unreadable_files(files, rows, fmt)


@dataclass(frozen=True)
class Pickup:
    """What one pick-up found: the new files, their rows, and those without any."""

    files: DataFrame
    rows: DataFrame
    unreadable: DataFrame


def pick_up(
    spark: SparkSession, path: str, ledger: str, load: Callable[[Pickup], None], run_ts: str,
    fmt: str = "text", schema: str = "value string",
) -> int:
    """Load the files that landed or changed since the last pick-up, and enter them; returns how many.

    ``load`` stores the rows.  If it fails nothing is entered, so the files are picked up again;
    loads are upserts by key and may run twice.  Unreadable files are entered too, as they would fail
    again until they change.
    """
    files = new_files(landed_files(spark, path), ledger_rows(spark, ledger))
    # The files of this run are fixed: what lands while it works is for the next one.
    listed = files.select("file_path", "path", "modified", "size").collect()
    if not listed:
        return 0
    fixed = literal_table(spark, listed, LISTING)
    rows = read_files(spark, fixed, fmt, schema, base=path)
    load(Pickup(fixed, rows, unreadable_files(fixed, rows, fmt)))
    record(fixed, ledger, run_ts)
    return len(listed)

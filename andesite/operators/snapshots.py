"""Dated snapshots: the one that holds on a day, and what changed between two."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

ADDED, GONE, CHANGED = "added", "gone", "changed"


def snapshot_dates(spark: SparkSession, base: str, source: str) -> list[dt.date]:
    """Days with a complete snapshot under ``<base>/<source>/yyyy/MM/dd``, in order.

    A write that was cut off has no ``_SUCCESS`` file, so its day does not count.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{source}/*/*/*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    days = (re.search(r"/(\d{4})/(\d\d)/(\d\d)/_SUCCESS$", s.getPath().toString()) for s in found or ())
    return sorted(dt.date(*map(int, m.groups())) for m in days if m)


def read_snapshot(
    spark: SparkSession, base: str, source: str, as_of: dt.date, schema: StructType | str | None = None
) -> DataFrame:
    """The latest complete snapshot of ``as_of`` or before."""
    days = [d for d in snapshot_dates(spark, base, source) if d <= as_of]
    if not days:
        raise FileNotFoundError(f"no snapshot of {source} up to {as_of} under {base}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{base}/{source}/{days[-1]:%Y/%m/%d}")


def snapshot_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, change, n_gone, n_added, columns) of the keys whose rows differ; nulls equal each other.

    Equal rows cancel out in one aggregation over all columns, copy by copy, so only differences are
    grouped by key and a row that repeats without end costs one row per task.  A key with rows
    on both sides of the differences is changed; ``columns`` names, in the order of the frame, those whose
    least or greatest value in these rows differs.  A column of one frame alone is null in the other.
    """
    both = before.withColumn("_side", F.lit(-1)).unionByName(after.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    names = [c for c in both.columns if c != "_side"]
    counted = both.groupBy(*names).agg(F.sum("_side").alias("_copies")).filter("_copies <> 0")
    old, new = F.col("_copies") < 0, F.col("_copies") > 0
    others = [c for c in names if c not in keys]
    extremes = [
        f(F.when(side, F.col(c))).alias(f"_{part}_{i}")
        for i, c in enumerate(others)
        for side, tag in ((old, "old"), (new, "new"))
        for f, part in ((F.min, f"least_{tag}"), (F.max, f"most_{tag}"))
    ]
    grouped = counted.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(old, -F.col("_copies"))), F.lit(0)).alias("n_gone"),
        F.coalesce(F.sum(F.when(new, F.col("_copies"))), F.lit(0)).alias("n_added"),
        *extremes,
    )
    change = F.when(F.col("n_gone") == 0, ADDED).when(F.col("n_added") == 0, GONE).otherwise(CHANGED)
    differing = [
        F.when(
            ~(F.col(f"_least_old_{i}").eqNullSafe(F.col(f"_least_new_{i}"))
              & F.col(f"_most_old_{i}").eqNullSafe(F.col(f"_most_new_{i}"))),
            F.lit(c),
        )
        for i, c in enumerate(others)
    ]
    listed = F.array_compact(F.array(*differing)) if differing else F.array().cast("array<string>")
    return grouped.select(
        *keys, change.alias("change"), "n_gone", "n_added",
        F.when(change == CHANGED, listed).alias("columns"),
    )

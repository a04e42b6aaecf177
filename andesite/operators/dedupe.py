"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = (),
    last: bool = False,
    where: Column | None = None,
) -> DataFrame:
    """One row per key: the first (or ``last``) in ``order_by``, then in all other columns.

    The full order makes the survivor independent of input order and partitioning; nulls come
    first.  ``order_by=None`` keeps any one row instead.  Only rows that satisfy ``where`` can
    survive.  It is tested inside the aggregation, on columns already computed; a filter before
    it would be pushed down and have Spark compute expensive columns a second time.

    The choice is an aggregation, so every task cuts a key to one row *before* the shuffle and
    a key that holds a third of all rows sends at most one row per task to its reducer.
    """
    if order_by is None:
        rows = df if where is None else df.filter(where)
        return rows.dropDuplicates(list(keys))
    lead = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    if not lead + rest:
        rows = df if where is None else df.filter(where)
        return rows.distinct()
    row = F.struct(*lead, *rest)
    if where is not None:
        row = F.when(where, row)
    pick = F.max if last else F.min
    single = df.groupBy(*keys).agg(pick(row).alias("_row"))
    if where is not None:
        single = single.filter(F.col("_row").isNotNull())
    return single.select(
        *[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    )


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order_by``."""
    return dedupe(df, keys, order_by, last=True)


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Rows of ``existing`` replaced or extended by ``incoming``, matching on ``keys``.

    Among incoming rows of the same key the last in ``order_by`` wins.  Both sides are read
    once, in a single aggregation.  Null keys match each other.
    """
    tagged = existing.withColumn("_new", F.lit(False)).unionByName(incoming.withColumn("_new", F.lit(True)))
    return latest(tagged, keys, ["_new", *order_by]).drop("_new")


def same_values(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    """Condition of a join in which nulls match each other; ``right`` has the columns as ``_in_*``."""
    same = F.lit(True)
    for c in cols:
        same = same & left[c].eqNullSafe(right[f"_in_{c}"])
    return same


def merge(existing: DataFrame, winners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Like ``upsert`` for ``winners`` that are stored and unique per key already.

    ``existing`` is only anti-joined: while the incoming keys are small Spark broadcasts them and
    the existing rows are not shuffled.
    """
    touched = winners.select(*[F.col(k).alias(f"_in_{k}") for k in keys])
    return existing.join(touched, same_values(existing, touched, keys), "left_anti").unionByName(winners)

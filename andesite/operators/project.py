"""Projection, renaming, tagging and row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from andesite.functions.text import is_placeholder
from andesite.schemas import INDICATORS, names


def resolve_columns(df: DataFrame, candidates: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Pick for every logical column the first candidate that the frame has.

    Raises ``ValueError`` naming the logical columns without a match.
    """
    have = set(df.columns)
    found = {
        logical: next((c for c in options if c in have), None)
        for logical, options in candidates.items()
    }
    missing = [logical for logical, name in found.items() if name is None]
    if missing:
        raise ValueError(f"no source column for {missing}; available: {df.columns}")
    return found


def conform_indicators(df: DataFrame, mapping: Mapping[str, str], source: str) -> DataFrame:
    """Project to the canonical indicator columns under one source tag."""
    renamed = [F.col(name).alias(logical) for logical, name in mapping.items()]
    return df.select(*renamed, F.lit(source).alias("source"))


def with_source(df: DataFrame, tag: str) -> DataFrame:
    return df.withColumn("source", F.lit(tag))


def with_partition_key(df: DataFrame, c: str) -> DataFrame:
    """Text copy of the column that a document collection is partitioned on."""
    return df.withColumn("_partition_key", F.col(c).cast("string"))


def with_raw(df: DataFrame, c: str) -> DataFrame:
    """Keep a parsed payload as JSON text."""
    return df.withColumn("raw_response", F.to_json(c))


def with_ingest_ts(df: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """The same ISO-8601 text on every row of a run."""
    text = run_ts if isinstance(run_ts, str) else run_ts.isoformat()
    return df.withColumn("ingestion_timestamp", F.lit(text))


def _stamp(run_ts: str | dt.datetime | None) -> Column:
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def with_processed_ts(
    df: DataFrame, run_ts: str | dt.datetime | None = None, name: str = "processed_timestamp"
) -> DataFrame:
    """Processing time; give ``run_ts`` when several writes must carry the same stamp."""
    return df.withColumn(name, _stamp(run_ts))


def drop_placeholders(df: DataFrame, c: str) -> DataFrame:
    return df.filter(~is_placeholder(c))


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in cols]))


def positive(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c) > 0)


def cast_cols(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns in place; text that does not convert becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def select_common(df: DataFrame, columns: Iterable[str] = tuple(names(INDICATORS))) -> DataFrame:
    return df.select(*columns)


def unify(*dfs: DataFrame) -> DataFrame:
    """Union by column name, keeping every row."""
    out, *rest = dfs
    for df in rest:
        out = out.unionByName(df)
    return out

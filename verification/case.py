"""Registration of a query together with its SQL."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def case(sql: str) -> Callable[[Query], Query]:
    """Register a query function under its own name."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        SQL[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A new folder that all executors share; where the session names none (tests), a local one."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="andesite-shared-"))
    return f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/query-{uuid.uuid4().hex}"

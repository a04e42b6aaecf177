"""Relations written in code, typed empty relations and collection scans."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _schema(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def literal_table(
    spark: SparkSession, rows: Iterable[Sequence], schema: str | StructType
) -> DataFrame:
    """A relation of a few rows written in code.

    The rows travel as one Arrow table, which Spark plans as a local relation with an exact
    size.  The optimizer therefore broadcasts it in joins on its own, and would stop doing so
    if it outgrew ``spark.sql.autoBroadcastJoinThreshold``.
    """
    st = _schema(schema)
    columns = list(zip(*rows)) or [()] * len(st.names)
    table = pa.table({name: list(values) for name, values in zip(st.names, columns)})
    return spark.createDataFrame(table, schema=st)


def empty_like(spark: SparkSession, schema: str | StructType) -> DataFrame:
    """A typed relation without rows, for a source that has no data."""
    return spark.createDataFrame([], _schema(schema))


def read_collection(
    spark: SparkSession,
    name: str,
    fmt: str | None = None,
    schema: str | StructType | None = None,
    **options,
) -> DataFrame:
    """Scan a document collection: a table by name, or a directory when ``fmt`` is given.

    Without ``schema`` the fields are inferred and merged over all files.  File scans report
    every field as nullable, whatever the files declare.  JSON inference reads the data once
    more; pass ``schema`` (or ``samplingRatio``) for large collections.
    """
    if fmt is None:
        return spark.table(name)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        return reader.schema(_schema(schema)).load(name)
    return reader.option("mergeSchema", "true").load(name)

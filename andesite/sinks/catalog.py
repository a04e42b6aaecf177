"""Layers and tables in the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from andesite.schemas import LAYER_TABLES, struct
from andesite.sources.relations import literal_table


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_schema(
    spark: SparkSession, name: str, comment: str | None = None, location: str | None = None
) -> None:
    """Create a layer unless it exists."""
    clauses = [f"COMMENT {_text(comment)}"] if comment else []
    clauses += [f"LOCATION {_text(location)}"] if location else []
    spark.sql(" ".join([f"CREATE SCHEMA IF NOT EXISTS {name}", *clauses]))


def ensure_table(
    spark: SparkSession,
    name: str,
    ddl: str,
    fmt: str = "parquet",
    location: str | None = None,
    comment: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Create a typed table unless it exists.  Spark stores partition columns last."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in struct(ddl))
    clauses = [f"USING {fmt}"]
    clauses += [f"PARTITIONED BY ({', '.join(partition_by)})"] if partition_by else []
    clauses += [f"LOCATION {_text(location)}"] if location else []
    clauses += [f"COMMENT {_text(comment)}"] if comment else []
    spark.sql(" ".join([f"CREATE TABLE IF NOT EXISTS {name} ({columns})", *clauses]))


def drop_layer(spark: SparkSession, layer: str, tables: Sequence[str] | None = None) -> list[str]:
    """Drop a layer's tables, then the layer; returns what failed and goes on past it."""
    failures = []

    def attempt(statement: str) -> None:
        try:
            spark.sql(statement)
        except PySparkException as e:
            failures.append(f"{statement}: {e}")

    if tables is None:
        known = spark.catalog.databaseExists(layer)
        tables = [t.name for t in spark.catalog.listTables(layer) if not t.isTemporary] if known else []
    for table in tables:
        attempt(f"DROP TABLE IF EXISTS {layer}.{table}")
    attempt(f"DROP SCHEMA IF EXISTS {layer} CASCADE")
    return failures


def list_layers(spark: SparkSession, layers: Sequence[str] = tuple(LAYER_TABLES)) -> DataFrame:
    """Number of tables in every layer."""
    listed = None
    for layer in layers:
        one = spark.sql(f"SHOW TABLES IN {layer}").filter(~F.col("isTemporary"))
        one = one.agg(F.count("*").alias("tables")).select(F.lit(layer).alias("layer"), "tables")
        listed = one if listed is None else listed.unionByName(one)
    return listed


def ensure_layers(
    spark: SparkSession,
    prefix: str = "",
    fmt: str = "parquet",
    base: str | None = None,
    partitions: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Create the three layers with all their tables under ``<prefix><layer>``."""
    for layer, tables in LAYER_TABLES.items():
        ensure_schema(spark, prefix + layer)
        for table, ddl in tables.items():
            ensure_table(
                spark,
                f"{prefix}{layer}.{table}",
                ddl,
                fmt,
                location=f"{base}/{layer}/{table}" if base else None,
                partition_by=(partitions or {}).get(table, ()),
            )


DRIFT = "layer string, table_name string, column_name string, declared string, stored string, drift string"
NO_TABLE, NO_COLUMN, OTHER_TYPE, UNDECLARED = "missing table", "missing column", "other type", "undeclared column"


def layer_drift(
    spark: SparkSession, prefix: str = "", declared: Mapping[str, Mapping[str, str]] = LAYER_TABLES
) -> DataFrame:
    """(layer, table_name, column_name, declared, stored, drift) where the catalog departs from the declaration.

    Only the catalog is read, no table.  Names are compared as the catalog does, without regard to case.
    """
    found = []
    for layer, tables in declared.items():
        for table, ddl in tables.items():
            name = f"{prefix}{layer}.{table}"
            if not spark.catalog.tableExists(name):
                found.append((layer, table, None, None, None, NO_TABLE))
                continue
            stored = {f.name.lower(): f for f in spark.table(name).schema}
            wanted = {f.name.lower(): f for f in struct(ddl)}
            for key, f in wanted.items():
                kind = f.dataType.simpleString()
                if key not in stored:
                    found.append((layer, table, f.name, kind, None, NO_COLUMN))
                elif stored[key].dataType.simpleString() != kind:
                    found.append((layer, table, f.name, kind, stored[key].dataType.simpleString(), OTHER_TYPE))
            found += [(layer, table, f.name, None, f.dataType.simpleString(), UNDECLARED)
                      for key, f in stored.items() if key not in wanted]
    return literal_table(spark, found, DRIFT)


def add_missing_columns(
    spark: SparkSession, prefix: str = "", declared: Mapping[str, Mapping[str, str]] = LAYER_TABLES
) -> list[str]:
    """Add declared columns that stored tables lack; returns the statements, none on a second run.

    Rows stored before read null in them.  Other departures are for ``layer_drift`` to report: a change of
    type or the loss of a column is never made here.
    """
    missing: dict[str, list[str]] = {}
    for row in layer_drift(spark, prefix, declared).filter(F.col("drift") == NO_COLUMN).collect():
        missing.setdefault(f"{prefix}{row.layer}.{row.table_name}", []).append(f"`{row.column_name}` {row.declared}")
    statements = [f"ALTER TABLE {name} ADD COLUMNS ({', '.join(columns)})" for name, columns in missing.items()]
    for statement in statements:
        spark.sql(statement)
    return statements

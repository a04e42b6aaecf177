"""What store assignment would refuse, listed before an insert."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from andesite.sinks.tables import overwrite_table
from andesite.sources.relations import literal_table

MISSING, UNKNOWN, TYPE, VALUE, LENGTH, NULL = (
    "missing column", "unknown column", "type not assignable", "value does not fit", "text too long", "null")
REPORT = "column_name string, from_type string, to_type string, problem string, n_rows bigint, example string"


class AssignmentError(ValueError):
    """Rows or columns that a table cannot take."""


def table_types(spark: SparkSession, table: str) -> dict[str, tuple[str, bool]]:
    """Type, with the length of a varchar, and nullability of each column, in table order."""
    described = {}
    for row in spark.sql(f"DESCRIBE TABLE {table}").collect():
        if not row.col_name or row.col_name.startswith("#"):
            break
        described[row.col_name] = row.data_type
    nullable = {c.name: c.nullable for c in spark.catalog.listColumns(table)}
    return {name: (kind, nullable.get(name, True)) for name, kind in described.items()}


def _plain(kind: str) -> T.DataType:
    """The type that values of a column have; texts of a bounded length are strings."""
    return T.StringType() if re.match(r"(var)?char\(", kind) else T.DataType.fromDDL(kind)


def assignable(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether values of one type may be stored as the other under the ANSI policy; nested types must equal."""
    if given == wanted or isinstance(given, T.NullType):
        return True
    if isinstance(wanted, T.StringType):
        return not isinstance(given, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))
    days = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return (isinstance(given, T.NumericType) and isinstance(wanted, T.NumericType)) or (
        isinstance(given, days) and isinstance(wanted, days))


def _tests(value: Column, kind: str, nullable: bool) -> list[tuple[str, Column]]:
    tests = [] if nullable else [(NULL, value.isNull())]
    limit = re.match(r"(?:var)?char\((\d+)\)", kind)
    if limit:
        # Trailing blanks beyond the length are cut, not refused.
        return [*tests, (LENGTH, F.length(F.rtrim(value.cast("string"))) > int(limit[1]))]
    return [*tests, (VALUE, value.isNotNull() & value.try_cast(_plain(kind)).isNull())]


def assignment_report(df: DataFrame, wanted: dict[str, tuple[str, bool]]) -> DataFrame:
    """(column_name, from_type, to_type, problem, n_rows, example) of all that a table would refuse.

    ``wanted`` is what ``table_types`` tells.  Columns that cannot be assigned at all have neither a number of rows
    nor an example; values are counted in one aggregation over the frame, with the least as the example.
    """
    given = {f.name: f.dataType for f in df.schema}
    fixed = [(c, None, k, MISSING) for c, (k, _) in wanted.items() if c not in given]
    fixed += [(c, t.simpleString(), None, UNKNOWN) for c, t in given.items() if c not in wanted]
    aggregates, rows = [], []
    for name, (kind, nullable) in wanted.items():
        if name not in given:
            continue
        source = given[name].simpleString()
        if not assignable(given[name], _plain(kind)):
            fixed.append((name, source, kind, TYPE))
            continue
        value = F.col(f"`{name}`")
        for problem, bad in _tests(value, kind, nullable):
            i = len(rows)
            aggregates += [F.count_if(bad).alias(f"n_{i}"), F.min(F.when(bad, value)).cast("string").alias(f"x_{i}")]
            rows.append(F.struct(
                F.lit(name).alias("column_name"), F.lit(source).alias("from_type"), F.lit(kind).alias("to_type"),
                F.lit(problem).alias("problem"), F.col(f"n_{i}").alias("n_rows"), F.col(f"x_{i}").alias("example")))
    spark = df.sparkSession
    listed = literal_table(spark, [(*f, None, None) for f in fixed], REPORT)
    if not rows:
        return listed
    values = df.agg(*aggregates).select(F.inline(F.array(*rows))).filter("n_rows > 0")
    return listed.union(values) if fixed else values


def overwrite_checked(df: DataFrame, table: str) -> None:
    """Replace a table's content, or name every column it cannot take and leave the table alone."""
    problems = assignment_report(df, table_types(df.sparkSession, table)).collect()
    if problems:
        raise AssignmentError("; ".join(
            f"{p.column_name}: {p.problem}" + (f" in {p.n_rows} rows, such as {p.example}" if p.n_rows else "")
            for p in problems))
    overwrite_table(df, table)

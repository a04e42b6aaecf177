"""Reports on the constraints that a star schema declares.

Each report over columns is one aggregation of the input, whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from andesite import schemas
from andesite.functions.calendar import month_is_known, month_start, period_month, period_year
from andesite.functions.text import clean_number
from andesite.operators.joins import fk_orphans
from andesite.operators.project import unify
from andesite.sources.relations import literal_table


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


def _per_column(df: DataFrame, tests: Mapping[str, Column], out: str) -> DataFrame:
    """Rows for which each test holds, one line per column with a non-zero count."""
    counts = df.agg(*[F.count_if(test).alias(c) for c, test in tests.items()])
    return counts.unpivot([], list(tests), "column_name", out).filter(F.col(out) > 0)


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns that must not be null but are, with their number of nulls."""
    return _per_column(df, {c: F.col(c).isNull() for c in cols}, "n_nulls")


def to_serving_types(df: DataFrame, spec: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Cast columns to decimal(p, s), rounding half up; a value that does not fit is null."""
    return df.withColumns(
        {c: F.col(c).try_cast(f"decimal({p},{s})") for c, (p, s) in spec.items()}
    )


def serving_overflows(df: DataFrame, spec: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Columns with values too large for their decimal type, with the number of such values."""
    tests = {
        c: F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()
        for c, (p, s) in spec.items()
    }
    return _per_column(df, tests, "n_overflows")


def length_violations(df: DataFrame, spec: Mapping[str, int]) -> DataFrame:
    """Text columns with values over their declared length, with the number of such values."""
    return _per_column(df, {c: F.length(c) > n for c, n in spec.items()}, "n_too_long")


def _row_checks(table: str) -> dict[tuple[str, str], Column]:
    """The declared tests of single rows of a table, by check and column; true where broken."""
    tests = {("not null", c): F.col(c).isNull() for c in schemas.NOT_NULL.get(table, ())}
    for c, (p, s) in schemas.DECIMALS.get(table, {}).items():
        tests["decimal", c] = F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()
    for c, n in schemas.TEXT_LENGTHS.get(table, {}).items():
        tests["length", c] = F.length(c) > n
    return tests


def check_star(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All declared constraints of a star schema that its tables break.

    One line per table, check and column, with the number of keys (primary key) or rows.  A table
    is read once for its primary key and all tests of rows together, and once more for each
    foreign key from or to it; facts are counted per key before they meet a dimension.
    """
    reports = []
    for table, df in tables.items():
        tests, keys = _row_checks(table), schemas.PRIMARY_KEYS.get(table)
        counts = [F.count_if(test).alias(f"n{i}") for i, test in enumerate(tests.values())]
        totals = {name: F.sum(f"n{i}") for i, name in enumerate(tests)}
        if keys:
            totals["primary key", ", ".join(keys)] = F.count_if(F.col("_rows") > 1)
        if totals:
            by_key = df.groupBy(*keys or ()).agg(F.count("*").alias("_rows"), *counts)
            lines = F.explode(F.array(*[
                F.struct(F.lit(check).alias("check"), F.lit(column).alias("column_name"), F.col(f"t{i}").alias("n_rows"))
                for i, (check, column) in enumerate(totals)
            ])).alias("line")
            whole = by_key.agg(*[total.alias(f"t{i}") for i, total in enumerate(totals.values())])
            reports.append(whole.select(F.lit(table).alias("table_name"), lines).select("table_name", "line.*"))
        for column, dim in schemas.FOREIGN_KEYS.get(table, {}).items():
            orphans = fk_orphans(df, tables[dim], column).agg(F.sum("n_rows").alias("n_rows"))
            reports.append(orphans.select(
                F.lit(table).alias("table_name"), F.lit("foreign key").alias("check"),
                F.lit(column).alias("column_name"), "n_rows"))
    return unify(*reports).filter("n_rows > 0")


def registry_check(registry: DataFrame, expected: DataFrame, key: str = "id") -> DataFrame:
    """Ids that are expected but missing, or present but unexpected."""
    have, want = registry.select(key).distinct(), expected.select(key).distinct()
    missing = want.join(have, key, "left_anti").withColumn("status", F.lit("missing"))
    extra = have.join(want, key, "left_anti").withColumn("status", F.lit("unexpected"))
    return missing.unionByName(extra)


def registry_sizes(spark: SparkSession, sizes: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """Registries whose number of rows differs from the expected one."""
    counts = None
    for name, (df, _) in sizes.items():
        one = df.agg(F.count("*").alias("found")).withColumn("registry", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    want = literal_table(
        spark, [(n, k) for n, (_, k) in sizes.items()], "registry string, expected bigint"
    )
    return counts.join(want, "registry").filter(F.col("found") != F.col("expected"))


def period_label_report(df: DataFrame, period: str = "period", value: str = "value") -> DataFrame:
    """Rows the series clean drops or guesses: no usable year, unknown month, unreadable value."""
    date = month_start(period_year(period), period_month(period))
    return df.agg(
        F.count("*").alias("records"),
        F.count_if(date.isNull()).alias("without_year"),
        F.count_if(~month_is_known(period)).alias("unknown_month"),
        F.count_if(clean_number(value).isNull()).alias("unreadable_value"),
    )

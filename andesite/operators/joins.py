"""Lookups, expected cells, extraction windows and star views.

No join here carries a broadcast hint.  Spark broadcasts a registry or dimension when its
known or measured size is under ``spark.sql.autoBroadcastJoinThreshold``; beyond it the join
is shuffled, and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from andesite.registry import SERIES_FIRST_YEAR


def enrich_from_registry(df: DataFrame, registry: DataFrame, on: str = "id") -> DataFrame:
    """Stamp the registry's attributes on matching rows; unregistered ids are dropped."""
    return df.join(registry, on, "inner")


def lookup_or_code(
    df: DataFrame, dim: DataFrame, code_col: str, out: str, key: str = "code", name: str = "name"
) -> DataFrame:
    """Add the name of a code, or the code's own text when it is unknown or not numeric."""
    code = F.col(code_col)
    number = F.when(code.rlike(r"^[0-9]+$"), code.try_cast("int"))
    side = dim.select(F.col(key).alias("_key"), F.col(name).alias("_name"))
    named = df.withColumn("_number", number).join(side, F.col("_number") == F.col("_key"), "left")
    return named.withColumn(out, F.coalesce("_name", code)).drop("_number", "_key", "_name")


def expected_grid(
    spark: SparkSession, years: tuple[int, int], flows: Sequence[str]
) -> DataFrame:
    """Every (year, flow) cell that should have been delivered."""
    first, last = years
    return spark.range(first, last + 1).select(
        F.col("id").cast("int").alias("year"),
        F.explode(F.array(*map(F.lit, flows))).alias("flow_code"),
    )


def missing_cells(
    grid: DataFrame, df: DataFrame, on: Sequence[str] = ("year", "flow_code")
) -> DataFrame:
    """Expected cells without any row."""
    return grid.join(df.select(*on).distinct(), list(on), "left_anti")


def clip_to_window(
    df: DataFrame,
    registry: DataFrame,
    run_date: dt.date,
    first: dt.date = dt.date(SERIES_FIRST_YEAR, 1, 1),
    date: str = "date",
    on: str = "id",
) -> DataFrame:
    """Keep rows inside the extraction window of their series' frequency.

    Daily series run from ``first`` to ``run_date``; all others cover whole months, from the
    month of ``first`` to the month of ``run_date``.
    """
    freqs = registry.select(on, "freq")
    return df.join(freqs, on, "inner").filter(in_window(run_date, first, date)).drop("freq")


def in_window(
    run_date: dt.date, first: dt.date = dt.date(SERIES_FIRST_YEAR, 1, 1), date: str | Column = "date"
) -> Column:
    """Whether a date lies in the extraction window of the row's ``freq``."""
    day = F.col(date) if isinstance(date, str) else date
    lo, hi = F.lit(first), F.lit(run_date)
    monthly = day.between(F.trunc(lo, "month"), F.last_day(hi))
    return F.when(F.col("freq") == "daily", day.between(lo, hi)).otherwise(monthly)


def clip_years(df: DataFrame, years: tuple[int, int], year: str = "year") -> DataFrame:
    """Keep rows of the requested years, both included."""
    return df.filter(in_years(years, year))


def in_years(years: tuple[int, int], year: str | Column = "year") -> Column:
    """Whether a year is one of the requested ones, both included."""
    value = F.col(year) if isinstance(year, str) else year
    return value.try_cast("int").between(*years)


def fk_orphans(fact: DataFrame, dim: DataFrame, on: str, key: str | None = None) -> DataFrame:
    """Foreign-key values without a dimension row, with their number of fact rows.

    The fact is counted per key before the join, so a hot key is a single row in it.
    Null keys refer to nothing and are no orphans.
    """
    refs = fact.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("n_rows"))
    members = dim.select(F.col(key or on).alias("_member"))
    return refs.join(members, F.col(on) == F.col("_member"), "left_anti")


def _left(fact: DataFrame, dim: DataFrame, on: Column, columns: Sequence[Column]) -> DataFrame:
    return fact.join(dim.select(*columns), on, "left").drop("_k")


def _with_dates(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    parts = ["full_date", "quarter", "month_name", "day_name", "is_weekend"]
    columns = [F.col("date_key").alias("_k"), *map(F.col, parts)]
    return _left(fact, dim_date, F.col("date_key") == F.col("_k"), columns)


def star_indicators(fact: DataFrame, dim_date: DataFrame, dim_indicator: DataFrame) -> DataFrame:
    """Indicator facts with date and indicator attributes; unmatched facts are kept."""
    columns = [F.col("indicator_key").alias("_k"), F.col("indicator_name"), F.col("unit")]
    dated = _with_dates(fact, dim_date)
    return _left(dated, dim_indicator, F.col("indicator_key") == F.col("_k"), columns)


def star_trade(fact: DataFrame, dim_date: DataFrame, dim_partner: DataFrame) -> DataFrame:
    """Trade facts with date and partner attributes; unmatched facts are kept."""
    columns = [F.col("partner_key").alias("_k"), F.col("partner_name"), F.col("region")]
    dated = _with_dates(fact, dim_date)
    return _left(dated, dim_partner, F.col("partner_key") == F.col("_k"), columns)


# The partition column of stored facts.
YEAR = "date_year"


def with_date_year(fact: DataFrame) -> DataFrame:
    """Facts with the year of their date key, by which they are stored; null without a key."""
    return fact.withColumn(YEAR, F.floor(F.col("date_key") / 10000).cast("int"))


def star_trade_by_year(stored: DataFrame, dim_date: DataFrame, dim_partner: DataFrame) -> DataFrame:
    """``star_trade`` over facts stored by year.

    Dates are matched by year as well as by key, so a filter on any attribute of the date prunes the
    partitions of the facts while the query runs.  Without such a filter unmatched facts are kept.
    """
    parts = ["full_date", "quarter", "month_name", "day_name", "is_weekend"]
    columns = [F.col("date_key").alias("_k"), F.col("year").alias("_y"), *map(F.col, parts)]
    dated = _left(stored, dim_date, (F.col("date_key") == F.col("_k")) & (F.col(YEAR) == F.col("_y")), columns)
    partners = [F.col("partner_key").alias("_k"), F.col("partner_name"), F.col("region")]
    return _left(dated.drop("_y"), dim_partner, F.col("partner_key") == F.col("_k"), partners).drop(YEAR)

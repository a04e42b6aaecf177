"""Period labels, dates, integer date keys and calendar attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spanish month abbreviations as they stand in period labels.
MONTH_ABBREVIATIONS = (
    "Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic",
)
# Month and day names of the date dimension, without accents.
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
DAY_NAMES = ("Domingo", "Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado")
# Days covered by the date dimension.
FIRST_DAY = dt.date(2015, 1, 1)
LAST_DAY = dt.date(2026, 12, 31)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_year(c: str | Column) -> Column:
    """First run of four digits in a label, as int; null when there is none."""
    return F.regexp_extract(_col(c), r"(\d{4})", 1).try_cast("int")


def _matched_month(label: Column) -> Column:
    hits = [F.when(label.contains(a), F.lit(n)) for n, a in enumerate(MONTH_ABBREVIATIONS, 1)]
    return F.coalesce(*hits)


def period_month(c: str | Column) -> Column:
    """Month number of the first abbreviation (in calendar order) found in a label.

    Matching is case-sensitive; a label without a known abbreviation counts as month 1.
    """
    return F.coalesce(_matched_month(_col(c)), F.lit(1))


def month_is_known(c: str | Column) -> Column:
    """Whether ``period_month`` found an abbreviation instead of falling back to 1."""
    return F.coalesce(_matched_month(_col(c)).isNotNull(), F.lit(False))


def month_start(year: str | Column, month: str | Column) -> Column:
    """First day of a month; null for a null year or one that is not four digits long."""
    y = _col(year)
    return F.when(y.between(1000, 9999), F.make_date(y, _col(month), F.lit(1)))


def label_date(c: str | Column) -> Column:
    """Day of a label: ``02.May.20``, ``15.Jun.2020``, or the first of ``May.2020``.

    The day is a leading number of at most two digits, the year the first run of four digits or
    else a trailing one of two (of this century).  Null without a known month or a valid date.
    """
    label = F.trim(_col(c))
    short = F.concat(F.lit("20"), F.regexp_extract(label, r"\D(\d{2})$", 1)).try_cast("int")
    year = F.coalesce(period_year(label), F.when(short >= 2000, short))
    day = F.coalesce(F.regexp_extract(label, r"^(\d{1,2})\D", 1).try_cast("int"), F.lit(1))
    parts = [F.format_string("%04d", year), F.format_string("%02d", _matched_month(label)), F.format_string("%02d", day)]
    known = year.isNotNull() & _matched_month(label).isNotNull()
    return F.when(known, F.concat_ws("-", *parts).try_cast("date"))


def year_start(year: str | Column) -> Column:
    """January 1 of a year; null for a null year or one that no date can hold."""
    return F.concat(_col(year).cast("string"), F.lit("-01-01")).try_cast("date")


def date_key(c: str | Column) -> Column:
    """Integer ``yyyyMMdd`` of a date."""
    return F.date_format(_col(c), "yyyyMMdd").try_cast("int")


def year_key(c: str | Column) -> Column:
    """Integer ``yyyy0101`` of a year."""
    return F.concat(_col(c).cast("string"), F.lit("0101")).try_cast("int")


def month_name_es(c: str | Column) -> Column:
    return F.get(F.array(*map(F.lit, MONTH_NAMES)), F.month(_col(c)) - 1)


def day_name_es(c: str | Column) -> Column:
    return F.get(F.array(*map(F.lit, DAY_NAMES)), F.dayofweek(_col(c)) - 1)


def is_weekend(c: str | Column) -> Column:
    """Saturday or Sunday; false for a null date."""
    return F.coalesce(F.dayofweek(_col(c)).isin(1, 7), F.lit(False))


def calendar_parts(df: DataFrame, c: str) -> DataFrame:
    """Add year, quarter, month, ISO week and day of week (Sunday is 1)."""
    return df.withColumns(
        {
            "year": F.year(c),
            "quarter": F.quarter(c),
            "month": F.month(c),
            "week_of_year": F.weekofyear(c),
            "day_of_week": F.dayofweek(c),
        }
    )


def _days(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date")


def date_spine(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    """One row for each day from ``first`` to ``last``."""
    return spark.range(0, 1, 1, 1).select(_days(F.lit(first), F.lit(last)))


def date_spine_of(df: DataFrame, c: str | Column) -> DataFrame:
    """One row for each day between the smallest and the largest date of a column."""
    day = _col(c).cast("date")
    bounds = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return bounds.select(_days(F.col("lo"), F.col("hi")))

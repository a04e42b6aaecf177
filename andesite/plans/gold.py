"""Star schema: three dimensions and two facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from andesite.functions.calendar import (
    FIRST_DAY,
    LAST_DAY,
    calendar_parts,
    date_key,
    date_spine,
    day_name_es,
    is_weekend,
    month_name_es,
    year_key,
)
from andesite.functions.measures import yoy_abs, yoy_signed
from andesite.operators.project import with_processed_ts
from andesite.operators.window import with_prev
from andesite.registry import indicator_members, partner_members
from andesite.schemas import DIM_DATE, FACT_INDICATORS, FACT_TRADE, names


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of a frame of ``full_date``."""
    return calendar_parts(days, "full_date").withColumns(
        {
            "date_key": date_key("full_date"),
            "month_name": month_name_es("full_date"),
            "day_name": day_name_es("full_date"),
            "is_weekend": is_weekend("full_date"),
        }
    ).select(*names(DIM_DATE))


def dim_date(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    return describe_days(date_spine(spark, first, last))


def dim_indicator(spark: SparkSession) -> DataFrame:
    return indicator_members(spark)


def dim_trade_partner(spark: SparkSession) -> DataFrame:
    return partner_members(spark)


def fact_indicators(silver: DataFrame, run_ts: str | dt.datetime | None = None) -> DataFrame:
    """Indicator values with the value 12 rows earlier and the change against it.

    The silver table has one row per indicator, source and month, so the rows that a window
    task orders for one indicator are bounded by the calendar, however large the raw input.
    """
    keyed = silver.select(
        date_key("date").alias("date_key"),
        F.col("indicator_id").alias("indicator_key"),
        "source",
        "category",
        "value_numeric",
        "year",
        "month",
    )
    order = ["date_key", "source", "category", "value_numeric"]
    lagged = with_prev(keyed, "value_numeric", 12, ["indicator_key"], order)
    changed = lagged.withColumn("yoy_change", yoy_abs("value_numeric", "prev_year_value"))
    return with_processed_ts(changed, run_ts, "load_timestamp").select(*names(FACT_INDICATORS))


def fact_trade(silver: DataFrame, run_ts: str | dt.datetime | None = None) -> DataFrame:
    """Trade values with the previous available year's value and the change against it.

    The silver table has one row per partner, flow, product and year; a window task orders one
    row per year.
    """
    keyed = silver.withColumns(
        {"date_key": year_key("year"), "partner_key": F.col("partner_code")}
    )
    keys = ["partner_key", "flow_code", "cmd_code"]
    lagged = with_prev(keyed, "trade_value", 1, keys, ["year"])
    changed = lagged.withColumn("yoy_change_pct", yoy_signed("trade_value", "prev_year_value"))
    return with_processed_ts(changed, run_ts, "load_timestamp").select(*names(FACT_TRADE))

"""Document collections to typed, deduplicated tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from andesite import registry as R
from andesite.functions.calendar import month_start, period_month, period_year, year_start
from andesite.functions.measures import to_millions
from andesite.functions.text import clean_number
from andesite.operators.dedupe import dedupe
from andesite.operators.project import (
    cast_cols,
    conform_indicators,
    positive,
    require,
    resolve_columns,
    select_common,
    unify,
    with_processed_ts,
    with_source,
)
from andesite.schemas import (
    ANNUAL_CANDIDATES,
    INDICATORS,
    SERIES_CANDIDATES,
    SILVER_TRADE,
    names,
)
from andesite.sources.relations import empty_like

TRADE_KEYS = ("partner_code", "flow_code", "year", "cmd_code")


def _conformed(df: DataFrame, candidates: dict, source: str) -> DataFrame:
    return conform_indicators(df, resolve_columns(df, candidates), source)


def clean_series(df: DataFrame, order_by: Sequence[str] = ("period", "value")) -> DataFrame:
    """Period series to one numeric value per (indicator, month).

    Daily labels fall on the first of their month; ``order_by`` picks the value that stays.
    A collection without any column counts as empty.
    """
    if not df.columns:
        return empty_like(df.sparkSession, INDICATORS)
    read = _conformed(df, SERIES_CANDIDATES, R.SERIES_SOURCE).withColumns(
        {
            "value_numeric": clean_number("value"),
            "year": period_year("period"),
            "month": period_month("period"),
        }
    )
    dated = read.withColumn("date", month_start("year", "month"))
    usable = F.col("value_numeric").isNotNull() & F.col("date").isNotNull()
    return select_common(dedupe(dated, ["indicator_id", "date"], order_by, where=usable))


def clean_annual(
    df: DataFrame, order_by: Sequence[str] = ("period", "value_numeric")
) -> DataFrame:
    """Annual indicators to one numeric value per (indicator, January 1)."""
    if not df.columns:
        return empty_like(df.sparkSession, INDICATORS)
    read = _conformed(df, ANNUAL_CANDIDATES, R.ANNUAL_SOURCE).withColumns(
        {
            "value_numeric": F.col("value").try_cast("double"),
            "year": F.col("period").try_cast("int"),
            "month": F.lit(1),
        }
    )
    dated = read.withColumn("date", year_start("year"))
    usable = F.col("value_numeric").isNotNull() & F.col("year").isNotNull()
    return select_common(dedupe(dated, ["indicator_id", "date"], order_by, where=usable))


def unify_indicators(
    *cleaned: DataFrame, run_ts: str | dt.datetime | None = None
) -> DataFrame:
    """All indicator sources in one table, stamped."""
    return with_processed_ts(unify(*map(select_common, cleaned)), run_ts)


def clean_trade(
    df: DataFrame,
    order_by: Sequence[str] = ("trade_value", "net_weight"),
    run_ts: str | dt.datetime | None = None,
) -> DataFrame:
    """Trade documents to one positive value per (partner, flow, year, product)."""
    columns = names(SILVER_TRADE)
    source_columns = [
        c for c in columns if c not in ("source", "trade_value_millions", "processed_timestamp")
    ]
    typed = cast_cols(
        df.select(*source_columns),
        {"partner_code": "int", "year": "int", "trade_value": "double", "net_weight": "double"},
    )
    usable = positive(require(typed, "trade_value", "year"), "trade_value")
    single = with_source(dedupe(usable, TRADE_KEYS, order_by), R.TRADE_SOURCE)
    valued = single.withColumn("trade_value_millions", to_millions("trade_value"))
    return with_processed_ts(valued, run_ts).select(*columns)

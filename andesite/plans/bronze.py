"""Responses to document collections.

Every step takes a response frame (see ``sources.responses``).  Registries are joined before
the responses are flattened, so unregistered responses are never expanded.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from andesite import registry as R
from andesite.functions.semistructured import field_or
from andesite.functions.text import compose_id, flow_desc
from andesite.operators.joins import enrich_from_registry, lookup_or_code
from andesite.operators.project import (
    drop_placeholders,
    require,
    with_ingest_ts,
    with_partition_key,
    with_raw,
    with_source,
)
from andesite.schemas import BRONZE_ANNUAL, BRONZE_SERIES, BRONZE_TRADE, names
from andesite.sources.responses import (
    accepted,
    parse_data_rows,
    parse_meta_rows,
    parse_period_series,
)


def series_records(rows: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """Bronze series from flattened, enriched rows."""
    kept = drop_placeholders(rows, "value")
    named = kept.withColumnsRenamed({"id": "series_id", "name": "series_name"}).withColumn(
        "id", compose_id("series_id", "period")
    )
    tagged = with_partition_key(with_source(named, R.SERIES_SOURCE), "category")
    return with_ingest_ts(tagged, run_ts).select(*names(BRONZE_SERIES))


def bronze_series(raw: DataFrame, registry: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """Period-series responses to one document per series, period and value."""
    enriched = enrich_from_registry(raw, registry.select("id", "name", "category"))
    return series_records(accepted(parse_period_series(enriched)), run_ts)


def annual_records(
    rows: DataFrame,
    run_ts: str | dt.datetime,
    country_code: str = R.COUNTRY_CODE,
    country: str = R.REPORTER_NAME,
) -> DataFrame:
    """Bronze annual indicators from flattened, enriched rows."""
    read = rows.select(
        F.col("id").alias("indicator_id"),
        F.col("name").alias("indicator_name"),
        "category",
        F.coalesce("fields.country.value", F.lit(country)).alias("country"),
        F.lit(country_code).alias("country_code"),
        F.col("fields.date").alias("year"),
        "fields.value",
        F.coalesce("fields.unit", F.lit("")).alias("unit"),
        "item",
    )
    kept = require(read, "value").withColumn("id", compose_id("indicator_id", "year"))
    tagged = with_raw(with_source(kept, R.ANNUAL_SOURCE), "item")
    return with_ingest_ts(tagged, run_ts).select(*names(BRONZE_ANNUAL))


def bronze_annual(raw: DataFrame, registry: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """``[metadata, rows]`` responses to one document per indicator and year."""
    enriched = enrich_from_registry(raw, registry.select("id", "name", "category"))
    return annual_records(accepted(parse_meta_rows(enriched)), run_ts)


def trade_records(
    rows: DataFrame,
    partners: DataFrame,
    run_ts: str | dt.datetime,
    reporter_code: str = R.REPORTER_CODE,
    reporter: str = R.REPORTER_NAME,
    flows: tuple[tuple[str, str], ...] = R.FLOW_NAMES,
    null_text: str | None = None,
) -> DataFrame:
    """Bronze trade from flattened rows.

    A JSON null in a text field reads like an absent one, unless ``null_text`` is given.
    """

    def text(name: str, default: str) -> Column:
        if null_text is not None:
            return field_or("item", f"$.{name}", default, null_text)
        return F.coalesce(f"fields.{name}", F.lit(default))

    read = rows.select(
        F.lit(reporter_code).alias("reporter_code"),
        F.lit(reporter).alias("reporter"),
        text("partnerCode", "").alias("partner_code"),
        "flow_code",
        flow_desc("flow_code", flows).alias("flow_desc"),
        F.col("year").cast("string").alias("year"),
        text("cmdCode", "TOTAL").alias("cmd_code"),
        text("cmdDescE", "Total").alias("cmd_desc"),
        F.col("numbers.primaryValue").alias("trade_value"),
        F.col("numbers.netWgt").alias("net_weight"),
        "item",
    )
    named = lookup_or_code(read, partners, "partner_code", "partner").withColumn(
        "id", compose_id("reporter_code", "partner_code", "flow_code", "year", "cmd_code")
    )
    tagged = with_raw(with_source(named, R.TRADE_SOURCE), "item")
    keyed = with_partition_key(tagged, "year")
    return with_ingest_ts(keyed, run_ts).select(*names(BRONZE_TRADE))


def bronze_trade(
    raw: DataFrame, partners: DataFrame, run_ts: str | dt.datetime, **settings
) -> DataFrame:
    """``{data: [...]}`` responses to one document per partner, flow, year and product."""
    return trade_records(accepted(parse_data_rows(raw)), partners, run_ts, **settings)

"""The whole way from landed responses to the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from andesite import registry as R
from andesite.functions.calendar import label_date
from andesite.operators.joins import expected_grid, in_window, in_years, missing_cells
from andesite.operators.quality import check_star
from andesite.plans import bronze, gold, silver
from andesite.schemas import LAYER_TABLES
from andesite.sinks.catalog import ensure_layers
from andesite.sinks.tables import (
    SPARK_ERRORS,
    dual_write,
    overwrite_if_nonempty,
    snapshot_parquet,
    staged,
    upsert_by_key,
)
from andesite.sources.landing import UNREADABLE, Pickup, pick_up
from andesite.sources.responses import (
    envelopes,
    load_envelopes,
    parse_data_rows,
    parse_meta_rows,
    parse_period_series,
    read_isolated,
)

# Tables of the document collections are partitioned as the collections are.
BRONZE_PARTITIONS = {
    "bcrp_indicators": ("category",),
    "worldbank_indicators": ("category",),
    "comtrade_peru": ("year",),
}


@dataclass(frozen=True)
class FlowConfig:
    """Where the responses lie and where the results go.

    With ``ledger``, the folder of the files loaded so far, only files that landed or changed since
    are read; without it all files are.  ``jdbc`` maps a gold table to the options of its serving copy; ``snapshots`` and
    ``errors`` are base paths, left out when None.  Errors are counted in any case, and a copy of
    them that is asked for must succeed.
    """

    series_path: str
    annual_path: str
    trade_path: str
    run_ts: str
    run_date: dt.date
    prefix: str = ""
    fmt: str = "parquet"
    base: str | None = None
    snapshots: str | None = None
    errors: str | None = None
    staging: str | None = None
    ledger: str | None = None
    jdbc: Mapping[str, Mapping[str, str]] = field(default_factory=dict)


NO_KEY = "line without request key"
NOT_REQUESTED = "request key is not registered"
OUTSIDE = "outside the requested period"


def _ingest(
    spark: SparkSession,
    cfg: FlowConfig,
    table: str,
    lines: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    inside: Column,
    to_documents: Callable[[DataFrame], DataFrame],
    request: tuple[str, ...],
    keys: tuple[str, str],
) -> dict:
    """One source: parse once, upsert its documents, keep its errors and a dated copy.

    ``lines`` has ``_known``, whether a line's request key is registered.  Returns how many rows
    were accepted, lay outside the requested period, or were rejected, the latter by reason.
    """
    whole = F.col("payload").isNotNull()
    keyless = F.lit(False)
    for k in request:
        keyless = keyless | F.col(k).isNull()
    stray = F.when(whole & keyless, NO_KEY).when(whole & ~F.col("_known"), NOT_REQUESTED)
    judged = lines.withColumn("_stray", stray)
    strays = judged.filter("_stray IS NOT NULL").select(*request, F.col("_stray").alias("error"), "text")
    parsed = parse(judged.filter("_stray IS NULL").drop("_stray", "_known"))
    with staged(parsed, cfg.staging) as kept:
        rows, unread = read_isolated(kept, request)
        errors = unread.unionByName(strays)
        within = F.coalesce(inside, F.lit(True))
        documents = to_documents(rows.filter(within))
        order = ("ingestion_timestamp", "raw_response")
        upsert_by_key(spark, documents, f"{cfg.prefix}bronze.{table}", keys, order, cfg.staging)
        if cfg.snapshots:
            snapshot_parquet(documents, cfg.snapshots, table, cfg.run_date, required=False)
        if cfg.errors:
            snapshot_parquet(errors, cfg.errors, table, cfg.run_date)
        # One line per reason, and there are a dozen reasons.
        rejected = {r["error"]: r["count"] for r in errors.groupBy("error").count().collect()}
        accepted, outside = rows.agg(F.count_if(within), F.count_if(~within)).first()
    return {"accepted": accepted, OUTSIDE: outside, "rejected": rejected}


def _with_registry(raw: DataFrame, registry: DataFrame) -> DataFrame:
    """Lines with the attributes of their registered id, and whether there is one."""
    return raw.join(registry, "id", "left").withColumn("_known", F.col("name").isNotNull())


def _landed(
    spark: SparkSession, cfg: FlowConfig, source: str, path: str, request: tuple[str, ...],
    load: Callable[[DataFrame], dict],
) -> dict:
    """Load a source's responses: those of all files, or of the files that its ledger does not hold."""
    if cfg.ledger is None:
        return load(load_envelopes(spark, path, request))
    loaded = {"accepted": 0, OUTSIDE: 0, "rejected": {}}

    def store(found: Pickup) -> None:
        loaded.update(load(envelopes(found.rows, request)))
        unread = found.unreadable.count()
        if unread:
            loaded["rejected"][UNREADABLE] = unread

    files = pick_up(spark, path, f"{cfg.ledger}/{source}", store, cfg.run_ts)
    return {"files": files, **loaded}


def ingest_sources(spark: SparkSession, cfg: FlowConfig) -> tuple[dict[str, dict], dict[str, str]]:
    """Load the three sources: what became of their rows, and which failed; the others go on."""

    def series(raw: DataFrame) -> dict:
        lines = _with_registry(raw, R.series_registry(spark))
        # A label whose day cannot be read is left to the silver step, which reports it.
        return _ingest(
            spark, cfg, "bcrp_indicators", lines, parse_period_series,
            in_window(cfg.run_date, date=label_date("period")),
            lambda rows: bronze.series_records(rows, cfg.run_ts), ("id",), ("category", "id"),
        )

    def annual(raw: DataFrame) -> dict:
        lines = _with_registry(raw, R.annual_registry(spark))
        return _ingest(
            spark, cfg, "worldbank_indicators", lines, parse_meta_rows,
            in_years(R.ANNUAL_YEARS, F.col("fields.date")),
            lambda rows: bronze.annual_records(rows, cfg.run_ts), ("id",), ("category", "id"),
        )

    request = ("flow_code", "year")

    def trade(raw: DataFrame) -> dict:
        known = F.coalesce(F.col("flow_code").isin([code for code, _ in R.FLOW_NAMES]), F.lit(False))
        partners = R.partner_registry(spark)
        return _ingest(
            spark, cfg, "comtrade_peru", raw.withColumn("_known", known), parse_data_rows,
            in_years(R.TRADE_YEARS),
            lambda rows: bronze.trade_records(rows, partners, cfg.run_ts), request, ("year", "id"),
        )

    loaded, failures = {}, {}
    sources = (
        ("series", cfg.series_path, ("id",), series),
        ("annual", cfg.annual_path, ("id",), annual),
        ("trade", cfg.trade_path, request, trade),
    )
    for name, path, keys, load in sources:
        try:
            loaded[name] = _landed(spark, cfg, name, path, keys, load)
        except SPARK_ERRORS as e:
            failures[name] = str(e)
    return loaded, failures


def missing_requests(spark: SparkSession, cfg: FlowConfig) -> list[tuple[int, str]]:
    """Years and flows of trade that no document has; their number is that of the requests at most."""
    grid = expected_grid(spark, R.TRADE_YEARS, [code for code, _ in R.FLOW_NAMES])
    documents = spark.table(f"{cfg.prefix}bronze.comtrade_peru")
    cells = documents.select(F.col("year").try_cast("int").alias("year"), "flow_code")
    return sorted((r["year"], r["flow_code"]) for r in missing_cells(grid, cells).collect())


def refresh_silver(spark: SparkSession, cfg: FlowConfig) -> dict[str, bool]:
    """Rebuild the silver tables that have input; tells which ones were replaced."""
    at = f"{cfg.prefix}bronze."
    series = silver.clean_series(spark.table(at + "bcrp_indicators"))
    annual = silver.clean_annual(spark.table(at + "worldbank_indicators"))
    indicators = silver.unify_indicators(series, annual, run_ts=cfg.run_ts)
    trade = silver.clean_trade(spark.table(at + "comtrade_peru"), run_ts=cfg.run_ts)
    to = f"{cfg.prefix}silver."
    return {
        "economic_indicators": overwrite_if_nonempty(
            indicators, to + "economic_indicators", cfg.staging
        ),
        "trade_data": overwrite_if_nonempty(trade, to + "trade_data", cfg.staging),
    }


def refresh_gold(spark: SparkSession, cfg: FlowConfig) -> None:
    """Rebuild dimensions, then facts, each with its serving copy if one is configured."""
    at = f"{cfg.prefix}silver."
    frames = {
        "dim_date": gold.dim_date(spark),
        "dim_indicator": gold.dim_indicator(spark),
        "dim_trade_partner": gold.dim_trade_partner(spark),
        "fact_economic_indicators": gold.fact_indicators(
            spark.table(at + "economic_indicators"), cfg.run_ts
        ),
        "fact_trade_yearly": gold.fact_trade(spark.table(at + "trade_data"), cfg.run_ts),
    }
    for table, df in frames.items():
        dual_write(df, f"{cfg.prefix}gold.{table}", cfg.jdbc.get(table))


def broken_constraints(spark: SparkSession, cfg: FlowConfig) -> list[tuple[str, str, str, int]]:
    """Declared constraints that the stored gold tables break: table, check, column and number."""
    report = check_star({t: spark.table(f"{cfg.prefix}gold.{t}") for t in LAYER_TABLES["gold"]})
    lines = report.select("table_name", "check", "column_name", "n_rows").collect()
    return sorted(tuple(r) for r in lines)


def run_flow(spark: SparkSession, cfg: FlowConfig) -> dict:
    """Setup, bronze, silver and gold in order of dependency.

    Returns what became of the rows of each source, the sources that failed, the trade requests
    without documents, the silver tables that were refreshed and the constraints that gold breaks.
    """
    ensure_layers(spark, cfg.prefix, cfg.fmt, cfg.base, BRONZE_PARTITIONS)
    loaded, failures = ingest_sources(spark, cfg)
    refreshed = refresh_silver(spark, cfg)
    refresh_gold(spark, cfg)
    return {
        "sources": loaded,
        "failed_sources": failures,
        "missing_requests": missing_requests(spark, cfg),
        "refreshed": refreshed,
        "constraints": broken_constraints(spark, cfg),
    }

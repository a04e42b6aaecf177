"""Single operators: scans, filters, enrichment, dedupe, upsert, lag, summaries and checks."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from andesite.functions import text as text_functions
from andesite.functions.calendar import label_date
from andesite.functions.measures import json_num_or_zero, num_or_zero, yoy_abs, yoy_signed
from andesite.functions.semistructured import field_or
from andesite.functions.text import compose_id, flow_desc
from andesite.operators import joins, project, quality, summaries
from andesite.operators.dedupe import dedupe, upsert
from andesite.operators.window import with_prev
from andesite.plans.silver import TRADE_KEYS
from andesite.schemas import SERIES_CANDIDATES
from andesite.sources import responses
from andesite.sources.relations import literal_table, read_collection
from verification import inputs as I
from verification.case import case, table
from verification.layers import (
    INDICATOR_FACT,
    PRIORITIES,
    PRIORITIES_SQL,
    REGISTRY,
    TRADE_FACT,
    UNIFIED,
    indicator_fact_yoy,
    silver_series,
    silver_trade,
    trade_fact_yoy,
    unified,
)

# --- scans -------------------------------------------------------------------------------


def _periods(spark: SparkSession, d: str) -> DataFrame:
    return responses.parse_period_series(responses.responses_from(I.period_responses(spark, d)))


def _trade_rows(spark: SparkSession, d: str) -> DataFrame:
    raw = responses.responses_from(I.trade_responses(spark, d), keys=("flow_code", "year"))
    return responses.parse_data_rows(raw)


@case(I.PERIOD_ROWS)
def scan_period_series(spark: SparkSession, d: str) -> DataFrame:
    return responses.accepted(_periods(spark, d)).drop("raw_response")


@case(I.ANNUAL_ROWS)
def scan_meta_rows(spark: SparkSession, d: str) -> DataFrame:
    raw = responses.responses_from(I.annual_responses(spark, d))
    rows = responses.accepted(responses.parse_meta_rows(raw))
    return rows.select(
        "id",
        F.coalesce("fields.country.value", F.lit("Peru")).alias("country"),
        F.col("fields.date").alias("year"),
        F.col("fields.value").try_cast("double").alias("value"),
    )


@case(f"""
SELECT l_returnflag AS flow_code, CAST(year(l_shipdate) AS VARCHAR) AS year,
       CAST({I.PARTNER_SQL} AS INTEGER) AS partner_code,
       CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity END AS weight
FROM lineitem WHERE l_tax NOT IN (0.0, 0.08) AND l_linenumber <> 3
UNION ALL
SELECT l_returnflag, CAST(year(l_shipdate) AS VARCHAR), 999999, NULL
FROM lineitem WHERE l_tax <> 0.0 AND l_linenumber = 2
""")
def scan_data_rows(spark: SparkSession, d: str) -> DataFrame:
    raw = responses.responses_from(I.trade_responses(spark, d), keys=("flow_code", "year"))
    rows = responses.accepted(responses.parse_data_rows(raw))
    return rows.select(
        "flow_code",
        "year",
        F.col("fields.partnerCode").try_cast("int").alias("partner_code"),
        F.try_variant_get("fields.netWgt", "$", "double").alias("weight"),
    )


@case(f"SELECT id, count(*) AS records FROM ({I.PERIOD_ROWS}) GROUP BY id")
def isolated_rows(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = responses.read_isolated(_periods(spark, d))
    return summaries.records_per(rows, "id")


@case(f"""
SELECT l_returnflag AS flow_code, CAST(year(l_shipdate) AS VARCHAR) AS year,
       'primaryValue is not a number' AS error, count(*) AS records
FROM lineitem WHERE l_tax = 0.08 AND l_linenumber <> 3 GROUP BY ALL
UNION ALL
SELECT o_orderpriority, 'any', 'malformed json', count(*)
FROM orders WHERE {I.MALFORMED} GROUP BY ALL
""")
def isolated_errors(spark: SparkSession, d: str) -> DataFrame:
    keys = ("flow_code", "year")
    _, cells = responses.read_isolated(_trade_rows(spark, d), keys)
    _, series = responses.read_isolated(_periods(spark, d))
    named = series.select(F.col("id").alias("flow_code"), F.lit("any").alias("year"), "error", "text")
    return summaries.records_per(project.unify(cells, named), *keys, "error")


@case("SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts) FROM events")
def collection_scan(spark: SparkSession, d: str) -> DataFrame:
    """All columns; the time as text, whose type is the same on both sides."""
    events = read_collection(spark, f"{d}/events.parquet", "parquet")
    return events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@case("SELECT c_mktsegment, count(*) AS records FROM customer GROUP BY ALL")
def catalog_table_scan(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "customer").createOrReplaceTempView("customer_documents")
    return summaries.records_per(read_collection(spark, "customer_documents"), "c_mktsegment")


# --- request grid and extraction window --------------------------------------------------

GRID_YEARS, GRID_FLOWS = (1994, 2003), ("A", "N", "R", "X")
GRID_SQL = """
SELECT CAST(y AS INTEGER) AS year, f AS flow_code
FROM range(1994, 2004) AS years(y), (VALUES ('A'), ('N'), ('R'), ('X')) AS flows(f)
"""
CELLS_SQL = "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS flow_code FROM lineitem"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("flow_code")
    )


@case(f"""
SELECT g.year, g.flow_code, count(c.year) AS records
FROM ({GRID_SQL}) g LEFT JOIN ({CELLS_SQL}) c USING (year, flow_code) GROUP BY ALL
""")
def request_grid(spark: SparkSession, d: str) -> DataFrame:
    cells = summaries.records_per(_cells(spark, d), "year", "flow_code")
    grid = joins.expected_grid(spark, GRID_YEARS, GRID_FLOWS)
    return grid.join(cells, ["year", "flow_code"], "left").fillna(0, ["records"])


@case(f"SELECT * FROM ({GRID_SQL}) EXCEPT SELECT * FROM ({CELLS_SQL})")
def missing_request_cells(spark: SparkSession, d: str) -> DataFrame:
    return joins.missing_cells(
        joins.expected_grid(spark, GRID_YEARS, GRID_FLOWS), _cells(spark, d)
    )


@case("""
SELECT o_orderpriority AS id, o_orderkey, CASE WHEN o_orderpriority < '3' THEN CAST(o_orderdate AS DATE)
       ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS date FROM orders
WHERE CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
           THEN o_orderdate BETWEEN DATE '1996-02-10' AND DATE '1999-06-15'
           ELSE o_orderdate BETWEEN DATE '1996-02-01' AND DATE '1999-06-30' END
      AND o_orderpriority <> '4-NOT SPECIFIED'
""")
def extraction_window(spark: SparkSession, d: str) -> DataFrame:
    rows = [(i, "daily" if i < "3" else "monthly") for i, _, _ in PRIORITIES]
    registry = literal_table(spark, rows, "id string, freq string")
    month = I.label("o_orderdate")
    day = F.date_format("o_orderdate", "dd.")
    daily = F.col("o_orderpriority") < "3"
    # Daily labels have a day, some of them a year of four digits; monthly ones have neither.
    label = F.when(daily & (F.year("o_orderdate") < 2000), F.concat(day, month)).when(
        daily, F.concat(day, F.substring(month, 1, 4), F.date_format("o_orderdate", "yy"))
    ).otherwise(month)
    dated = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("id"), "o_orderkey", label_date(label).alias("date")
    )
    return joins.clip_to_window(dated, registry, dt.date(1999, 6, 15), dt.date(1996, 2, 10))


@case("""
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 1999
""")
def year_window(spark: SparkSession, d: str) -> DataFrame:
    years = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("year"))
    return joins.clip_years(years, (1996, 1999))


# --- projection, enrichment and filters --------------------------------------------------


@case("""
SELECT c_name AS indicator_id, c_mktsegment AS indicator_name, CAST(c_nationkey AS VARCHAR) AS category,
       CAST(c_custkey AS VARCHAR) AS period, c_acctbal AS value, 'BCRP' AS source
FROM customer
""")
def resolved_columns(spark: SparkSession, d: str) -> DataFrame:
    """All columns under their second-choice names."""
    df = table(spark, d, "customer").select(
        F.col("c_name").alias("id"),
        F.col("c_mktsegment").alias("name"),
        F.col("c_nationkey").cast("string").alias("_partition_key"),
        F.col("c_custkey").cast("string").alias("date"),
        F.col("c_acctbal").alias("amount"),
    )
    return project.conform_indicators(df, project.resolve_columns(df, SERIES_CANDIDATES), "BCRP")


@case("SELECT s_suppkey, s_name, 'UNComtrade' AS source FROM supplier")
def source_tag(spark: SparkSession, d: str) -> DataFrame:
    return project.with_source(table(spark, d, "supplier").select("s_suppkey", "s_name"), "UNComtrade")


@case(f"""
SELECT o_orderpriority AS id, o_orderkey, name, category
FROM orders JOIN {PRIORITIES_SQL} ON o_orderpriority = id
""")
def registry_enrichment(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_orderpriority").alias("id"), "o_orderkey")
    return joins.enrich_from_registry(orders, literal_table(spark, PRIORITIES, REGISTRY))


@case("""
SELECT c_custkey, code, coalesce(n_name, code) AS partner
FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'X' || CAST(c_nationkey AS VARCHAR)
                             WHEN c_custkey % 7 = 0 THEN CAST(c_nationkey + 100 AS VARCHAR)
                             ELSE CAST(c_nationkey AS VARCHAR) END AS code FROM customer)
     LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = code
""")
def code_lookup(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("c_nationkey").cast("string")
    customers = table(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("X"), text))
        .when(F.col("c_custkey") % 7 == 0, (F.col("c_nationkey") + 100).cast("string"))
        .otherwise(text)
        .alias("code"),
    )
    return joins.lookup_or_code(
        customers, table(spark, d, "nation"), "code", "partner", "n_nationkey", "n_name"
    )


@case("""
SELECT l_returnflag AS code,
       CASE l_returnflag WHEN 'A' THEN 'Importaciones' WHEN 'R' THEN 'Exportaciones' END AS flow_desc,
       count(*) AS records
FROM lineitem GROUP BY ALL
""")
def flow_descriptions(spark: SparkSession, d: str) -> DataFrame:
    code = F.when(F.col("l_returnflag") == "A", "M").when(F.col("l_returnflag") == "R", "X")
    lines = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("code"), flow_desc(code).alias("flow_desc")
    )
    return summaries.records_per(lines, "code", "flow_desc")


MARKS_SQL = """
SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'n.d.' WHEN o_totalprice < 100000 THEN NULL
  WHEN o_totalprice < 150000 THEN chr(9) || ' N.D. ' WHEN o_totalprice < 200000 THEN ' '
  WHEN o_totalprice < 250000 THEN '' WHEN o_totalprice < 300000 THEN 'n.d' ELSE o_orderpriority
  END AS value FROM orders
"""


@case(rf"""
SELECT * FROM ({MARKS_SQL})
WHERE value IS NOT NULL
  AND regexp_replace(value, '^\s+|\s+$', '', 'g') NOT IN ('', 'n.d.', 'N.D.')
""")
def placeholder_filter(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("o_totalprice")
    marks = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(price < 50000, F.lit("n.d."))
        .when(price < 100000, F.lit(None).cast("string"))
        .when(price < 150000, F.lit("\t N.D. "))
        .when(price < 200000, F.lit(" "))
        .when(price < 250000, F.lit(""))
        .when(price < 300000, F.lit("n.d"))
        .otherwise(F.col("o_orderpriority"))
        .alias("value"),
    )
    return project.drop_placeholders(marks, "value")


@case(f"""
SELECT date_key, indicator_key, value_numeric, prev_year_value, yoy_change
FROM ({INDICATOR_FACT}) WHERE prev_year_value IS NOT NULL AND yoy_change IS NOT NULL
""")
def required_values(spark: SparkSession, d: str) -> DataFrame:
    facts = indicator_fact_yoy(spark, d).drop("source", "category", "year", "month")
    return project.require(facts, "prev_year_value", "yoy_change")


@case("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def positive_values(spark: SparkSession, d: str) -> DataFrame:
    return project.positive(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@case("""
SELECT l_orderkey, l_linenumber,
       CAST(l_orderkey AS VARCHAR) || '_' || coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, '')
         || '_' || CAST(l_linenumber AS VARCHAR) AS id
FROM lineitem
""")
def composite_key(spark: SparkSession, d: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", compose_id("l_orderkey", flag, "l_linenumber").alias("id")
    )


@case("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(year(o_orderdate) AS VARCHAR) AS _partition_key FROM orders
""")
def partition_key(spark: SparkSession, d: str) -> DataFrame:
    years = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return project.with_partition_key(years, "year")


@case("SELECT event_id, replace(props, ' ', '') AS raw_response FROM events")
def raw_payload(spark: SparkSession, d: str) -> DataFrame:
    parsed = table(spark, d, "events").select("event_id", F.try_parse_json("props").alias("item"))
    return project.with_raw(parsed, "item").drop("item")


@case(f"SELECT event_id, '{I.RUN_TS}' AS ingestion_timestamp FROM events")
def ingest_stamp(spark: SparkSession, d: str) -> DataFrame:
    return project.with_ingest_ts(table(spark, d, "events").select("event_id"), I.RUN_TS)


@case("SELECT event_id, '2024-01-31 00:00:00' AS processed_timestamp FROM events")
def processing_stamp(spark: SparkSession, d: str) -> DataFrame:
    stamped = project.with_processed_ts(table(spark, d, "events").select("event_id"), I.RUN_TS)
    return stamped.withColumn("processed_timestamp", F.col("processed_timestamp").cast("string"))


def _dealt_out(texts: tuple, other: Column) -> Column:
    """One of some texts by event, and another value for the events left over."""
    which = F.col("event_id") % (len(texts) + 1)
    return F.get(F.array(*[F.lit(t).cast("string") for t in texts], other), which.cast("int"))


NUMBER_TEXTS = ("", None, "abc", "1d", "true", "NaN", " -Infinity ", "1_000.5", "-2.5e3", "0x10")


@case("""
SELECT event_id, list_extract([0.0, 0.0, NULL, NULL, NULL, 'nan'::DOUBLE, '-inf'::DOUBLE, 1000.5, -2500.0, NULL, value],
                              CAST(event_id % 11 + 1 AS INTEGER)) AS number
FROM events
""")
def number_or_zero(spark: SparkSession, d: str) -> DataFrame:
    text = _dealt_out(NUMBER_TEXTS, F.col("value").cast("string"))
    return table(spark, d, "events").select("event_id", num_or_zero(text).alias("number"))


JSON_NUMBERS = ("true", "false", "[]", "{}", "null", '"true"', '"7.5"', "[1]", '""', '"[]"')


@case("""
SELECT event_id, list_extract([1.0, 0.0, 0.0, 0.0, 0.0, NULL, 7.5, NULL, 0.0, NULL, value],
                              CAST(event_id % 11 + 1 AS INTEGER)) AS number
FROM events
""")
def json_number_or_zero(spark: SparkSession, d: str) -> DataFrame:
    text = _dealt_out(JSON_NUMBERS, F.col("value").cast("string"))
    events = table(spark, d, "events").select("event_id", F.try_parse_json(text).alias("v"))
    return events.select("event_id", json_num_or_zero("v").alias("number"))


@case(r"""
SELECT event_id, regexp_extract(props, '\d+') AS k, 'Total' AS absent,
       CASE WHEN event_type = 'error' THEN 'None' ELSE 'x' END AS explicit_null
FROM events
""")
def field_defaults(spark: SparkSession, d: str) -> DataFrame:
    extra = F.when(F.col("event_type") == "error", F.lit(',"u":null}')).otherwise(F.lit(',"u":"x"}'))
    props = F.concat(F.regexp_replace("props", r"\}$", ""), extra)
    events = table(spark, d, "events").select("event_id", F.try_parse_json(props).alias("v"))
    return events.select(
        "event_id",
        field_or("v", "$.k", "?").alias("k"),
        field_or("v", "$.missing", "Total").alias("absent"),
        field_or("v", "$.u", "?", null_text="None").alias("explicit_null"),
    )


@case("""
SELECT o_orderkey, CAST(NULL AS INTEGER) AS bad, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank,
       o_totalprice AS price
FROM orders
""")
def typed_columns(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 2).alias("bad"),
        F.substring("o_orderpriority", 1, 1).alias("rank"),
        I.money_text("o_totalprice").alias("price"),
    )
    return project.cast_cols(texts, {"bad": "int", "rank": "int", "price": "double"})


@case("SELECT event_id, value FROM events")
def value_as_text(spark: SparkSession, d: str) -> DataFrame:
    written = table(spark, d, "events").select("event_id", text_functions.value_as_text("value").alias("value"))
    return project.cast_cols(written, {"value": "double"})


@case("""
SELECT c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_name, s_acctbal FROM supplier
""")
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return project.unify(customers, suppliers)


@case(f"SELECT indicator_id, date, value_numeric FROM ({I.SERIES_CLEAN})")
def common_columns(spark: SparkSession, d: str) -> DataFrame:
    return project.select_common(silver_series(spark, d), ("indicator_id", "date", "value_numeric"))


# --- dedupe and upsert -------------------------------------------------------------------


@case(f"""
SELECT * FROM ({I.SERIES_DOCUMENTS})
QUALIFY row_number() OVER (
  PARTITION BY series_id, period ORDER BY value, series_name, category) = 1
""")
def deduped_series(spark: SparkSession, d: str) -> DataFrame:
    return dedupe(I.series_documents(spark, d), ["series_id", "period"], ["value"])


@case(f"""
SELECT * FROM ({I.ANNUAL_DOCUMENTS})
QUALIFY row_number() OVER (
  PARTITION BY indicator_id, year ORDER BY value DESC, category DESC) = 1
""")
def deduped_annual(spark: SparkSession, d: str) -> DataFrame:
    return dedupe(I.annual_documents(spark, d), ["indicator_id", "year"], ["value"], last=True)


TRADE_LINES_SQL = """
SELECT l_suppkey AS partner_code, l_returnflag AS flow_code,
       CAST(year(l_shipdate) AS INTEGER) AS year, l_linestatus AS cmd_code,
       l_extendedprice AS trade_value, l_quantity AS net_weight
FROM lineitem
"""


def _trade_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("partner_code"),
        F.col("l_returnflag").alias("flow_code"),
        F.year("l_shipdate").alias("year"),
        F.col("l_linestatus").alias("cmd_code"),
        F.col("l_extendedprice").alias("trade_value"),
        F.col("l_quantity").alias("net_weight"),
    )


@case(f"""
SELECT * FROM ({TRADE_LINES_SQL})
QUALIFY row_number() OVER (
  PARTITION BY partner_code, flow_code, year, cmd_code ORDER BY trade_value, net_weight) = 1
""")
def deduped_trade(spark: SparkSession, d: str) -> DataFrame:
    return dedupe(_trade_lines(spark, d), TRADE_KEYS, ["trade_value"])


@case("""
WITH old AS (SELECT event_type, user_id, event_id, value FROM events WHERE value < 50
             QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) = 1),
     new AS (SELECT event_type, user_id, event_id, value FROM events WHERE value >= 50
             QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) = 1)
SELECT * FROM new
UNION ALL
SELECT old.* FROM old ANTI JOIN new ON old.event_type = new.event_type AND old.user_id = new.user_id
""")
def keyed_upsert(spark: SparkSession, d: str) -> DataFrame:
    keys = ["event_type", "user_id"]
    events = table(spark, d, "events").select(*keys, "event_id", "value")
    existing = dedupe(events.filter("value < 50"), keys, ["event_id"])
    return upsert(existing, events.filter("value >= 50"), keys, ["event_id"])


# --- previous rows and change ------------------------------------------------------------


@case("""
SELECT o_orderpriority, o_orderkey, o_totalprice,
       lag(o_totalprice, 12) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS prev_year_value
FROM orders
""")
def lag_12_rows(spark: SparkSession, d: str) -> DataFrame:
    """Keys here are not bounded, so the order of each is taken chunk by chunk."""
    orders = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return with_prev(
        orders, "o_totalprice", 12, ["o_orderpriority"], ["o_orderkey"],
        chunks=[F.expr("o_orderkey div 1000"), F.expr("o_orderkey div 1000000")],
    )


@case(f"""
SELECT partner_code, flow_code, cmd_code, year, trade_value,
       lag(trade_value) OVER (PARTITION BY partner_code, flow_code, cmd_code ORDER BY year)
         AS prev_year_value
FROM ({I.TRADE_DOCUMENTS})
""")
def lag_1_row(spark: SparkSession, d: str) -> DataFrame:
    keys = ["partner_code", "flow_code", "cmd_code"]
    documents = I.trade_documents(spark, d).select(*keys, "year", "trade_value")
    return with_prev(documents, "trade_value", 1, keys, ["year"])


BASES_SQL = """
SELECT l_orderkey, l_linenumber, l_extendedprice AS value,
       CASE WHEN l_discount = 0.0 THEN NULL ELSE l_quantity - 25 END AS base FROM lineitem
"""


def _bases(spark: SparkSession, d: str) -> DataFrame:
    """Bases of either sign, zeros and nulls."""
    base = F.when(F.col("l_discount") != 0, F.col("l_quantity") - 25)
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("value"), base.alias("base")
    )


@case(f"""
SELECT *, CASE WHEN base <> 0 THEN (value - base) / abs(base) * 100 END AS change
FROM ({BASES_SQL})
""")
def yoy_absolute_base(spark: SparkSession, d: str) -> DataFrame:
    return _bases(spark, d).withColumn("change", yoy_abs("value", "base"))


@case(f"""
SELECT *, CASE WHEN base <> 0 THEN round((value - base) / base * 100, 2) END AS change
FROM ({BASES_SQL})
""")
def yoy_signed_base(spark: SparkSession, d: str) -> DataFrame:
    return _bases(spark, d).withColumn("change", yoy_signed("value", "base"))


# --- summaries ---------------------------------------------------------------------------


@case("SELECT count(*) AS records FROM lineitem")
def row_count(spark: SparkSession, d: str) -> DataFrame:
    return summaries.row_count(table(spark, d, "lineitem"))


@case("SELECT l_returnflag, l_linestatus, count(*) AS records FROM lineitem GROUP BY ALL")
def records_per_cell(spark: SparkSession, d: str) -> DataFrame:
    return summaries.records_per(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@case(f"""
SELECT category, series_name, count(*) AS records, max(period) AS latest_period
FROM ({I.SERIES_DOCUMENTS}) GROUP BY ALL ORDER BY category, series_name
""")
def series_summary(spark: SparkSession, d: str) -> DataFrame:
    return summaries.summarize(I.series_documents(spark, d), summaries.SERIES)


@case(f"""
SELECT flow_desc, partner, count(*) AS records,
       CAST(sum(CAST(trade_value AS DECIMAL(28,2))) AS DOUBLE) AS total_value,
       min(year) AS min_year, max(year) AS max_year
FROM ({I.TRADE_DOCUMENTS}) GROUP BY ALL ORDER BY flow_desc, partner
""")
def raw_trade_summary(spark: SparkSession, d: str) -> DataFrame:
    return summaries.summarize(I.trade_documents(spark, d), replace(summaries.RAW_TRADE, scale=2))


@case(f"""
SELECT source, category, count(*) AS records, min(date) AS min_date, max(date) AS max_date
FROM ({UNIFIED}) GROUP BY ALL ORDER BY source, category
""")
def indicator_summary(spark: SparkSession, d: str) -> DataFrame:
    return summaries.summarize(unified(spark, d), summaries.INDICATORS)


ODD_VALUES = """
CASE WHEN year <> 1996 OR partner_code > 3 THEN trade_value_millions WHEN partner_code = 0 THEN DOUBLE('NaN')
     WHEN partner_code = 1 THEN DOUBLE('Infinity') WHEN flow_code = 'A' THEN NULL ELSE trade_value_millions END
"""


@case(f"""
SELECT flow_desc, partner, count(*) AS records,
       CASE WHEN bool_and(isfinite(v)) THEN CAST(sum(CAST(CASE WHEN isfinite(v) THEN v END AS DECIMAL(28,2))) AS DOUBLE)
            ELSE sum(v) END AS total_mill_usd,
       min(year) AS min_year, max(year) AS max_year
FROM (SELECT *, {ODD_VALUES.replace("DOUBLE('NaN')", "'nan'::DOUBLE").replace("DOUBLE('Infinity')", "'inf'::DOUBLE")} AS v
      FROM ({I.TRADE_CLEAN}))
GROUP BY ALL ORDER BY flow_desc, partner
""")
def trade_summary(spark: SparkSession, d: str) -> DataFrame:
    """Some values are null, infinite or not a number."""
    odd = silver_trade(spark, d).withColumn("trade_value_millions", F.expr(ODD_VALUES))
    return summaries.summarize(odd, summaries.TRADE)


# --- constraint reports ------------------------------------------------------------------


LOST_PART = "l_partkey + CASE WHEN l_linenumber = 7 THEN 10000000 ELSE 0 END"


@case(f"""
SELECT l_partkey, count(*) AS n_rows FROM (SELECT {LOST_PART} AS l_partkey FROM lineitem)
     ANTI JOIN part ON l_partkey = p_partkey
GROUP BY ALL
""")
def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.expr(LOST_PART).alias("l_partkey"))
    return joins.fk_orphans(lines, table(spark, d, "part"), "l_partkey", "p_partkey")


@case("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def pk_violations(spark: SparkSession, d: str) -> DataFrame:
    return quality.pk_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@case(f"""
SELECT 'prev_year_value' AS column_name, count(*) FILTER (prev_year_value IS NULL) AS n_nulls
FROM ({TRADE_FACT})
UNION ALL
SELECT 'yoy_change_pct', count(*) FILTER (yoy_change_pct IS NULL) FROM ({TRADE_FACT})
""")
def null_violations(spark: SparkSession, d: str) -> DataFrame:
    columns = ["date_key", "partner_key", "prev_year_value", "yoy_change_pct"]
    return quality.null_violations(trade_fact_yoy(spark, d), columns)


SERVING = {"l_extendedprice": (6, 1), "l_quantity": (3, 0), "l_tax": (3, 2)}


@case("""
SELECT l_orderkey, l_linenumber, TRY_CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(6,1)) AS l_extendedprice,
       TRY_CAST(l_quantity AS DECIMAL(3,0)) AS l_quantity, TRY_CAST(l_tax AS DECIMAL(3,2)) AS l_tax
FROM lineitem
""")
def serving_decimals(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *SERVING)
    return quality.to_serving_types(lines, SERVING)


@case("""
SELECT 'l_extendedprice' AS column_name, count(*) AS n_overflows FROM lineitem
WHERE TRY_CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(6,1)) IS NULL
HAVING count(*) > 0
""")
def serving_overflows(spark: SparkSession, d: str) -> DataFrame:
    return quality.serving_overflows(table(spark, d, "lineitem"), SERVING)


@case("""
SELECT 'p_name' AS column_name, count(*) AS n_too_long FROM part WHERE length(p_name) > 10
HAVING count(*) > 0
UNION ALL
SELECT 'p_type', count(*) FROM part WHERE length(p_type) > 6 HAVING count(*) > 0
""")
def length_violations(spark: SparkSession, d: str) -> DataFrame:
    limits = {"p_name": 10, "p_type": 6, "p_brand": 50}
    return quality.length_violations(table(spark, d, "part"), limits)


WANTED = "o_custkey + CASE WHEN o_orderpriority = '5-LOW' THEN 10000000 ELSE 0 END"


@case(f"""
SELECT id, 'missing' AS status
FROM (SELECT DISTINCT {WANTED} AS id FROM orders) ANTI JOIN customer ON id = c_custkey
UNION ALL
SELECT c_custkey, 'unexpected'
FROM customer ANTI JOIN (SELECT {WANTED} AS id FROM orders) ON id = c_custkey
""")
def registry_completeness(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    wanted = table(spark, d, "orders").select(F.expr(WANTED).alias("id"))
    return quality.registry_check(known, wanted)


@case("""
SELECT 'nation' AS registry, count(*) AS found, CAST(24 AS BIGINT) AS expected FROM nation
UNION ALL SELECT 'customer', count(*), CAST(7 AS BIGINT) FROM customer
""")
def registry_counts(spark: SparkSession, d: str) -> DataFrame:
    sizes = {
        "nation": (table(spark, d, "nation"), 24),
        "region": (table(spark, d, "region"), 5),
        "customer": (table(spark, d, "customer"), 7),
    }
    return quality.registry_sizes(spark, sizes)


@case("""
SELECT count(*) AS records,
       count(*) FILTER (o_orderstatus = 'F') AS without_year,
       count(*) FILTER (o_orderstatus = 'O' AND month(o_orderdate) <> 5) AS unknown_month,
       count(*) FILTER (o_totalprice < 100000) AS unreadable_value
FROM orders
""")
def label_report(spark: SparkSession, d: str) -> DataFrame:
    """Two-digit years and lower-case months in some labels."""
    text = I.label("o_orderdate")
    status = F.col("o_orderstatus")
    period = F.when(status == "F", F.concat(F.substring(text, 1, 4), F.lit("20"))).when(
        (status == "O") & (F.month("o_orderdate") != 5), F.lower(text)
    ).otherwise(text)
    value = F.when(F.col("o_totalprice") < 100000, F.lit("s/d")).otherwise(I.money_text("o_totalprice"))
    labels = table(spark, d, "orders").select(period.alias("period"), value.alias("value"))
    return quality.period_label_report(labels)

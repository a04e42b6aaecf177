"""The composite steps: bronze documents, silver tables, gold facts and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from andesite import registry as R
from andesite.functions.calendar import date_spine_of
from andesite.operators.joins import star_indicators, star_trade
from andesite.operators.project import unify
from andesite.operators.quality import check_star
from andesite.plans.bronze import bronze_annual, bronze_series, bronze_trade
from andesite.plans.gold import (
    describe_days,
    dim_indicator,
    dim_trade_partner,
    fact_indicators,
    fact_trade,
)
from andesite.plans.silver import clean_annual, clean_series, clean_trade, unify_indicators
from andesite.schemas import INDICATORS
from andesite.sources.relations import empty_like, literal_table
from andesite.sources.responses import responses_from, spread
from verification import inputs as I
from verification.case import case, table

PRIORITIES = (
    ("1-URGENT", "Urgente", "alta"),
    ("2-HIGH", "Alta", "alta"),
    ("3-MEDIUM", "Media", "baja"),
    ("5-LOW", "Baja", "baja"),
)
PRIORITIES_SQL = "(VALUES " + ", ".join(map(repr, PRIORITIES)) + ") AS r(id, name, category)"
FLAGS = (("A-F", "AF", "a"), ("N-F", "NF", "n"), ("N-O", "NO", "n"), ("R-O", "RO", "r"))
FLAGS_SQL = "(VALUES " + ", ".join(map(repr, FLAGS)) + ") AS r(id, name, category)"
REGISTRY = "id string, name string, category string"


@case(f"""
SELECT d.id || '_' || period AS id, d.id AS series_id, name AS series_name, category, period, value,
       'BCRP' AS source, '{I.RUN_TS}' AS ingestion_timestamp, category AS _partition_key
FROM ({I.PERIOD_ROWS}) d JOIN {PRIORITIES_SQL} ON d.id = r.id
WHERE trim(value) NOT IN ('', 'n.d.', 'N.D.')
""")
def bronze_series_documents(spark: SparkSession, d: str) -> DataFrame:
    raw = responses_from(I.period_responses(spark, d))
    registry = literal_table(spark, PRIORITIES, REGISTRY)
    return bronze_series(raw, registry, I.RUN_TS).drop("raw_response")


@case(f"""
SELECT d.id || '_' || year AS id, d.id AS indicator_id, name AS indicator_name, category, country,
       'PE' AS country_code, year, value, 'u' AS unit, 'WorldBank' AS source,
       '{I.RUN_TS}' AS ingestion_timestamp
FROM ({I.ANNUAL_ROWS}) d JOIN {FLAGS_SQL} ON d.id = r.id
WHERE value IS NOT NULL
""")
def bronze_annual_documents(spark: SparkSession, d: str) -> DataFrame:
    raw = responses_from(I.annual_responses(spark, d))
    documents = bronze_annual(raw, literal_table(spark, FLAGS, REGISTRY), I.RUN_TS)
    return documents.drop("raw_response").withColumn("value", F.col("value").try_cast("double"))


@case(f"""
SELECT '604_' || partner_code || '_' || flow_code || '_' || year || '_' || cmd_code AS id,
       '604' AS reporter_code, 'Peru' AS reporter, partner_code,
       coalesce(s_name, partner_code) AS partner, flow_code,
       CASE flow_code WHEN 'A' THEN 'Aceptado' WHEN 'R' THEN 'Rechazado' END AS flow_desc, year,
       cmd_code, cmd_desc, trade_value, net_weight, 'UNComtrade' AS source,
       '{I.RUN_TS}' AS ingestion_timestamp, year AS _partition_key
FROM ({I.TRADE_ROWS})
     LEFT JOIN supplier ON s_suppkey = CAST(partner_code AS BIGINT)
""")
def bronze_trade_documents(spark: SparkSession, d: str) -> DataFrame:
    raw = responses_from(spread(I.trade_responses(spark, d)), keys=("flow_code", "year"))
    partners = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("int").alias("code"), F.col("s_name").alias("name")
    )
    flows = (("A", "Aceptado"), ("R", "Rechazado"))
    return bronze_trade(raw, partners, I.RUN_TS, flows=flows).drop("raw_response")


@case(I.SERIES_CLEAN)
def silver_series(spark: SparkSession, d: str) -> DataFrame:
    return clean_series(I.series_documents(spark, d))


@case(I.ANNUAL_CLEAN)
def silver_annual(spark: SparkSession, d: str) -> DataFrame:
    return clean_annual(I.annual_documents(spark, d))


UNIFIED = f"SELECT * FROM ({I.SERIES_CLEAN}) UNION ALL SELECT * FROM ({I.ANNUAL_CLEAN})"


def unified(spark: SparkSession, d: str) -> DataFrame:
    return unify_indicators(
        clean_series(I.series_documents(spark, d)),
        clean_annual(I.annual_documents(spark, d)),
        run_ts=I.RUN_TS,
    )


@case(UNIFIED)
def silver_unified(spark: SparkSession, d: str) -> DataFrame:
    return unified(spark, d).drop("processed_timestamp")


@case(I.SERIES_CLEAN)
def typed_empty_source(spark: SparkSession, d: str) -> DataFrame:
    """A source without data adds nothing to the union."""
    return unify(clean_series(I.series_documents(spark, d)), empty_like(spark, INDICATORS))


@case(I.TRADE_CLEAN)
def silver_trade(spark: SparkSession, d: str) -> DataFrame:
    return clean_trade(I.trade_documents(spark, d), run_ts=I.RUN_TS).drop("processed_timestamp")


INDICATOR_FACT = f"""
SELECT date_key, indicator_key, source, category, value_numeric, year, month, prev_year_value,
       CASE WHEN prev_year_value <> 0
            THEN (value_numeric - prev_year_value) / abs(prev_year_value) * 100 END AS yoy_change
FROM (
  SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, indicator_id AS indicator_key,
         source, category, value_numeric, year, month,
         lag(value_numeric, 12) OVER (PARTITION BY indicator_id ORDER BY date, source)
           AS prev_year_value
  FROM ({UNIFIED})
)
"""


@case(INDICATOR_FACT)
def indicator_fact_yoy(spark: SparkSession, d: str) -> DataFrame:
    return fact_indicators(unified(spark, d), I.RUN_TS).drop("load_timestamp")


@case(f"""
SELECT date_key, indicator_key, source, category, value_numeric, year, month, prev_year_value,
       yoy_change
FROM ({INDICATOR_FACT}) WHERE source = 'BCRP'
""")
def monthly_fact_yoy(spark: SparkSession, d: str) -> DataFrame:
    """Clean, dedupe, 12-row lag and change over the monthly series alone."""
    silver = unify_indicators(clean_series(I.series_documents(spark, d)), run_ts=I.RUN_TS)
    return fact_indicators(silver, I.RUN_TS).drop("load_timestamp")


TRADE_FACT = f"""
SELECT date_key, partner_key, flow_code, flow_desc, cmd_code, cmd_desc, trade_value,
       trade_value_millions, net_weight, year, prev_year_value,
       CASE WHEN prev_year_value <> 0
            THEN round((trade_value - prev_year_value) / prev_year_value * 100, 2)
       END AS yoy_change_pct
FROM (
  SELECT CAST(year || '0101' AS INTEGER) AS date_key, partner_code AS partner_key, *,
         lag(trade_value) OVER (PARTITION BY partner_code, flow_code, cmd_code ORDER BY year)
           AS prev_year_value
  FROM ({I.TRADE_CLEAN})
)
"""


def trade_fact(spark: SparkSession, d: str) -> DataFrame:
    return fact_trade(clean_trade(I.trade_documents(spark, d), run_ts=I.RUN_TS), I.RUN_TS)


@case(TRADE_FACT)
def trade_fact_yoy(spark: SparkSession, d: str) -> DataFrame:
    return trade_fact(spark, d).drop("load_timestamp")


def calendar_sql(days: str) -> str:
    months = "'Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre'," \
        "'Octubre','Noviembre','Diciembre'"
    names = "'Domingo','Lunes','Martes','Miercoles','Jueves','Viernes','Sabado'"
    return f"""
SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
       CAST(month(full_date) AS INTEGER) AS month,
       list_extract([{months}], CAST(month(full_date) AS INTEGER)) AS month_name,
       CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
       CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
       list_extract([{names}], CAST(dayofweek(full_date) + 1 AS INTEGER)) AS day_name,
       dayofweek(full_date) IN (0, 6) AS is_weekend
FROM ({days})
"""


SPINE = """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date
FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)
"""


def order_days(spark: SparkSession, d: str) -> DataFrame:
    return date_spine_of(table(spark, d, "orders"), "o_orderdate")


@case(SPINE)
def date_spine(spark: SparkSession, d: str) -> DataFrame:
    return order_days(spark, d)


@case(calendar_sql(SPINE))
def date_dimension(spark: SparkSession, d: str) -> DataFrame:
    return describe_days(order_days(spark, d))


def _values(rows: tuple) -> str:
    return "(VALUES " + ", ".join(map(repr, rows)) + ")"


# Orders are dealt out over the members of a dimension that is written in code.
MEMBERS = len(R.INDICATOR_MEMBERS)
MEMBER_LIST = ", ".join(f"'{m[0]}'" for m in R.INDICATOR_MEMBERS)


@case(f"""
SELECT indicator_key, indicator_name, category, source, unit, count(o_orderkey) AS n_orders,
       min(o_totalprice) AS lowest, max(o_totalprice) AS highest
FROM {_values(R.INDICATOR_MEMBERS)}
       AS m(indicator_key, indicator_name, category, source, unit)
     LEFT JOIN orders
       ON indicator_key = list_extract([{MEMBER_LIST}], CAST(o_orderkey % {MEMBERS} + 1 AS INTEGER))
GROUP BY ALL
""")
def indicator_dimension(spark: SparkSession, d: str) -> DataFrame:
    ids = F.array(*[F.lit(m[0]) for m in R.INDICATOR_MEMBERS])
    orders = table(spark, d, "orders").select(
        F.get(ids, (F.col("o_orderkey") % MEMBERS).cast("int")).alias("indicator_key"),
        "o_orderkey",
        "o_totalprice",
    )
    used = orders.groupBy("indicator_key").agg(
        F.count("o_orderkey").alias("n_orders"),
        F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"),
    )
    return dim_indicator(spark).join(used, "indicator_key", "left").fillna(0, ["n_orders"])


CODES = ", ".join(str(m[0]) for m in R.PARTNER_MEMBERS)


@case(f"""
SELECT partner_key, partner_name, region, count(c_custkey) AS n_customers,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM {_values(R.PARTNER_MEMBERS)} AS m(partner_key, partner_name, region)
     JOIN customer ON partner_key = list_extract([{CODES}], CAST(c_nationkey % 5 + 1 AS INTEGER))
GROUP BY ALL
""")
def partner_dimension(spark: SparkSession, d: str) -> DataFrame:
    codes = F.array(*[F.lit(m[0]) for m in R.PARTNER_MEMBERS])
    per_partner = (
        table(spark, d, "customer")
        .groupBy(F.get(codes, F.col("c_nationkey") % 5).alias("partner_key"))
        .agg(
            F.count("c_custkey").alias("n_customers"),
            F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
        )
    )
    return dim_trade_partner(spark).join(per_partner, "partner_key")


# Some facts get keys that no dimension has, so that the left joins of the star views show.
STAR_DATES = calendar_sql(SPINE)
LOST_DATE = "CASE WHEN year < 1997 THEN date_key + 90000000 ELSE date_key END AS date_key"
LOST_INDICATOR = "CASE WHEN indicator_key = 'Brand#3' THEN 'none' ELSE indicator_key END AS indicator_key"
LOST_PARTNER = "CASE WHEN partner_key % 5 = 2 THEN partner_key + 1000 ELSE partner_key END AS partner_key"


def _with_lost_keys(facts: DataFrame, *keys: str) -> DataFrame:
    rewritten = {k.split(" AS ")[1]: k.split(" AS ")[0] for k in keys}
    return facts.select(*[F.expr(rewritten.get(c, c)).alias(c) for c in facts.columns])


@case(f"""
SELECT f.*, full_date, quarter, month_name, day_name, is_weekend, indicator_name, unit
FROM (SELECT * REPLACE ({LOST_DATE}, {LOST_INDICATOR}) FROM ({INDICATOR_FACT})) f
     LEFT JOIN ({STAR_DATES}) dd ON f.date_key = dd.date_key
     LEFT JOIN (SELECT DISTINCT p_brand, 'Marca' AS indicator_name, 'US$' AS unit
                FROM part) di ON f.indicator_key = di.p_brand
""")
def star_of_indicators(spark: SparkSession, d: str) -> DataFrame:
    members = (
        table(spark, d, "part")
        .select(F.col("p_brand").alias("indicator_key"))
        .distinct()
        .select("indicator_key", F.lit("Marca").alias("indicator_name"), F.lit("US$").alias("unit"))
    )
    facts = _with_lost_keys(indicator_fact_yoy(spark, d), LOST_DATE, LOST_INDICATOR)
    return star_indicators(facts, describe_days(order_days(spark, d)), members)


def partner_table(spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return nations.select(
        F.col("n_nationkey").alias("partner_key"),
        F.col("n_name").alias("partner_name"),
        F.col("r_name").alias("region"),
    )


STAR_TRADE_FACT = f"SELECT * REPLACE ({LOST_DATE}, {LOST_PARTNER}) FROM ({TRADE_FACT})"


def star_trade_fact(spark: SparkSession, d: str) -> DataFrame:
    return _with_lost_keys(trade_fact_yoy(spark, d), LOST_DATE, LOST_PARTNER)


@case(f"""
SELECT f.*, full_date, quarter, month_name, day_name, is_weekend, partner_name, region
FROM ({STAR_TRADE_FACT}) f
     LEFT JOIN ({STAR_DATES}) dd ON f.date_key = dd.date_key
     LEFT JOIN (SELECT n_nationkey, n_name AS partner_name, r_name AS region
                FROM nation JOIN region ON n_regionkey = r_regionkey) dp ON f.partner_key = dp.n_nationkey
""")
def star_of_trade(spark: SparkSession, d: str) -> DataFrame:
    return star_trade(star_trade_fact(spark, d), describe_days(order_days(spark, d)), partner_table(spark, d))


@case(f"""
SELECT 'fact_trade_yearly' AS table_name, 'foreign key' AS "check", 'date_key' AS column_name,
       count(*) AS n_rows
FROM ({STAR_TRADE_FACT}) WHERE date_key NOT IN (SELECT date_key FROM ({STAR_DATES})) HAVING count(*) > 0
UNION ALL
SELECT 'fact_trade_yearly', 'foreign key', 'partner_key', count(*)
FROM ({STAR_TRADE_FACT}) WHERE partner_key NOT IN (SELECT n_nationkey FROM nation) HAVING count(*) > 0
UNION ALL
SELECT 'dim_trade_partner', 'not null', 'partner_name', count(*)
FROM nation WHERE n_nationkey < 5 HAVING count(*) > 0
""")
def star_constraints(spark: SparkSession, d: str) -> DataFrame:
    unnamed = F.when(F.col("partner_key") >= 5, F.col("partner_name"))
    return check_star(
        {
            "dim_date": describe_days(order_days(spark, d)),
            "dim_trade_partner": partner_table(spark, d).withColumn("partner_name", unnamed),
            "fact_trade_yearly": star_trade_fact(spark, d),
        }
    )

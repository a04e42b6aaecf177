"""The supplied tables in the role of documents and responses, and the same in SQL.

orders      monthly series: one document per order, the series being its priority
lineitem    annual indicators (per brand) and trade records (per nation, flag, year and brand)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from andesite.functions.calendar import MONTH_ABBREVIATIONS
from verification.case import table

RUN_TS = "2024-01-31T00:00:00"


def money_text(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def money_sum(c: str) -> Column:
    """Exact sum of amounts with two decimals, added up as whole cents.

    Decimal sums of this size leave the primitive types and take several times as long.
    """
    return F.sum(F.rint(F.col(c) * 100).cast("bigint")) / 100


def label(c: str) -> Column:
    """Spanish month label of a timestamp, such as ``Ene.2020``."""
    months = F.array(*map(F.lit, MONTH_ABBREVIATIONS))
    return F.concat(F.get(months, F.month(c) - 1), F.lit("."), F.year(c).cast("string"))


def label_sql(c: str) -> str:
    months = ", ".join(f"'{m}'" for m in MONTH_ABBREVIATIONS)
    return f"list_extract([{months}], CAST(month({c}) AS INTEGER)) || '.' || CAST(year({c}) AS VARCHAR)"


def series_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_id"),
        F.concat(F.lit("Prioridad "), "o_orderpriority").alias("series_name"),
        F.col("o_orderstatus").alias("category"),
        label("o_orderdate").alias("period"),
        money_text("o_totalprice").alias("value"),
    )


SERIES_DOCUMENTS = f"""
SELECT o_orderpriority AS series_id, 'Prioridad ' || o_orderpriority AS series_name,
       o_orderstatus AS category, {label_sql("o_orderdate")} AS period,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS value
FROM orders
"""

YEAR_OF_PERIOD = r"TRY_CAST(regexp_extract(period, '(\d{4})', 1) AS INTEGER)"
MONTH_OF_PERIOD = (
    "CASE "
    + " ".join(f"WHEN contains(period, '{m}') THEN {n}" for n, m in enumerate(MONTH_ABBREVIATIONS, 1))
    + " ELSE 1 END"
)

SERIES_CLEAN = f"""
SELECT indicator_id, indicator_name, category, source, date, year, month, value_numeric
FROM (
  SELECT *, make_date(year, month, 1) AS date
  FROM (
    SELECT series_id AS indicator_id, series_name AS indicator_name, category,
           'BCRP' AS source, period, value,
           TRY_CAST(regexp_replace(value, '[^0-9.-]', '', 'g') AS DOUBLE) AS value_numeric,
           {YEAR_OF_PERIOD} AS year, CAST({MONTH_OF_PERIOD} AS INTEGER) AS month
    FROM ({SERIES_DOCUMENTS})
  )
)
WHERE value_numeric IS NOT NULL AND date IS NOT NULL
QUALIFY row_number() OVER (
  PARTITION BY indicator_id, date ORDER BY period, value, indicator_name, category) = 1
"""


def annual_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(brands, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("indicator_id"),
        F.concat(F.lit("Marca "), "p_brand").alias("indicator_name"),
        F.col("p_type").alias("category"),
        F.year("l_shipdate").cast("string").alias("year"),
        money_text("l_extendedprice").alias("value"),
    )


ANNUAL_DOCUMENTS = """
SELECT p_brand AS indicator_id, 'Marca ' || p_brand AS indicator_name, p_type AS category,
       CAST(year(l_shipdate) AS VARCHAR) AS year,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS value
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

ANNUAL_CLEAN = f"""
SELECT indicator_id, indicator_name, category, 'WorldBank' AS source,
       make_date(CAST(year AS INTEGER), 1, 1) AS date, CAST(year AS INTEGER) AS year,
       CAST(1 AS INTEGER) AS month, CAST(value AS DOUBLE) AS value_numeric
FROM ({ANNUAL_DOCUMENTS})
QUALIFY row_number() OVER (
  PARTITION BY indicator_id, year ORDER BY CAST(value AS DOUBLE), category) = 1
"""


def trade_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trade record per nation, flag, year and brand.

    Nation names are joined to the aggregated records, not to the lines.
    """
    lines = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    records = (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("s_nationkey", "l_returnflag", F.year("l_shipdate").alias("year"), "p_brand")
        .agg(
            money_sum("l_extendedprice").alias("trade_value"),
            money_sum("l_quantity").alias("net_weight"),
        )
    )
    return records.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_nationkey").cast("string").alias("partner_code"),
        F.col("n_name").alias("partner"),
        F.col("l_returnflag").alias("flow_code"),
        F.concat(F.lit("Flujo "), "l_returnflag").alias("flow_desc"),
        F.col("year").cast("string").alias("year"),
        F.col("p_brand").alias("cmd_code"),
        F.concat(F.lit("Producto "), "p_brand").alias("cmd_desc"),
        "trade_value",
        "net_weight",
    )


TRADE_DOCUMENTS = """
SELECT CAST(s_nationkey AS VARCHAR) AS partner_code, n_name AS partner,
       l_returnflag AS flow_code, 'Flujo ' || l_returnflag AS flow_desc,
       CAST(year(l_shipdate) AS VARCHAR) AS year, p_brand AS cmd_code,
       'Producto ' || p_brand AS cmd_desc,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS trade_value,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS net_weight
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
     JOIN part ON l_partkey = p_partkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY ALL
"""

TRADE_CLEAN = f"""
SELECT CAST(partner_code AS INTEGER) AS partner_code, partner, flow_code, flow_desc,
       CAST(year AS INTEGER) AS year, cmd_code, cmd_desc, trade_value, net_weight,
       'UNComtrade' AS source, round(trade_value / 1000000, 2) AS trade_value_millions
FROM ({TRADE_DOCUMENTS})
WHERE trade_value > 0
"""


def period_responses(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """One period-series response per order, with three periods, one or none.

    The first period has an object value and a bare one, the second no value, the third two
    values and a null.  Small orders publish placeholders; cheap cancelled ones are cut off in
    mid-text, and those that cost more have text behind the document.
    """
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    value = (
        F.when(price < 50000, F.lit("n.d."))
        .when(price < 60000, F.lit(" "))
        .otherwise(money_text("o_totalprice"))
    )
    first = F.format_string(
        '{"name":"%s","values":[{"value":"%s"},"%s"]}', label("o_orderdate"), value, key.cast("string")
    )
    more = F.lit(',{"name":"Dic.1999","values":[]},{"name":"Ene.2000","values":[{"value":"7"},8,{"value":null}]}')
    periods = F.when(key % 3 == 0, F.concat(first, more)).when(key % 3 == 1, first).otherwise(F.lit(""))
    text = F.concat(F.lit('{"periods":['), periods, F.lit("]}"))
    tails = [F.when(key % 5 == n, F.lit(tail)) for n, tail in enumerate(("]", "],[", "]]", "}"))]
    tail = F.coalesce(*tails, F.lit(" more"))
    landed = (
        F.when((F.col("o_orderstatus") == "P") & (price < 100000), F.substring(text, 1, 10))
        .when((F.col("o_orderstatus") == "P") & (price < 150000), F.concat(text, tail))
        .otherwise(text)
    )
    return table(spark, sf_dir, "orders").filter(where).select(
        F.col("o_orderpriority").alias("id"), landed.alias("response")
    )


MALFORMED = "o_orderstatus = 'P' AND o_totalprice < 150000"
PERIOD_ROWS = f"""
SELECT o_orderpriority AS id, {label_sql("o_orderdate")} AS period,
       unnest([CASE WHEN o_totalprice < 50000 THEN 'n.d.' WHEN o_totalprice < 60000 THEN ' '
               ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END,
               CAST(o_orderkey AS VARCHAR)]) AS value
FROM orders WHERE NOT ({MALFORMED}) AND o_orderkey % 3 <> 2
UNION ALL
SELECT o_orderpriority, 'Ene.2000', unnest(['7', '8', NULL])
FROM orders WHERE NOT ({MALFORMED}) AND o_orderkey % 3 = 0
"""


def annual_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``[metadata, rows]`` response per line, with one row, two, none or null.

    Some rows have a null value.
    """
    number = F.when(F.col("l_discount") == 0, F.lit("null")).otherwise(money_text("l_extendedprice"))
    country = F.when(
        F.col("l_linestatus") == "F", F.format_string(',"country":{"value":"%s"}', "l_returnflag")
    ).otherwise(F.lit(""))
    row = F.format_string(
        '{"date":"%d","value":%s%s,"unit":"u"}', F.year("l_shipdate"), number, country
    )
    second = F.format_string(',{"date":"%d","value":5.5,"unit":"u"}', F.year("l_shipdate") + 1)
    line = F.col("l_linenumber")
    rows = F.when(line == 2, F.concat(row, second)).when(line == 3, F.lit("")).otherwise(row)
    tax = F.col("l_tax")
    text = (
        F.when(tax == 0.0, F.lit('[{"page":1}]'))
        .when(tax == 0.08, F.lit('[{"page":1},null]'))
        .otherwise(F.concat(F.lit('[{"page":1},['), rows, F.lit("]]")))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("id"), text.alias("response")
    )


ANNUAL_ROWS = """
SELECT l_returnflag || '-' || l_linestatus AS id,
       CASE WHEN l_linestatus = 'F' THEN l_returnflag ELSE 'Peru' END AS country,
       CAST(year(l_shipdate) AS VARCHAR) AS year,
       CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_extendedprice AS DOUBLE) END AS value
FROM lineitem WHERE l_tax NOT IN (0.0, 0.08) AND l_linenumber <> 3
UNION ALL
SELECT l_returnflag || '-' || l_linestatus, 'Peru', CAST(year(l_shipdate) + 1 AS VARCHAR), 5.5
FROM lineitem WHERE l_tax NOT IN (0.0, 0.08) AND l_linenumber = 2
"""


# Partner codes of some lines belong to no supplier.
PARTNER_SQL = "(l_suppkey + CASE WHEN l_linenumber = 7 THEN 1000000 ELSE 0 END)"


def trade_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``{data: [...]}`` response per line, with absent, null and unreadable fields.

    Some have a second row, some none, some no list.
    """
    line = F.col("l_linenumber")
    product = F.when(
        F.col("l_linestatus") == "F", F.format_string(',"cmdCode":"%d","cmdDescE":"L"', "l_linenumber")
    ).otherwise(F.lit(""))
    value = F.when(F.col("l_tax") == 0.08, F.lit('"abc"')).otherwise(money_text("l_extendedprice"))
    weight = F.when(F.col("l_discount") == 0, F.lit("null")).otherwise(money_text("l_quantity"))
    row = F.format_string(
        '{"partnerCode":%d%s,"primaryValue":%s,"netWgt":%s}', F.expr(PARTNER_SQL), product, value, weight
    )
    second = F.lit(',{"partnerCode":999999,"primaryValue":"12.5"}')
    rows = F.when(line == 2, F.concat(row, second)).when(line == 3, F.lit("")).otherwise(row)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flow_code"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.when(F.col("l_tax") == 0.0, F.lit('{"count":0}'))
        .otherwise(F.concat(F.lit('{"data":['), rows, F.lit("]}")))
        .alias("response"),
    )


TRADE_ROWS = f"""
SELECT l_returnflag AS flow_code, CAST(year(l_shipdate) AS VARCHAR) AS year,
       CAST({PARTNER_SQL} AS VARCHAR) AS partner_code,
       CASE WHEN l_linestatus = 'F' THEN CAST(l_linenumber AS VARCHAR) ELSE 'TOTAL' END AS cmd_code,
       CASE WHEN l_linestatus = 'F' THEN 'L' ELSE 'Total' END AS cmd_desc,
       CAST(l_extendedprice AS DOUBLE) AS trade_value,
       CASE WHEN l_discount = 0 THEN 0.0 ELSE CAST(l_quantity AS DOUBLE) END AS net_weight
FROM lineitem WHERE l_tax NOT IN (0.0, 0.08) AND l_linenumber <> 3
UNION ALL
SELECT l_returnflag, CAST(year(l_shipdate) AS VARCHAR), '999999', 'TOTAL', 'Total', 12.5, 0.0
FROM lineitem WHERE l_tax <> 0.0 AND l_linenumber = 2
"""

"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from andesite.functions import calendar, measures, text
from verification import inputs as I
from verification.case import case, table
from verification.layers import calendar_sql


def _labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", I.label("o_orderdate").alias("period"))


LABELS_SQL = f"SELECT o_orderkey, {I.label_sql('o_orderdate')} AS period FROM orders"


@case(r"""
SELECT l_orderkey, l_linenumber, l_suppkey,
       TRY_CAST(regexp_replace(raw, '[^0-9.-]', '', 'g') AS DOUBLE) AS number
FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN CAST(l_linenumber AS VARCHAR) || ',250.5%'
             WHEN 'R' THEN '-3,' || CAST(l_linenumber AS VARCHAR) || ' US$' ELSE l_linestatus END AS raw
      FROM lineitem)
""")
def number_cleaning(spark: SparkSession, d: str) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linenumber").cast("string")
    raw = (
        F.when(flag == "A", F.concat(line, F.lit(",250.5%")))
        .when(flag == "R", F.concat(F.lit("-3,"), line, F.lit(" US$")))
        .otherwise(F.col("l_linestatus"))
    )
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", text.clean_number(raw).alias("number")
    )


@case(f"SELECT o_orderkey, period, {I.YEAR_OF_PERIOD} AS year FROM ({LABELS_SQL})")
def period_years(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d).withColumn("year", calendar.period_year("period"))


@case(f"SELECT o_orderkey, period, CAST({I.MONTH_OF_PERIOD} AS INTEGER) AS month FROM ({LABELS_SQL})")
def period_months(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d).withColumn("month", calendar.period_month("period"))


@case("SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS date FROM orders")
def month_starts(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", calendar.month_start(F.year(day), F.month(day)).alias("date")
    )


@case("SELECT o_orderkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS date FROM orders")
def year_starts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", calendar.year_start(F.year("o_orderdate")).alias("date")
    )


@case("SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders")
def date_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", calendar.date_key("o_orderdate").alias("date_key")
    )


@case("""
SELECT o_orderkey, CAST(CAST(year(o_orderdate) AS VARCHAR) || '0101' AS INTEGER) AS date_key FROM orders
""")
def year_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", calendar.year_key(F.year("o_orderdate")).alias("date_key")
    )


ORDER_DAYS = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS full_date FROM orders"


def _days(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("full_date"))


def _day_attributes(*columns: str) -> str:
    picked = ", ".join(f"c.{c}" for c in columns)
    days = "SELECT DISTINCT full_date FROM (" + ORDER_DAYS + ")"
    return f"""
SELECT o.o_orderkey, o.full_date, {picked}
FROM ({ORDER_DAYS}) o JOIN ({calendar_sql(days)}) c ON o.full_date = c.full_date
"""


@case(_day_attributes("year", "quarter", "month", "week_of_year", "day_of_week"))
def calendar_parts(spark: SparkSession, d: str) -> DataFrame:
    return calendar.calendar_parts(_days(spark, d), "full_date")


@case(_day_attributes("month_name"))
def month_names(spark: SparkSession, d: str) -> DataFrame:
    return _days(spark, d).withColumn("month_name", calendar.month_name_es("full_date"))


@case(_day_attributes("day_name"))
def day_names(spark: SparkSession, d: str) -> DataFrame:
    return _days(spark, d).withColumn("day_name", calendar.day_name_es("full_date"))


@case(_day_attributes("is_weekend"))
def weekend_flags(spark: SparkSession, d: str) -> DataFrame:
    return _days(spark, d).withColumn("is_weekend", calendar.is_weekend("full_date"))


@case("SELECT o_orderkey, round(o_totalprice / 1000000, 2) AS millions FROM orders")
def millions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", measures.to_millions("o_totalprice").alias("millions")
    )


@case("""
SELECT c_custkey, c_acctbal, abs(c_acctbal) AS magnitude,
       CASE WHEN c_acctbal IS NOT NULL AND c_acctbal <> 0 THEN 100 / c_acctbal END AS guarded
FROM customer
""")
def guarded_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey",
        "c_acctbal",
        F.abs(balance).alias("magnitude"),
        measures.with_base(balance, 100 / balance).alias("guarded"),
    )


@case(r"""
SELECT c_custkey, c_name AS name
FROM customer
""")
def stripped_text(spark: SparkSession, d: str) -> DataFrame:
    padded = F.concat(F.lit(" \t\n"), "c_name", F.lit("\r\n  "))
    return table(spark, d, "customer").select("c_custkey", text.strip_ws(padded).alias("name"))

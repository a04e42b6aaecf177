"""Operators on stored files and tables: damaged files, pick-up of landed ones, schemaless documents, upserts by
file, snapshots, store assignment, drift, facts by year.

The queries land the supplied tables in a new folder of the session's shared folder and work on that.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from andesite.operators.joins import YEAR, star_trade_by_year, with_date_year
from andesite.operators.snapshots import read_snapshot, snapshot_changes
from andesite.plans.gold import describe_days
from andesite.sinks import assignment, catalog
from andesite.sinks.tables import snapshot_parquet, upsert_files
from andesite.sources import landing, responses
from andesite.sources.schemaless import typed_documents
from verification import inputs as I, layers as L
from verification.case import case, new_folder, table


@case(f"""
SELECT o_orderstatus AS status, count(*) AS records, count(DISTINCT o_custkey) AS customers,
       CAST(NULL AS VARCHAR) AS error
FROM orders GROUP BY ALL
UNION ALL SELECT 'damaged', 0, 0, '{landing.UNREADABLE}'
""")
def isolated_files(spark: SparkSession, d: str) -> DataFrame:
    """Good Parquet files by status, and among them one that is none."""
    folder = new_folder(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"))
    orders.write.partitionBy("status").parquet(folder)
    orders.select(F.col("status").alias("value")).write.text(f"{folder}/status=damaged")
    rows, errors = landing.read_isolated_files(spark, folder, "parquet", "o_orderkey bigint, o_custkey bigint, status string")
    good = rows.groupBy("status").agg(F.count("*").alias("records"), F.countDistinct("o_custkey").alias("customers"))
    status = F.regexp_extract("file_path", "status=([^/]*)/", 1).alias("status")
    bad = errors.select(status, F.lit(0).cast("bigint").alias("records"), F.lit(0).cast("bigint").alias("customers"), "error").distinct()
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)


FIRST, LATER, CHANGED = ("1-URGENT", "2-HIGH", "3-MEDIUM"), ("4-NOT SPECIFIED", "5-LOW"), "1-URGENT"
_HALF = I.PERIOD_ROWS.replace("FROM orders", "FROM (SELECT * FROM orders WHERE o_custkey % 2 = 0)")


@case(f"""
SELECT 1 AS run, id, count(*) AS values FROM ({I.PERIOD_ROWS}) WHERE id IN {FIRST} GROUP BY ALL
UNION ALL SELECT 2, id, count(*) FROM ({I.PERIOD_ROWS}) WHERE id IN {LATER} GROUP BY ALL
UNION ALL SELECT 2, id, count(*) FROM ({_HALF}) WHERE id = '{CHANGED}' GROUP BY ALL
""")
def landed_pickup(spark: SparkSession, d: str) -> DataFrame:
    """Three runs over a folder: what lands first, what lands or changes later, and nothing new."""
    folder = new_folder(spark)
    line = F.format_string('{"id":"%s","response":%s}', "id", "response").alias("line")
    lines = I.period_responses(spark, d).select("id", line)
    half = I.period_responses(spark, d, "o_custkey % 2 = 0").select("id", line)

    def land(rows: DataFrame, key: str) -> None:
        rows.filter(F.col("id") == key).select(F.col("line").alias("value")).write.mode("overwrite").text(
            f"{folder}/landed/{key[0]}")

    def run(n: int) -> int:
        def store(found: landing.Pickup) -> None:
            parsed = responses.parse_period_series(responses.envelopes(found.rows))
            counts = responses.accepted(parsed).groupBy("id").agg(F.count("*").alias("values"))
            counts.select(F.lit(n).alias("run"), "id", "values").write.mode("append").parquet(f"{folder}/loaded")

        return landing.pick_up(spark, f"{folder}/landed", f"{folder}/ledger", store, I.RUN_TS)

    for key in FIRST:
        land(lines, key)
    run(1)
    for key in LATER:
        land(lines, key)
    land(half, CHANGED)
    run(2)
    run(3)
    return spark.read.schema("run int, id string, values bigint").parquet(f"{folder}/loaded")


@case("""
SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS VARCHAR)
                                            WHEN 'O' THEN o_orderpriority ELSE 'true' END AS mixed,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS DOUBLE) ELSE o_custkey + 0.5 END AS number,
       CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS inner_text,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS BIGINT) END AS rare, CAST(NULL AS VARCHAR) AS nothing
FROM orders WHERE o_orderkey % 10 <> 9
""")
def schemaless_collection(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose fields clash, are rare, nested or always null; a tenth is no object or broken."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    mixed = F.when(status == "F", F.col("o_custkey").cast("string")).when(
        status == "O", F.concat(F.lit('"'), "o_orderpriority", F.lit('"'))).otherwise(F.lit("true"))
    number = F.concat(F.col("o_custkey").cast("string"), F.when(key % 2 == 0, F.lit("")).otherwise(F.lit(".5")))
    rare = F.when(status != "F", F.format_string(',"rare":%d', "o_custkey")).otherwise(F.lit(""))
    inner = F.when(status == "P", F.format_string(',"deep":{"text":"%s"}', "o_orderpriority")).otherwise(F.lit(""))
    text = F.concat(F.format_string('{"id":%d,"nothing":null,"mixed":%s,"number":%s', key, mixed, number), rare, inner, F.lit("}"))
    broken = F.when(key % 20 == 9, F.concat(F.lit("["), text, F.lit("]"))).otherwise(F.substring(text, 1, 12))
    documents, errors = typed_documents(
        table(spark, d, "orders").select(F.when(key % 10 == 9, broken).otherwise(text).alias("value")), conflicts="text")
    return documents.select(
        "id", "mixed", F.col("number").cast("double").alias("number"), F.col("deep.text").alias("inner_text"), "rare", "nothing")


@case("""
SELECT o_orderkey AS id, CASE WHEN o_custkey % 50 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
       CASE WHEN o_custkey % 50 = 7 THEN 'changed' ELSE o_orderstatus END AS status
FROM orders
UNION ALL SELECT -o_orderkey, o_totalprice, 'added' FROM orders WHERE o_custkey % 50 = 8
""")
def file_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Orders in files by key; a batch changes some and adds others, older and newer rows of a key among it."""
    folder = f"{new_folder(spark)}/orders"
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    orders = table(spark, d, "orders").select(
        key.alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), customer)
    orders.drop("o_custkey").repartitionByRange(8, "id").write.parquet(folder)
    newer = orders.filter(customer % 50 == 7).select("id", F.col("price") + 1, F.lit("changed"))
    older = orders.filter(customer % 50 == 7).select("id", F.col("price") - 1, F.lit("before"))
    added = orders.filter(customer % 50 == 8).select(-F.col("id"), "price", F.lit("added"))
    batch = newer.union(older).union(added).toDF("id", "price", "status")
    upsert_files(spark, batch, folder, ["id"], ["price"], staging=folder.rsplit("/", 1)[0])
    return spark.read.schema("id bigint, price double, status string").parquet(folder)


@case("""
WITH b AS (
  SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderkey % 11 <> 0
), a AS (
  SELECT o_orderkey AS id, CASE WHEN o_custkey % 50 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
         CASE WHEN o_custkey % 50 = 8 THEN NULL ELSE o_orderstatus END AS status
  FROM orders WHERE o_orderkey % 13 <> 0
)
SELECT coalesce(b.id, a.id) AS id, CASE WHEN b.id IS NULL THEN 'added' WHEN a.id IS NULL THEN 'gone' ELSE 'changed' END AS change,
       CAST(b.id IS NOT NULL AS BIGINT) AS n_gone, CAST(a.id IS NOT NULL AS BIGINT) AS n_added,
       CASE WHEN b.id IS NOT NULL AND a.id IS NOT NULL THEN
         concat_ws(',', CASE WHEN a.price IS DISTINCT FROM b.price THEN 'price' END,
                        CASE WHEN a.status IS DISTINCT FROM b.status THEN 'status' END) END AS columns
FROM b FULL JOIN a ON a.id = b.id
WHERE a.id IS NULL OR b.id IS NULL OR a.price IS DISTINCT FROM b.price OR a.status IS DISTINCT FROM b.status
""")
def snapshot_pair(spark: SparkSession, d: str) -> DataFrame:
    """Orders as they were on two days, each read as of a day without a snapshot of its own."""
    folder, customer = new_folder(spark), F.col("o_custkey")
    orders = table(spark, d, "orders")
    kept = [F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status")]
    price = F.when(customer % 50 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    status = F.when(customer % 50 != 8, F.col("o_orderstatus"))
    after = orders.withColumns({"o_totalprice": price, "o_orderstatus": status})
    snapshot_parquet(orders.filter("o_orderkey % 11 <> 0").select(kept), folder, "orders", dt.date(2024, 3, 10))
    snapshot_parquet(after.filter("o_orderkey % 13 <> 0").select(kept), folder, "orders", dt.date(2024, 4, 2))
    then, now = (read_snapshot(spark, folder, "orders", day) for day in (dt.date(2024, 4, 1), dt.date(2024, 5, 1)))
    changes = snapshot_changes(then, now, ["id"])
    return changes.withColumn("columns", F.when(F.col("columns").isNotNull(), F.array_join("columns", ",")))


@case("""
SELECT 'o_orderkey' AS column_name, 'bigint' AS from_type, 'smallint' AS to_type, 'value does not fit' AS problem,
       count(*) AS n_rows, CAST(min(o_orderkey) AS VARCHAR) AS example
FROM orders WHERE o_orderkey > 32767 HAVING count(*) > 0
UNION ALL SELECT 'o_totalprice', 'double', 'decimal(7,2)', 'value does not fit', count(*), CAST(min(o_totalprice) AS VARCHAR)
FROM orders WHERE o_totalprice >= 99999.995 HAVING count(*) > 0
UNION ALL SELECT 'o_orderpriority', 'string', 'varchar(8)', 'text too long', count(*), min(o_orderpriority)
FROM orders WHERE length(o_orderpriority) > 8 HAVING count(*) > 0
UNION ALL SELECT 'o_orderstatus', 'string', 'int', 'type not assignable', NULL, NULL
UNION ALL SELECT 'note', NULL, 'string', 'missing column', NULL, NULL
UNION ALL SELECT 'extra', 'bigint', NULL, 'unknown column', NULL, NULL
""")
def assignment_problems(spark: SparkSession, d: str) -> DataFrame:
    """Orders against a table that is too narrow for some of their values."""
    name = f"assignment_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (o_orderkey SMALLINT, o_custkey STRING, o_totalprice DECIMAL(7,2), "
              "o_orderpriority VARCHAR(8), o_orderstatus INT, o_orderdate DATE, note STRING) USING parquet")
    wanted = assignment.table_types(spark, name)
    spark.sql(f"DROP TABLE {name}")
    orders = table(spark, d, "orders").withColumn("extra", F.col("o_custkey"))
    return assignment.assignment_report(orders, wanted)


_DECLARED = "o_orderkey bigint, o_custkey int, o_totalprice double, note string, checked boolean"


@case("""
SELECT 'o_custkey' AS column_name, 'int' AS declared, 'bigint' AS stored, 'other type' AS drift, count(*) AS n_rows,
       count(o_custkey) AS n_values FROM orders
UNION ALL SELECT 'note', 'string', NULL, 'missing column', count(*), 0 FROM orders
UNION ALL SELECT 'checked', 'boolean', NULL, 'missing column', count(*), 0 FROM orders
UNION ALL SELECT 'o_orderstatus', NULL, 'string', 'undeclared column', count(*), count(o_orderstatus) FROM orders
""")
def layer_additions(spark: SparkSession, d: str) -> DataFrame:
    """A stored layer against its declaration; what it lacks is added, and then every column counted."""
    layer = f"drift_{uuid.uuid4().hex}"
    declared = {layer: {"orders": _DECLARED}}
    folder = f"{new_folder(spark)}/orders"
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    table(spark, d, "orders").select(columns).write.parquet(folder)
    catalog.ensure_schema(spark, layer)
    stored = ", ".join(f"{c} {t}" for c, t in table(spark, d, "orders").select(columns).dtypes)
    catalog.ensure_table(spark, f"{layer}.orders", stored, location=folder)
    found = catalog.layer_drift(spark, "", declared).drop("layer", "table_name")
    catalog.add_missing_columns(spark, "", declared)
    now = spark.table(f"{layer}.orders")
    counts = now.agg(F.count("*").alias("n_rows"), *[F.count(c).alias(c) for c in now.columns])
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_values")) for c in now.columns]))
    return found.join(counts.select("n_rows", values), F.col("column") == F.col("column_name")).drop("column")


@case(f"""
SELECT f.*, full_date, quarter, month_name, day_name, is_weekend, partner_name, region
FROM ({L.STAR_TRADE_FACT}) f JOIN ({L.STAR_DATES}) dd ON f.date_key = dd.date_key
     LEFT JOIN (SELECT n_nationkey, n_name AS partner_name, r_name AS region
                FROM nation JOIN region ON n_regionkey = r_regionkey) dp ON f.partner_key = dp.n_nationkey
WHERE full_date >= DATE '1997-06-01'
""")
def star_of_stored_years(spark: SparkSession, d: str) -> DataFrame:
    """Trade facts stored by year, with the dates from a day on; only the years of these dates are read."""
    folder = new_folder(spark)
    facts = with_date_year(L.star_trade_fact(spark, d))
    facts.hint("rebalance", YEAR).write.partitionBy(YEAR).parquet(f"{folder}/facts")
    describe_days(L.order_days(spark, d)).write.parquet(f"{folder}/dates")
    stored = spark.read.parquet(f"{folder}/facts")
    dates = spark.read.parquet(f"{folder}/dates")
    return star_trade_by_year(stored, dates, L.partner_table(spark, d)).filter("full_date >= DATE '1997-06-01'")

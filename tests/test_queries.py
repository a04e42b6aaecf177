"""Every registered query against DuckDB on the same tables, and its physical plan."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
import oracle
from verification.case import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not available")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def plan_of(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb_and_stays_in_the_jvm(spark, duck, capsys, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = plan_of(df, capsys)
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|NestedLoop|ExistingRDD", plan) or (
        name == "typed_empty_source" and "Python" not in plan)
    assert oracle.difference(df, duck, SQL[name]) is None


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "date_key", "indicator_key", "source", "category", "value_numeric", "year", "month",
        "prev_year_value", "yoy_change"]
    assert not df.isEmpty()


@pytest.mark.parametrize("name", ["monthly_fact_yoy", "trade_fact_yoy", "keyed_upsert", "lag_12_rows"])
def test_result_does_not_depend_on_partitioning(spark, rows, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = rows(QUERIES[name](spark, SF_DIR))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        assert rows(QUERIES[name](spark, SF_DIR)) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_keys_are_reduced_before_the_shuffle(spark, capsys):
    """A hot key reaches its reducer as one partial row per task."""
    for name in ("deduped_series", "silver_series", "deduped_trade"):
        lines = plan_of(QUERIES[name](spark, SF_DIR), capsys).splitlines()
        partial = next(i for i, line in enumerate(lines) if "partial_min" in line or "partial_max" in line)
        exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
        assert exchange < partial  # plans read bottom up


def test_costly_columns_are_computed_once(spark, capsys):
    plan = plan_of(QUERIES["silver_series"](spark, SF_DIR), capsys)
    assert plan.count("regexp_replace(") == 1 and plan.count("regexp_extract(") == 1
    assert plan.count("Contains(period") == 12
    plan = plan_of(QUERIES["bronze_trade_documents"](spark, SF_DIR), capsys)
    assert plan.count("StructField(partnerCode") == 1 and plan.count("parseJson(") == 1
    kinds = [line for line in plan.splitlines() if re.search("schema_?of_?variant", line, re.IGNORECASE)]
    assert len(kinds) == 1 and "Generate" in kinds[0]


def test_monthly_fact_shuffles_twice_and_prunes_columns(spark, capsys):
    plan = plan_of(QUERIES["monthly_fact_yoy"](spark, SF_DIR), capsys)
    assert plan.count("Exchange hashpartitioning") == 2
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert {c.split("#")[0] for c in scan.split(",")} == {
        "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"}


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, capsys):
    """Joins carry no hints: the side's size decides."""
    query = QUERIES["trade_fact_yoy"]
    assert plan_of(query(spark, SF_DIR), capsys).count("BroadcastHashJoin") == 3
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
        plan = plan_of(query(spark, SF_DIR), capsys)
        assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_constraints_read_the_facts_once_and_once_more_per_foreign_key(spark, capsys):
    """Each evaluation of the trade facts scans lineitem once."""
    plan = plan_of(QUERIES["star_constraints"](spark, SF_DIR), capsys)
    assert plan.count("l_extendedprice") and len(re.findall(r"FileScan parquet \[l_", plan)) <= 3


def test_upsert_reads_each_side_once(spark, capsys):
    plan = plan_of(QUERIES["keyed_upsert"](spark, SF_DIR), capsys)
    assert plan.count("FileScan") == 2


def test_filters_on_stored_columns_reach_the_scan(spark, capsys):
    plan = plan_of(QUERIES["positive_values"](spark, SF_DIR), capsys)
    assert re.search(r"PushedFilters: \[.*GreaterThan\(c_acctbal,0.0\)", plan)

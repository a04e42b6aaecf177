"""Dedupe, upsert, lag, lookups, grids, windows and reports on small frames."""

from __future__ import annotations

from dataclasses import replace

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from andesite import registry as R
from andesite.operators import joins, project, quality, summaries
from andesite.operators.dedupe import dedupe, latest, upsert
from andesite.operators.window import with_prev
from andesite.schemas import ANNUAL_CANDIDATES, DECIMALS, NOT_NULL, SERIES_CANDIDATES, TEXT_LENGTHS
from andesite.sources.relations import empty_like, literal_table, read_collection

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_dedupe_keeps_the_first_of_the_full_order(spark, rows):
    df = spark.createDataFrame(
        [("a", 2, "y"), ("a", 1, "z"), ("a", 1, "b"), (None, 5, "q"), (None, 4, "r"), ("c", None, "n"),
         ("c", 0, "m")], "k string, o int, v string")
    assert rows(dedupe(df, ["k"], ["o"])) == [("a", 1, "b"), ("c", None, "n"), (None, 4, "r")]
    assert rows(latest(df, ["k"], ["o"])) == [("a", 2, "y"), ("c", 0, "m"), (None, 5, "q")]
    assert rows(dedupe(df, ["k"], ["o"], where=F.col("o") > 1)) == [("a", 2, "y"), (None, 4, "r")]
    assert dedupe(df, ["k"], None).count() == 3
    assert rows(dedupe(df.select("k"), ["k"])) == [("a",), ("c",), (None,)]
    assert dedupe(df, ["k"], ["o"]).columns == df.columns


@FEW
@given(data=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 9)), min_size=1))
def test_dedupe_is_idempotent_and_ignores_input_order(spark, rows, data):
    schema = "k int, o int, v int"
    once = dedupe(spark.createDataFrame(data, schema), ["k"], ["o"])
    shuffled = random.Random(1).sample(data, len(data))
    again = dedupe(spark.createDataFrame(shuffled, schema).repartition(3), ["k"], ["o"])
    expected = sorted({k: min(r for r in data if r[0] == k) for k, _, _ in data}.values())
    assert rows(once) == rows(again) == rows(dedupe(once, ["k"], ["o"])) == sorted(expected, key=repr)


def test_upsert_replaces_extends_and_repeats_without_effect(spark, rows):
    schema = "c string, id string, ts int, v string"
    old = spark.createDataFrame([("a", "1", 9, "old"), ("b", "1", 9, "old"), (None, "2", 9, "old")], schema)
    new = spark.createDataFrame(
        [("a", "1", 1, "first"), ("a", "1", 2, "last"), ("a", "3", 1, "add"), (None, "2", 1, "new")], schema)
    once = upsert(old, new, ["c", "id"], ["ts"])
    expected = [("a", "1", 2, "last"), ("a", "3", 1, "add"), ("b", "1", 9, "old"), (None, "2", 1, "new")]
    assert rows(once) == sorted(expected, key=repr)
    assert rows(upsert(once, new, ["c", "id"], ["ts"])) == rows(once)
    assert rows(upsert(old.limit(0), new, ["c", "id"], ["ts"])) == rows(latest(new, ["c", "id"], ["ts"]))


def test_lag_counts_rows_not_years(spark, rows):
    gaps = spark.createDataFrame([(2018, 1.0), (2019, 2.0), (2021, 4.0)], "y int, v double")
    assert rows(with_prev(gaps.withColumn("k", F.lit("s")), "v", 1, ["k"], ["y"]), "y", "prev_year_value") == [
        (2018, None), (2019, 1.0), (2021, 2.0)]
    annual = spark.createDataFrame([("s", 2000 + i, float(i)) for i in range(15)], "k string, y int, v double")
    lagged = with_prev(annual, "v", 12, ["k"], ["y"]).filter("prev_year_value is not null")
    assert rows(lagged, "y", "prev_year_value") == [(2012, 0.0), (2013, 1.0), (2014, 2.0)]


@pytest.mark.parametrize("offset", [1, 3, 12])
def test_chunked_lag_equals_plain_lag_with_a_hot_key(spark, rows, offset):
    """One key holds most rows; chunks are uneven, some empty, some shorter than the offset."""
    pick = random.Random(offset)
    positions = sorted(pick.sample(range(5000), 300))
    data = [("hot" if pick.random() < 0.8 else f"k{p % 5}", p, float(p)) for p in positions]
    df = spark.createDataFrame(data, "k string, p long, v double").repartition(4)
    plain = with_prev(df, "v", offset, ["k"], ["p"])
    for chunks in (["p div 40"], ["p div 7", "p div 400"], ["p div 5", "p div 25", "p div 1000"]):
        chunked = with_prev(df, "v", offset, ["k"], ["p"], chunks=[F.expr(c) for c in chunks])
        assert chunked.columns == plain.columns
        assert rows(chunked) == rows(plain)


def test_resolve_columns_names_what_is_missing(spark):
    df = spark.createDataFrame([], "id string, name string, _partition_key string, date string, amount double")
    assert project.resolve_columns(df, SERIES_CANDIDATES) == {
        "indicator_id": "id", "indicator_name": "name", "category": "_partition_key", "period": "date",
        "value": "amount"}
    both = spark.createDataFrame([], "id string, indicator_id string, source string, category string, "
                                     "period string, year string, value string, amount string")
    assert project.resolve_columns(both, ANNUAL_CANDIDATES) == {
        "indicator_id": "indicator_id", "indicator_name": "source", "category": "category",
        "period": "year", "value": "value"}
    with pytest.raises(ValueError, match=r"\['period', 'value'\].*'id'"):
        project.resolve_columns(df.drop("date", "amount"), SERIES_CANDIDATES)


def test_code_lookup_falls_back_to_the_code(spark, rows):
    df = spark.createDataFrame([("156",), ("0156",), ("999",), ("W00",), ("",), ("-76",), ("99999999999",)], "c string")
    got = joins.lookup_or_code(df, R.partner_registry(spark), "c", "partner")
    assert rows(got) == sorted([
        ("156", "China"), ("0156", "China"), ("999", "999"), ("W00", "W00"), ("", ""), ("-76", "-76"),
        ("99999999999", "99999999999")], key=repr)


def test_registry_enrichment_drops_unregistered_ids(spark, rows):
    df = spark.createDataFrame([("PN01270PM", 1), ("other", 2)], "id string, n int")
    assert rows(joins.enrich_from_registry(df, R.series_registry(spark)), "id", "category", "freq") == [
        ("PN01270PM", "precios", "monthly")]


def test_expected_and_missing_cells(spark, rows):
    grid = joins.expected_grid(spark, R.TRADE_YEARS, [c for c, _ in R.FLOW_NAMES])
    assert grid.count() == 12
    seen = spark.createDataFrame([(y, f) for y in range(2018, 2024) for f in "MX" if (y, f) != (2020, "X")],
                                 "year int, flow_code string")
    assert rows(joins.missing_cells(grid, seen.union(seen))) == [(2020, "X")]


def test_extraction_window_depends_on_frequency(spark, rows):
    days = [dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2024, 3, 10), dt.date(2024, 3, 11),
            dt.date(2024, 3, 31), dt.date(2024, 4, 1)]
    ids = ["PN01270PM", "PD04638PD", "other"]
    df = spark.createDataFrame([(i, d) for i in ids for d in days], "id string, date date")
    kept = joins.clip_to_window(df, R.series_registry(spark), dt.date(2024, 3, 10))
    assert rows(kept) == sorted([("PD04638PD", d) for d in days[1:3]] + [("PN01270PM", d) for d in days[1:5]],
                                key=repr)


def test_year_window(spark, rows):
    df = spark.createDataFrame([("1999",), ("2000",), ("2025",), ("2026",), ("20x0",), (None,)], "year string")
    assert rows(joins.clip_years(df, R.ANNUAL_YEARS)) == [("2000",), ("2025",)]


def test_summaries(spark):
    series = spark.createDataFrame(
        [("c", "s", "Sep.2020"), ("c", "s", "Ene.2023"), ("b", "t", None)],
        "category string, series_name string, period string")
    assert [tuple(r) for r in summaries.summarize(series, summaries.SERIES).collect()] == [
        ("b", "t", 1, None), ("c", "s", 2, "Sep.2020")]
    trade = spark.createDataFrame(
        [("X", "p", "2019", 1.5, 0.1, 2019), ("X", "p", "2018", 2.25, 0.2, 2018), ("M", "p", "2020", 4.0, 0.3, 2020)],
        "flow_desc string, partner string, year string, trade_value double, trade_value_millions double, y int")
    raw = [("M", "p", 1, 4.0, "2020", "2020"), ("X", "p", 2, 3.75, "2018", "2019")]
    assert [tuple(r) for r in summaries.summarize(trade, summaries.RAW_TRADE).collect()] == raw
    assert [tuple(r) for r in summaries.summarize(trade, replace(summaries.RAW_TRADE, scale=2)).collect()] == raw
    typed = trade.drop("year").withColumnRenamed("y", "year")
    assert [tuple(r) for r in summaries.summarize(typed, summaries.TRADE).collect()] == [
        ("M", "p", 1, 0.3, 2020, 2020), ("X", "p", 2, 0.3, 2018, 2019)]
    assert summaries.row_count(trade).first()[0] == 3
    odd = trade.withColumn("trade_value_millions", F.expr("CASE year WHEN '2019' THEN DOUBLE('inf') WHEN '2020' THEN 1e30D ELSE 0.2D END"))
    assert [r[3] for r in summaries.summarize(odd, replace(summaries.TRADE, extremes={})).collect()] == [1e30, float("inf")]


def test_constraint_reports(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 10.0), (1, None, 1e9), (2, "toolong", None), (None, "b", float("nan"))],
        "k int, t string, v double")
    assert rows(quality.pk_violations(df, ["k"])) == [(1, 2)]
    assert rows(quality.null_violations(df, ["k", "t", "v"])) == [("k", 1), ("t", 1), ("v", 1)]
    assert rows(quality.null_violations(df.filter("k = 1"), ["k"])) == []
    assert rows(quality.length_violations(df, {"t": 5})) == [("t", 1)]
    assert rows(quality.serving_overflows(df, {"v": (6, 2)})) == [("v", 2)]
    cast = quality.to_serving_types(spark.createDataFrame([(1.005,), (-2.5,)], "v double"), {"v": (10, 2)})
    assert cast.schema["v"].dataType.simpleString() == "decimal(10,2)"
    assert sorted(float(r.v) for r in cast.collect()) == [-2.5, 1.01]


def test_star_report_names_every_broken_constraint(spark, rows):
    dim = spark.createDataFrame([(1, "p", None), (1, "p" * 101, "r"), (2, None, "r")],
                                "partner_key int, partner_name string, region string")
    days = spark.createDataFrame([(20200101,)], "date_key int")
    days = days.select("date_key", *[F.lit("x").alias(c) for c in NOT_NULL["dim_date"][1:]])
    fact = spark.createDataFrame(
        [(20200101, 1, "M", 1e17, 1.0), (20210101, 3, "TOOLONG", 1.0, None), (20210101, None, "X", 1.0, 1.0)],
        "date_key int, partner_key int, flow_code string, trade_value double, net_weight double")
    texts = [c for c in TEXT_LENGTHS["fact_trade_yearly"] if c not in fact.columns]
    numbers = [c for c in DECIMALS["fact_trade_yearly"] if c not in fact.columns]
    fact = fact.select("*", *[F.lit("t").alias(c) for c in texts], *[F.lit(1.0).alias(c) for c in numbers])
    star = {"dim_trade_partner": dim, "dim_date": days, "fact_trade_yearly": fact}
    assert rows(quality.check_star(star)) == sorted([
        ("dim_trade_partner", "primary key", "partner_key", 1),
        ("dim_trade_partner", "not null", "partner_name", 1),
        ("dim_trade_partner", "length", "partner_name", 1),
        ("fact_trade_yearly", "foreign key", "date_key", 2),
        ("fact_trade_yearly", "foreign key", "partner_key", 1),
        ("fact_trade_yearly", "not null", "partner_key", 1),
        ("fact_trade_yearly", "decimal", "trade_value", 1),
        ("fact_trade_yearly", "length", "flow_code", 1)], key=repr)


def test_orphans_are_counted_per_key(spark, rows):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (9,)], "k int")
    assert rows(joins.fk_orphans(fact, dim, "k")) == [(2, 2)]


def test_registry_reports(spark, rows):
    assert rows(quality.registry_check(
        R.series_registry(spark), literal_table(spark, [("PN01288PM",), ("PN01270PM",)], "id string"))) == sorted(
        [("PN01288PM", "missing")] + [(i, "unexpected") for i, *_ in R.SERIES if i != "PN01270PM"], key=repr)
    sizes = {"series": (R.series_registry(spark), 7), "annual": (R.annual_registry(spark), 10),
             "partners": (R.partner_registry(spark), 5), "flows": (R.flow_registry(spark), 3)}
    assert rows(quality.registry_sizes(spark, sizes), "registry", "found", "expected") == [("flows", 2, 3)]


def test_label_report(spark):
    df = spark.createDataFrame(
        [("Ene.2020", "1"), ("02.Ene.20", "1"), ("Set.2020", "s/d"), ("x", "1,0")], "period string, value string")
    assert tuple(quality.period_label_report(df).first()) == (4, 2, 2, 1)


def test_literal_and_empty_relations(spark):
    table = literal_table(spark, [(1, None), (2, "b")], "a int, b string")
    assert table.schema.simpleString() == "struct<a:int,b:string>"
    assert [tuple(r) for r in table.collect()] == [(1, None), (2, "b")]
    assert literal_table(spark, [], "a int").count() == 0
    empty = empty_like(spark, "a int, d date")
    assert empty.isEmpty() and empty.dtypes == [("a", "int"), ("d", "date")]


def test_union_keeps_duplicates_and_matches_names(spark, rows):
    a = spark.createDataFrame([("x", 1)], "n string, v int")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "v int, n string")
    assert rows(project.unify(a, b)) == [("x", 1), ("x", 1), ("y", 2)]


def test_collection_scan_infers_merges_and_is_nullable(spark, tmp_path):
    first = spark.range(2).select(F.col("id").alias("a"))
    first.write.parquet(f"{tmp_path}/c/part=1")
    first.select(F.col("a"), F.lit("x").alias("b")).write.parquet(f"{tmp_path}/c/part=2")
    df = read_collection(spark, f"{tmp_path}/c", "parquet")
    assert sorted(df.columns) == ["a", "b", "part"]
    assert all(f.nullable for f in df.schema)
    assert df.filter("b is null").count() == 2
    fixed = read_collection(spark, f"{tmp_path}/c", "parquet", schema="a bigint")
    assert fixed.columns[0] == "a"

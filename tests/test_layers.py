"""Bronze, silver and gold steps on hand-written documents."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from andesite import registry as R
from andesite.operators.joins import fk_orphans, star_indicators, star_trade
from andesite.plans import bronze, gold, silver
from andesite.schemas import (
    BRONZE_ANNUAL, BRONZE_SERIES, BRONZE_TRADE, DIM_DATE, FACT_INDICATORS, FACT_TRADE, SILVER_INDICATORS,
    SILVER_TRADE, names,
)
from andesite.sources.responses import responses_from

RUN = "2024-03-10T06:00:00"


def raw(spark, *pairs, keys=("id",)):
    ddl = ", ".join(f"{k} string" for k in (*keys, "response"))
    rows = [(*p[:-1], p[-1] if isinstance(p[-1], str) else json.dumps(p[-1])) for p in pairs]
    return responses_from(spark.createDataFrame(rows, ddl), keys=keys)


def test_bronze_series(spark, rows):
    response = {"periods": [
        {"name": "Ene.2020", "values": [{"value": "1.5"}]}, {"name": "Feb.2020", "values": [{"value": "n.d."}]},
        {"name": "Mar.2020", "values": [{"value": " "}]}, {"name": "Abr.2020", "values": [{"value": None}]},
        {"name": "May.2020", "values": [{"value": "s/d"}]}]}
    got = bronze.bronze_series(
        raw(spark, ("PN01270PM", response), ("unregistered", response), ("PN00015MM", "{oops")),
        R.series_registry(spark), RUN)
    assert got.columns == names(BRONZE_SERIES)
    assert rows(got.drop("raw_response")) == [
        ("PN01270PM_Ene.2020", "PN01270PM", "IPC Lima Metropolitana (var % mensual)", "precios", "Ene.2020",
         "1.5", "BCRP", RUN, "precios"),
        ("PN01270PM_May.2020", "PN01270PM", "IPC Lima Metropolitana (var % mensual)", "precios", "May.2020",
         "s/d", "BCRP", RUN, "precios")]


def test_bronze_annual(spark, rows):
    response = [{"page": 1}, [
        {"date": "2020", "value": 2.3e11, "unit": "", "country": {"value": "Peru"}},
        {"date": "2021", "value": 7}, {"date": "2022", "value": None}]]
    got = bronze.bronze_annual(
        raw(spark, ("SP.POP.TOTL", response), ("NY.GDP.MKTP.CD", [{"page": 1}]), ("FP.CPI.TOTL.ZG", [{}, None])),
        R.annual_registry(spark), RUN)
    assert got.columns == names(BRONZE_ANNUAL)
    assert rows(got, "id", "country", "country_code", "year", "unit", "category") == [
        ("SP.POP.TOTL_2020", "Peru", "PE", "2020", "", "demografia"),
        ("SP.POP.TOTL_2021", "Peru", "PE", "2021", "", "demografia")]
    assert rows(got.select(F.col("value").try_cast("double"))) == [(230000000000.0,), (7.0,)]


TRADE = {"data": [
    {"partnerCode": 156, "cmdCode": "27", "cmdDescE": "Fuels", "primaryValue": 1500000.5, "netWgt": None},
    {"partnerCode": 999, "primaryValue": 10},
    {"partnerCode": 76, "cmdCode": None, "primaryValue": None},
    {"partnerCode": 152, "cmdCode": "26", "primaryValue": "abc"},
    {"partnerCode": 156, "cmdCode": "27", "cmdDescE": "Fuels", "primaryValue": 2000000, "netWgt": 5},
]}


def bronze_trade_frame(spark, **settings):
    responses = raw(spark, ("M", "2020", TRADE), ("X", "2021", {"count": 0}), keys=("flow_code", "year"))
    return bronze.bronze_trade(responses, R.partner_registry(spark), RUN, **settings)


def test_bronze_and_silver_trade(spark, rows):
    got = bronze_trade_frame(spark)
    assert got.columns == names(BRONZE_TRADE)
    assert rows(got, "id", "partner", "flow_desc", "cmd_desc", "trade_value", "net_weight", "_partition_key") == sorted([
        ("604_156_M_2020_27", "China", "Importaciones", "Fuels", 1500000.5, 0.0, "2020"),
        ("604_156_M_2020_27", "China", "Importaciones", "Fuels", 2000000.0, 5.0, "2020"),
        ("604_999_M_2020_TOTAL", "999", "Importaciones", "Total", 10.0, 0.0, "2020"),
        ("604_76_M_2020_TOTAL", "Brasil", "Importaciones", "Total", 0.0, 0.0, "2020")], key=repr)
    strict = bronze_trade_frame(spark, null_text="None")
    assert rows(strict.filter("partner_code = '76'"), "cmd_code", "cmd_desc") == [("None", "Total")]
    clean = silver.clean_trade(got, run_ts=RUN)
    assert clean.columns == names(SILVER_TRADE)
    assert rows(clean, "partner_code", "year", "cmd_code", "trade_value", "trade_value_millions", "source") == [
        (156, 2020, "27", 1500000.5, 1.5, "UNComtrade"), (999, 2020, "TOTAL", 10.0, 0.0, "UNComtrade")]


SERIES_ROWS = [
    ("Ene.2020", "100.0"), ("Ene.2021", "1,250.5"), ("Xyz.2020", "7"), ("ago.2020", "4"), ("Abr.2020", "-3,2%"),
    ("02.May.20", "5"), ("15.Jun.2020", "8.5"), ("16.Jun.2020", "9.5"), ("Jul.2020", "2.5E3"), ("Ago.2020", "s/d"),
]


def test_clean_series(spark, rows):
    df = spark.createDataFrame(
        [("S1", "name", "c", p, v) for p, v in SERIES_ROWS],
        "series_id string, series_name string, category string, period string, value string")
    got = silver.clean_series(df.repartition(3))
    d = dt.date
    assert rows(got, "date", "value_numeric") == sorted([
        (d(2020, 1, 1), 100.0), (d(2020, 4, 1), -32.0), (d(2020, 6, 1), 8.5), (d(2020, 7, 1), 2.53),
        (d(2021, 1, 1), 1250.5)], key=repr)
    assert silver.clean_series(got.select("indicator_id").limit(0).select()).columns == got.columns
    with pytest.raises(ValueError):
        silver.clean_series(df.drop("value"))


def test_clean_annual(spark, rows):
    df = spark.createDataFrame(
        [("I", "n", "c", "2020", "2.3e11"), ("I", "n", "c", "20x0", "1"), ("I", "n", "c", "2021", ".."),
         ("I", "n", "c", "2020", "9e11"), ("J", "n", "c", "7", "1")],
        "indicator_id string, indicator_name string, category string, year string, value string")
    assert rows(silver.clean_annual(df), "indicator_id", "date", "year", "month", "value_numeric") == [
        ("I", dt.date(2020, 1, 1), 2020, 1, 230000000000.0), ("J", None, 7, 1, 1.0)]


def test_unified_indicators_keep_every_row_of_both_sources(spark):
    a = spark.createDataFrame([("x", "n", "c", "BCRP", dt.date(2020, 1, 1), 2020, 1, 1.0)],
                              ", ".join(SILVER_INDICATORS.split(", ")[:-1]))
    both = silver.unify_indicators(a, a, run_ts=RUN)
    assert both.count() == 2 and both.columns == names(SILVER_INDICATORS)
    assert both.select("processed_timestamp").distinct().count() == 1


def silver_indicators(spark, rows):
    ddl = "indicator_id string, source string, category string, date date, year int, month int, value_numeric double"
    return spark.createDataFrame(rows, ddl)


def test_fact_indicators(spark, rows):
    monthly = [("m", "BCRP", "c", dt.date(2020 + i // 12, i % 12 + 1, 1), 2020 + i // 12, i % 12 + 1, float(i - 2))
               for i in range(15)]
    fact = gold.fact_indicators(silver_indicators(spark, monthly).repartition(4), RUN)
    assert fact.columns == names(FACT_INDICATORS)
    assert rows(fact.filter("date_key >= 20210101"), "date_key", "prev_year_value", "yoy_change") == [
        (20210101, -2.0, 600.0), (20210201, -1.0, 1200.0), (20210301, 0.0, None)]
    assert fact.filter("prev_year_value is null").count() == 12


def test_fact_trade(spark, rows):
    ddl = ("partner_code int, flow_code string, flow_desc string, cmd_code string, cmd_desc string, year int, "
           "trade_value double, trade_value_millions double, net_weight double")
    data = [(1, "M", "i", "27", "f", y, v, v, 0.0) for y, v in [(2018, 3.0), (2019, 4.0), (2021, 2.0)]]
    fact = gold.fact_trade(spark.createDataFrame(data, ddl), RUN)
    assert fact.columns == names(FACT_TRADE)
    assert rows(fact, "date_key", "prev_year_value", "yoy_change_pct") == [
        (20180101, None, None), (20190101, 3.0, 33.33), (20210101, 4.0, -50.0)]


def test_dimensions(spark, rows):
    days = gold.dim_date(spark)
    assert days.columns == names(DIM_DATE) and days.count() == 4383
    assert rows(days.filter("full_date = '2021-01-03'")) == [
        (dt.date(2021, 1, 3), 20210103, 2021, 1, 1, "Enero", 53, 1, "Domingo", True)]
    assert gold.dim_indicator(spark).count() == 11
    assert rows(gold.dim_trade_partner(spark), "partner_key", "region")[0] == (152, "America del Sur")


def test_star_views_keep_facts_without_dimension_rows(spark, rows):
    data = [("PN01270PM", "BCRP", "precios", dt.date(2020, 1, 1), 2020, 1, 1.0),
            ("SI.POV.NAHC", "WorldBank", "social", dt.date(2004, 1, 1), 2004, 1, 2.0)]
    fact = gold.fact_indicators(silver_indicators(spark, data), RUN)
    star = star_indicators(fact, gold.dim_date(spark), gold.dim_indicator(spark))
    assert rows(star, "indicator_key", "indicator_name", "unit", "day_name") == [
        ("PN01270PM", "IPC Lima (var % mensual)", "%", "Miercoles"), ("SI.POV.NAHC", None, None, None)]
    trade = gold.fact_trade(spark.createDataFrame(
        [(156, "M", "i", "27", "f", 2020, 1.0, 1.0, 0.0), (999, "M", "i", "27", "f", 2020, 1.0, 1.0, 0.0)],
        "partner_code int, flow_code string, flow_desc string, cmd_code string, cmd_desc string, year int, "
        "trade_value double, trade_value_millions double, net_weight double"), RUN)
    partners = star_trade(trade, gold.dim_date(spark), gold.dim_trade_partner(spark))
    assert rows(partners, "partner_key", "partner_name", "region") == [(156, "China", "Asia"), (999, None, None)]


def test_registered_series_without_a_dimension_row(spark, rows):
    """The dimension lists one series that is never loaded and lacks seven that are."""
    ids = [(i,) for i, *_ in R.SERIES + R.ANNUAL]
    fact = spark.createDataFrame(ids, "indicator_key string")
    orphans = fk_orphans(fact, gold.dim_indicator(spark), "indicator_key")
    assert [r[0] for r in rows(orphans)] == sorted([
        "PN38705PM", "PN00271PM", "SI.POV.NAHC", "SE.ADT.LITR.ZS", "SH.XPD.CHEX.PC.CD", "BX.KLT.DINV.CD.WD",
        "NE.EXP.GNFS.ZS"])
    unused = fk_orphans(gold.dim_indicator(spark), fact, "indicator_key")
    assert [r[0] for r in rows(unused)] == ["PN01288PM"]

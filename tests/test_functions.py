"""Column functions against hand-written values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from andesite.functions import calendar as cal
from andesite.functions import measures, semistructured as js, text


def values(spark, ddl, rows, column):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], ddl)
    return [r[0] for r in df.coalesce(1).select(column).collect()]


def test_clean_number(spark):
    given = {
        "100.0": 100.0, "1,250.5": 1250.5, "-3,2%": -32.0, "2.5E3": 2.53, "1.234,5": 1.2345,
        "": None, "n.d.": None, "s/d": None, "1-2": None, "$ 7": 7.0,
    }
    assert values(spark, "v string", list(given), text.clean_number("v")) == list(given.values())
    assert values(spark, "v string", [None], text.clean_number("v")) == [None]


def test_placeholders_match_exactly_after_trimming(spark):
    given = {"": True, " ": True, "\t\n": True, "n.d.": True, " N.D. ": True, "n.d": False,
             "N.d.": False, "0": False, "..": False}
    assert values(spark, "v string", list(given), text.is_placeholder("v")) == list(given.values())
    assert values(spark, "v string", [None], text.is_placeholder("v")) == [True]


def test_composite_key_keeps_the_place_of_nulls(spark):
    got = values(spark, "a string, b int, c string", [("x", None, "z"), ("x", 1, None)],
                 text.compose_id("a", "b", "c"))
    assert got == ["x__z", "x_1_"]


def test_flow_descriptions(spark):
    assert values(spark, "v string", ["M", "X", "m", None], text.flow_desc("v")) == [
        "Importaciones", "Exportaciones", None, None]


def test_period_labels(spark):
    given = {
        "Ene.2020": (2020, 1), "Dic.1999": (1999, 12), "ago.2020": (2020, 1), "Xyz.2020": (2020, 1),
        "02.May.20": (None, 5), "15.Jun.2020": (2020, 6), "20201": (2020, 1), "Set.2021": (2021, 1),
        "Dic-Ene 2020": (2020, 1),
    }
    labels = list(given)
    assert values(spark, "v string", labels, cal.period_year("v")) == [y for y, _ in given.values()]
    assert values(spark, "v string", labels, cal.period_month("v")) == [m for _, m in given.values()]
    assert values(spark, "v string", [None], cal.period_month("v")) == [1]
    known = values(spark, "v string", ["Ene.2020", "ago.2020", None], cal.month_is_known("v"))
    assert known == [True, False, False]


def test_month_start_needs_a_four_digit_year(spark):
    got = values(spark, "y int, m int", [(2020, 2), (None, 2), (5, 1), (999, 1), (9999, 12)],
                 cal.month_start("y", "m"))
    assert got == [dt.date(2020, 2, 1), None, None, None, dt.date(9999, 12, 1)]


def test_year_start_and_keys(spark):
    assert values(spark, "y int", [2020, None, 7], cal.year_start("y")) == [
        dt.date(2020, 1, 1), None, None]
    assert values(spark, "y int", [2020, None, 999999], cal.year_key("y")) == [20200101, None, None]
    assert values(spark, "d date", [dt.date(2020, 3, 9), None], cal.date_key("d")) == [20200309, None]


def test_calendar_of_known_days(spark):
    days = [dt.date(2021, 1, 1), dt.date(2021, 1, 3), dt.date(2020, 2, 29)]
    df = spark.createDataFrame([(d,) for d in days], "full_date date").coalesce(1)
    named = cal.calendar_parts(df, "full_date").withColumns({
        "m": cal.month_name_es("full_date"), "n": cal.day_name_es("full_date"),
        "w": cal.is_weekend("full_date")})
    assert [tuple(r)[1:] for r in named.collect()] == [
        (2021, 1, 1, 53, 6, "Enero", "Viernes", False),
        (2021, 1, 1, 53, 1, "Enero", "Domingo", True),
        (2020, 1, 2, 9, 7, "Febrero", "Sabado", True),
    ]


def test_date_spine(spark):
    spine = cal.date_spine(spark)
    low, high, n = spine.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert (low, high, n) == (dt.date(2015, 1, 1), dt.date(2026, 12, 31), 4383)


@pytest.mark.parametrize("prev, value, absolute, signed", [
    (None, 5.0, None, None), (0.0, 1.0, None, None), (-2.0, 3.0, 250.0, -250.0),
    (3.0, 4.0, 100 / 3, 33.33), (4.0, None, None, None),
])
def test_yearly_change(spark, prev, value, absolute, signed):
    df = spark.createDataFrame([(value, prev)], "v double, p double")
    a, s = df.select(measures.yoy_abs("v", "p"), measures.yoy_signed("v", "p")).first()
    assert a == (None if absolute is None else pytest.approx(absolute))
    assert s == signed


def test_numbers_and_millions(spark):
    assert values(spark, "v string", ["", None, "12.5", " 7 ", "abc", "0"], measures.num_or_zero("v")) == [
        0.0, 0.0, 12.5, 7.0, None, 0.0]
    odd = ["1d", "true", "1f", "0x1", "1__0", ".", "1_0.5_0", "+.5e-1", "5.", "-inf", "Infinity", "1e400", "[]"]
    assert values(spark, "v string", odd, measures.num_or_zero("v")) == [
        None, None, None, None, None, None, 10.5, 0.05, 5.0, float("-inf"), float("inf"), float("inf"), None]
    assert values(spark, "v string", ["", None, "abc", "1"], measures.is_bad_number("v")) == [
        False, False, True, False]
    assert values(spark, "v double", [1500000.5, 4999.0, 5000.0, None], measures.to_millions("v")) == [
        1.5, 0.0, 0.01, None]


def test_absent_and_null_fields(spark):
    docs = ['{"a":"x"}', '{"a":null}', '{}', '{"a":3}', '{"a":{"b":1}}']
    df = spark.createDataFrame([(d,) for d in docs], "t string").coalesce(1).select(
        F.parse_json("t").alias("v"))

    def read(column):
        return [r[0] for r in df.select(column).collect()]

    assert read(js.field_or("v", "$.a", "?")) == ["x", "?", "?", "3", '{"b":1}']
    assert read(js.field_or("v", "$.a", "?", null_text="None")) == ["x", "None", "?", "3", '{"b":1}']
    assert read(measures.json_num_or_zero(F.try_variant_get("v", "$.a", "variant"))) == [None, 0.0, 0.0, 3.0, None]
    assert read(js.computed_once(js.field("v", "$.a"))) == read(js.field("v", "$.a"))
    assert read(js.holds_other("v", "$.a")) == [True, False, False, True, True]
    flags = '{"a":true,"b":false,"c":"","d":"12.5","e":[],"f":"true","g":"[]","h":[0]}'
    one = spark.createDataFrame([(flags,)], "t string").select(F.parse_json("t").alias("v"))
    values = [F.try_variant_get("v", f"$.{k}", "variant") for k in "abcdefgh"]
    got = one.select(*map(measures.json_num_or_zero, values)).first()
    assert tuple(got) == (1.0, 0.0, 0.0, 12.5, 0.0, None, None, None)

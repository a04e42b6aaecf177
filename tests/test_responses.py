"""Flattening of landed responses, good and bad."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from andesite.functions.semistructured import field
from andesite.sources import responses as res


# What may not follow a document.
TAILS = ("]", "],[", "]]", "}", "]garbage", "],[{}", " more", ",", ",0]", "]}")


def frame(spark, *pairs):
    return res.responses_from(spark.createDataFrame(list(pairs), "id string, response string"))


def test_period_series(spark, rows):
    parsed = res.parse_period_series(frame(
        spark,
        ("a", '{"periods":[{"name":"Ene.2020","values":[{"value":"1.5"},{"value":null},{"x":1}]},'
              '{"name":"Feb.2020","values":["3.1",4.25]},{"name":"Mar.2020"},{"name":"Abr.2020","values":[]}]}'),
        ("b", '{"series":"no periods"}'),
        ("c", '{"periods":[]}'),
        ("d", '{"periods":null}'),
        ("e", '{"periods":[{"name":"Ene.2020","val'),
        ("f", '{"periods":7}'),
        ("h", "[1]"),
        ("i", "null"),
        ("j", '{"periods":[]}{"periods":[]}'),
        ("k", '{"periods":[]},{"periods":[]}'),
        ("l", ' {"periods":[]} '),
        *[(f"t{i}", '{"periods":[]}' + tail) for i, tail in enumerate(TAILS)],
        ("g", '{"periods":[{"values":["1"]},{"name":"Feb.2020","values":["2"]},{"name":"x","values":3}]}'),
    ))
    good, bad = res.read_isolated(parsed)
    assert rows(good, "id", "period", "value") == sorted([
        ("a", "Ene.2020", "1.5"), ("a", "Ene.2020", None), ("a", "Ene.2020", None),
        ("a", "Feb.2020", "3.1"), ("a", "Feb.2020", "4.25"), ("g", "Feb.2020", "2")], key=repr)
    assert rows(bad, "id", "error") == sorted([
        ("e", "malformed json"), ("f", "periods is not a list"), ("g", "period without name"),
        ("g", "values is not a list"), ("h", "response is not an object"), ("i", "response is not an object"),
        ("j", "malformed json"), ("k", "malformed json"), *[(f"t{i}", "malformed json") for i in range(len(TAILS))],
    ], key=repr)
    texts = {r.id: r.text for r in bad.filter("id in ('e', 'f')").collect()}
    assert texts == {"e": '{"periods":[{"name":"Ene.2020","val', "f": '{"periods":7}'}
    raw = good.filter("period = 'Feb.2020' and id = 'a'").select("raw_response").first()[0]
    assert json.loads(raw) == {"name": "Feb.2020", "values": ["3.1", 4.25]}


def test_meta_rows(spark, rows):
    parsed = res.parse_meta_rows(frame(
        spark,
        ("a", '[{"page":1},[{"date":"2020","value":2.3e11},{"date":"2021","value":null}]]'),
        ("b", '[{"page":1}]'),
        ("c", '[{"page":1},null]'),
        ("d", '[{"page":1},[]]'),
        ("e", '{"message":"x"}'),
        ("f", '[{"page":1},{"date":"2020"}]'),
        ("g", '[{"page":1},[5,{"value":1},{"date":"2020","value":1}]]'),
        ("h", ""),
        *[(f"t{i}", "[{}]" + tail) for i, tail in enumerate(TAILS)],
    ))
    good, bad = res.read_isolated(parsed)
    read = good.select("id", field("item", "$.date").alias("d"), field("item", "$.value", "double").alias("v"))
    assert rows(read) == sorted([("a", "2020", 2.3e11), ("a", "2021", None), ("g", "2020", 1.0)], key=repr)
    assert rows(bad, "id", "error") == sorted([
        ("e", "response is not a list"), ("f", "second element is not a list"),
        ("g", "row is not an object"), ("g", "row without date"), ("h", "malformed json"),
        *[(f"t{i}", "malformed json") for i in range(len(TAILS))]], key=repr)


def test_data_rows(spark, rows):
    parsed = res.parse_data_rows(frame(
        spark,
        ("a", '{"data":[{"partnerCode":156,"primaryValue":1500000.5,"netWgt":null},{"partnerCode":999,'
              '"primaryValue":"10"},{"partnerCode":76,"primaryValue":""},{"partnerCode":152,"primaryValue":"abc"}]}'),
        ("b", '{"count":0}'),
        ("c", '{"data":{"partnerCode":1}}'),
        ("d", '{"data":[1,"x",null]}'),
        *[(f"t{i}", '{"data":[]}' + tail) for i, tail in enumerate(TAILS)],
    ))
    good, bad = res.read_isolated(parsed)
    codes = good.select("id", field("item", "$.partnerCode", "int").alias("p"))
    assert rows(codes) == [("a", 156), ("a", 76), ("a", 999)]
    assert rows(bad, "id", "error") == sorted([
        ("a", "primaryValue is not a number"), ("c", "data is not a list"),
        ("d", "row is not an object"), ("d", "row is not an object"), ("d", "row is not an object"),
        *[(f"t{i}", "malformed json") for i in range(len(TAILS))]], key=repr)
    lost = bad.filter("id = 'a'").select("text").first()[0]
    assert json.loads(lost) == {"partnerCode": 152, "primaryValue": "abc"}


def test_one_pass_rejects_each_response_once(spark):
    """A response with many elements is looked at once, not once for every element."""
    many = json.dumps({"periods": [{"name": f"Ene.{1000 + i}", "values": ["1"]} for i in range(3000)]})
    parsed = res.parse_period_series(frame(spark, ("a", many), ("b", "[")))
    assert res.accepted(parsed).count() == 3000
    assert res.rejected(parsed).count() == 1


def test_envelopes_and_response_files(spark, rows, tmp_path):
    lines = [
        {"id": "s1", "response": {"periods": [{"name": "Ene.2020", "values": [{"value": "1"}]}]}},
        {"id": "s2", "response": {"periods": []}},
    ]
    (tmp_path / "env").mkdir()
    (tmp_path / "env" / "a.json").write_text("\n".join(map(json.dumps, lines)) + '\n{"id":"s3","resp')
    assert rows(res.read_period_series(spark, f"{tmp_path}/env"), "id", "period", "value") == [
        ("s1", "Ene.2020", "1")]
    raw = res.load_envelopes(spark, f"{tmp_path}/env")
    assert rows(res.rejected(res.parse_period_series(raw)), "id", "error") == [(None, "malformed json")]

    home = tmp_path / "files" / "id=007"
    home.mkdir(parents=True)
    (home / "r.json").write_text(json.dumps(lines[0]["response"], indent=2))
    files = res.load_response_files(spark, f"{tmp_path}/files")
    assert rows(res.accepted(res.parse_period_series(files)), "id", "value") == [("007", "1")]

    trade = {"flow_code": "X", "year": 2020, "response": {"data": [{"partnerCode": 1}]}}
    (tmp_path / "trade.json").write_text(json.dumps(trade))
    got = res.read_data_rows(spark, f"{tmp_path}/trade.json")
    assert rows(got.select("flow_code", "year", F.to_json("item"))) == [("X", "2020", '{"partnerCode":1}')]

    annual = {"id": "i", "response": [{}, [{"date": "2020", "value": 1}]]}
    (tmp_path / "annual.json").write_text(json.dumps(annual))
    assert res.read_meta_rows(spark, f"{tmp_path}/annual.json").count() == 1

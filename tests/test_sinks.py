"""Tables, snapshots, upserts and the whole flow, in fresh directories."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter, functions as F

from andesite import registry as R
from andesite.plans.flow import (
    BRONZE_PARTITIONS, NO_KEY, NOT_REQUESTED, OUTSIDE, FlowConfig, ingest_sources, missing_requests, run_flow,
)
from andesite.schemas import LAYER_TABLES, names
from andesite.sinks import catalog, tables

RUN_DATE = dt.date(2024, 3, 10)


@pytest.fixture
def layer(spark):
    name = f"layer_{uuid.uuid4().hex[:8]}"
    catalog.ensure_schema(spark, name, comment="it's a layer")
    yield name
    assert catalog.drop_layer(spark, name) == []


def test_snapshot_is_dated_and_overwritten(spark, tmp_path):
    df = spark.range(3)
    path = tables.snapshot_parquet(df, str(tmp_path), "src", RUN_DATE)
    assert path == f"{tmp_path}/src/2024/03/10"
    tables.snapshot_parquet(df.limit(2), str(tmp_path), "src", RUN_DATE)
    assert spark.read.parquet(path).count() == 2


def test_optional_snapshot_may_fail(spark, tmp_path):
    (tmp_path / "src").write_text("a file where a directory should be")
    assert tables.snapshot_parquet(spark.range(1), str(tmp_path), "src", RUN_DATE, required=False) is None
    with pytest.raises(tables.SPARK_ERRORS):
        tables.snapshot_parquet(spark.range(1), str(tmp_path), "src", RUN_DATE)


def test_overwrite_matches_columns_by_name(spark, rows, layer, tmp_path):
    t = f"{layer}.t"
    catalog.ensure_table(spark, t, "a int, b string", location=f"{tmp_path}/t", comment="c")
    catalog.ensure_table(spark, t, "a int, b string")
    tables.overwrite_table(spark.createDataFrame([("x", 1)], "b string, a long"), t)
    tables.overwrite_table(spark.createDataFrame([("y", 2)], "b string, a long"), t)
    assert rows(spark.table(t)) == [(2, "y")]
    assert [p.name for p in (tmp_path / "t").glob("*.parquet")]
    with pytest.raises(PySparkException):
        tables.overwrite_table(spark.createDataFrame([("y",)], "b string"), t)


def test_empty_frame_leaves_the_table_alone(spark, rows, layer, tmp_path):
    t = f"{layer}.t"
    catalog.ensure_table(spark, t, "a int")
    df = spark.createDataFrame([(1,)], "a int")
    assert tables.overwrite_if_nonempty(df, t, str(tmp_path))
    assert not tables.overwrite_if_nonempty(df.filter("a > 5"), t, str(tmp_path))
    assert list(tmp_path.iterdir()) == []
    assert rows(spark.table(t)) == [(1,)]


DOCUMENTS = "category string, id string, ingestion_timestamp string, v int"


@pytest.mark.parametrize("partition_by", [(), ("category",)])
def test_upsert_by_key(spark, rows, layer, tmp_path, partition_by):
    t = f"{layer}.docs"
    catalog.ensure_table(spark, t, DOCUMENTS, partition_by=partition_by)
    first = spark.createDataFrame(
        [("a", "1", "t1", 1), ("a", "2", "t1", 1), ("b", "1", "t1", 1), (None, "9", "t1", 1)], DOCUMENTS)
    second = spark.createDataFrame([("a", "1", "t2", 2), ("a", "1", "t3", 3), ("a", "3", "t2", 2),
                                    (None, "9", "t2", 2)], DOCUMENTS)
    for _ in range(2):
        tables.upsert_by_key(spark, first, t, staging=str(tmp_path))
    untouched = {r[0] for r in spark.table(t).filter("category = 'b'").select(F.input_file_name()).collect()}
    for _ in range(2):
        tables.upsert_by_key(spark, second, t, staging=str(tmp_path))
    assert rows(spark.table(t), *names(DOCUMENTS)) == sorted(
        [("a", "1", "t3", 3), ("a", "2", "t1", 1), ("a", "3", "t2", 2), ("b", "1", "t1", 1), (None, "9", "t2", 2)],
        key=repr)
    now = {r[0] for r in spark.table(t).filter("category = 'b'").select(F.input_file_name()).collect()}
    assert (now == untouched) == bool(partition_by)
    assert list(tmp_path.iterdir()) == []  # nothing stays staged


@pytest.mark.parametrize("touched", [1, 1200])
def test_upsert_keeps_rows_of_null_and_empty_partitions(spark, rows, layer, tmp_path, touched):
    """An empty partition text is stored as null; neither may cost the rows that lie there."""
    t = f"{layer}.docs"
    catalog.ensure_table(spark, t, DOCUMENTS, partition_by=["category"])
    many = [(f"c{i}", "1", "t1", 1) for i in range(touched - 1)]
    first = [(None, "1", "t1", 1), ("", "2", "t1", 1), ("a", "1", "t1", 1), ("z", "1", "t1", 1), *many[:3]]
    second = [("", "3", "t2", 2), (None, "1", "t2", 2), (None, "1", "t1", 9), ("a", "2", "t2", 2), *many]
    for batch in (first, second, second):
        frame = spark.createDataFrame(batch, DOCUMENTS).withColumn("v", F.col("v").cast("bigint"))
        tables.upsert_by_key(spark, frame, t, staging=str(tmp_path))
    got = rows(spark.table(t).filter("category IS NULL OR length(category) = 1"), "category", "id", "v")
    assert got == sorted([(None, "1", 2), (None, "2", 1), (None, "3", 2), ("a", "1", 1), ("a", "2", 2), ("z", "1", 1)],
                         key=repr)
    assert spark.table(t).count() == 6 + max(3 if touched > 3 else 0, touched - 1)


def test_upsert_over_two_partition_columns_with_nulls(spark, rows, layer, tmp_path):
    t = f"{layer}.docs"
    ddl = "year int, category string, id string, ingestion_timestamp string"
    catalog.ensure_table(spark, t, ddl, partition_by=["year", "category"])
    first = [(y, c, "1", "t1") for y in (None, 2020) for c in (None, "a")]
    second = [(None, "a", "2", "t2"), (2020, None, "2", "t2")]
    for batch in (first, second):
        tables.upsert_by_key(spark, spark.createDataFrame(batch, ddl), t, ["year", "category", "id"], staging=str(tmp_path))
    assert rows(spark.table(t), *names(ddl)) == sorted(first + second, key=repr)


def test_upsert_refuses_partitions_outside_the_key(spark, layer):
    t = f"{layer}.docs"
    catalog.ensure_table(spark, t, DOCUMENTS, partition_by=["v"])
    with pytest.raises(ValueError, match="must be among"):
        tables.upsert_by_key(spark, spark.createDataFrame([], DOCUMENTS), t)


def test_staging_lies_in_the_shared_folder_of_the_session(spark, tmp_path):
    assert tables.staging_path(spark, str(tmp_path)).startswith(f"{tmp_path}/staged-")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert tables.staging_path(spark).startswith(shared.rstrip("/") + "/staged-")
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            tables.staging_path(spark)


def test_dual_write_sends_the_written_table_to_the_database(spark, rows, layer, monkeypatch):
    """The database write is recorded, not run: tests start no database."""
    sent = []

    def record(writer, *args, **kwargs):
        sent.append(writer)

    frames, options, modes = [], [], []
    real_format, real_options, real_mode = DataFrameWriter.format, DataFrameWriter.options, DataFrameWriter.mode
    monkeypatch.setattr(DataFrameWriter, "format", lambda w, f: (frames.append((w._df, f)), real_format(w, f))[1])
    monkeypatch.setattr(DataFrameWriter, "options", lambda w, **o: (options.append(o), real_options(w, **o))[1])
    monkeypatch.setattr(DataFrameWriter, "mode", lambda w, m: (modes.append(m), real_mode(w, m))[1])
    monkeypatch.setattr(DataFrameWriter, "save", record)
    t = f"{layer}.t"
    catalog.ensure_table(spark, t, "a int, load_timestamp timestamp")
    df = spark.range(2).select(F.col("id").cast("int").alias("a"), F.current_timestamp().alias("load_timestamp"))
    tables.dual_write(df, t, {"url": "jdbc:x", "dbtable": "t", "numPartitions": "4"})
    assert len(sent) == 1 and modes[-1] == "overwrite"
    frame, fmt = frames[-1]
    assert fmt == "jdbc" and rows(frame) == rows(spark.table(t))
    assert options == [{"truncate": "true", "url": "jdbc:x", "dbtable": "t", "numPartitions": "4"}]
    tables.dual_write(df, t)
    assert len(sent) == 1


def test_layers_are_created_listed_and_dropped(spark, rows, tmp_path):
    prefix = f"p{uuid.uuid4().hex[:6]}_"
    for _ in range(2):
        catalog.ensure_layers(spark, prefix, base=str(tmp_path), partitions=BRONZE_PARTITIONS)
    layers = [prefix + layer for layer in LAYER_TABLES]
    assert rows(catalog.list_layers(spark, layers)) == sorted(zip(layers, (3, 2, 5)), key=repr)
    for layer, ddls in LAYER_TABLES.items():
        for table, ddl in ddls.items():
            assert sorted(spark.table(f"{prefix}{layer}.{table}").columns) == sorted(names(ddl))
    for layer in layers:
        assert catalog.drop_layer(spark, layer) == []
        assert not spark.catalog.databaseExists(layer)
    assert catalog.drop_layer(spark, layers[0]) == []
    assert catalog.drop_layer(spark, layers[0], ["bad name"]) != []


MONTHS = ("Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic")


def _landed(tmp_path):
    def lines(name, docs):
        (tmp_path / name).write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))
        return str(tmp_path / name)

    periods = [{"name": f"{m}.{y}", "values": [{"value": str((y - 2019) * 10 + i)}]}
               for y in (2020, 2021) for i, m in enumerate(MONTHS)]
    series = [{"id": i, "response": {"periods": periods}} for i, *_ in (*R.SERIES, ("unregistered",))]
    annual = [{"id": i, "response": [{}, [{"date": str(y), "value": float(y), "unit": ""} for y in range(2000, 2016)]]}
              for i, *_ in R.ANNUAL]
    trade = [{"flow_code": f, "year": str(y), "response": {"data": [
        {"partnerCode": p, "cmdCode": "27", "cmdDescE": "Fuels", "primaryValue": 1000000.0 * (y - 2017), "netWgt": 1}
        for p in (156, 842, 999)] + [{"partnerCode": 76, "primaryValue": "abc"}]}}
        for f in "MX" for y in range(2018, 2024)]
    return (lines("series.json", series + ["{broken"]), lines("annual.json", annual),
            lines("trade.json", trade))


def test_whole_flow(spark, rows, tmp_path):
    prefix = f"p{uuid.uuid4().hex[:6]}_"
    series, annual, trade = _landed(tmp_path)
    cfg = FlowConfig(series, annual, trade, "2024-03-10T06:00:00", RUN_DATE, prefix=prefix,
                     base=f"{tmp_path}/lake", snapshots=f"{tmp_path}/snap", errors=f"{tmp_path}/err",
                     staging=f"{tmp_path}/staging")
    sources = {
        "series": {"accepted": 168, OUTSIDE: 0, "rejected": {"malformed json": 1, NOT_REQUESTED: 1}},
        "annual": {"accepted": 160, OUTSIDE: 0, "rejected": {}},
        "trade": {"accepted": 36, OUTSIDE: 0, "rejected": {"primaryValue is not a number": 12}},
    }
    # Two series and five indicators have no dimension row, and no day lies before 2015.
    broken = [("fact_economic_indicators", "foreign key", "date_key", 150),
              ("fact_economic_indicators", "foreign key", "indicator_key", 128),
              ("fact_trade_yearly", "foreign key", "partner_key", 12)]
    done = {"sources": sources, "failed_sources": {}, "missing_requests": [],
            "refreshed": {"economic_indicators": True, "trade_data": True}, "constraints": broken}
    for _ in range(2):  # a second run changes nothing
        assert run_flow(spark, cfg) == done
        t = lambda name: spark.table(prefix + name)
        assert t("bronze.bcrp_indicators").count() == 7 * 24
        assert t("bronze.worldbank_indicators").count() == 10 * 16
        assert t("bronze.comtrade_peru").count() == 2 * 6 * 3
        assert t("silver.economic_indicators").count() == 7 * 24 + 10 * 16
        fact = t("gold.fact_economic_indicators")
        assert fact.count() == 7 * 24 + 10 * 16
        jan = fact.filter("indicator_key = 'PN01270PM' and date_key = 20210101")
        assert rows(jan, "value_numeric", "prev_year_value", "yoy_change") == [(20.0, 10.0, 100.0)]
        gdp = fact.filter("indicator_key = 'NY.GDP.MKTP.CD' and prev_year_value is not null")
        assert rows(gdp, "year", "prev_year_value") == [(2012 + i, 2000.0 + i) for i in range(4)]
        china = t("gold.fact_trade_yearly").filter("partner_key = 156 and flow_code = 'X'")
        assert rows(china, "date_key", "trade_value_millions", "yoy_change_pct") == [
            (20180101, 1.0, None), (20190101, 2.0, 100.0), (20200101, 3.0, 50.0), (20210101, 4.0, 33.33),
            (20220101, 5.0, 25.0), (20230101, 6.0, 20.0)]
        assert t("gold.dim_date").count() == 4383
        assert fact.select("load_timestamp").distinct().count() == 1
    errors = spark.read.parquet(f"{tmp_path}/err/comtrade_peru/2024/03/10")
    assert errors.count() == 12
    lost = spark.read.parquet(f"{tmp_path}/err/bcrp_indicators/2024/03/10")
    assert rows(lost, "id", "error") == sorted([(None, "malformed json"), ("unregistered", NOT_REQUESTED)], key=repr)
    assert rows(lost.filter("id IS NULL"), "text") == [("{broken",)]
    assert spark.read.parquet(f"{tmp_path}/snap/comtrade_peru/2024/03/10").count() == 36

    # A source that cannot be read is reported; the others and the old rows stay.
    broken = FlowConfig(f"{tmp_path}/nowhere", annual, trade, "2024-03-11T06:00:00", RUN_DATE, prefix=prefix,
                        base=f"{tmp_path}/lake", staging=f"{tmp_path}/staging")
    result = run_flow(spark, broken)
    assert list(result["failed_sources"]) == ["series"]
    assert spark.table(f"{prefix}silver.economic_indicators").count() == 7 * 24 + 10 * 16
    for layer in LAYER_TABLES:
        catalog.drop_layer(spark, prefix + layer)


def test_every_landed_row_is_counted_and_windows_hold(spark, rows, tmp_path):
    """Rows before, in and after each window; lines without a key, with an unknown one, and broken."""
    def lines(name, docs):
        (tmp_path / name).write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))
        return str(tmp_path / name)

    def periods(*labels):
        return {"periods": [{"name": label, "values": [{"value": "1"}]} for label in labels]}

    daily, monthly = (next(i for i, _, _, freq in R.SERIES if (freq == "daily") == kind) for kind in (True, False))
    series = lines("series.json", [
        {"id": daily, "response": periods("31.Dic.2019", "02.Ene.20", "10.Mar.2024", "11.Mar.24")},
        {"id": monthly, "response": periods("Dic.2019", "Ene.2020", "Mar.2024", "Abr.2024")},
        {"id": "unregistered", "response": periods("Ene.2020")}, {"response": periods("Ene.2020")}, "{broken",
        json.dumps({"id": monthly, "response": periods("Feb.2020")}) + "]x",
    ])
    annual = lines("annual.json", [{"id": R.ANNUAL[0][0], "response": [{}, [
        {"date": str(y), "value": 1.0} for y in (1999, 2000, 2025, 2026)]]}])
    good, bad = {"partnerCode": 156, "primaryValue": 1.5}, {"partnerCode": 156, "primaryValue": "1d"}
    trade = lines("trade.json", [
        {"flow_code": "X", "year": "2018", "response": {"data": [good, bad]}},
        *[{"flow_code": "X", "year": y, "response": {"data": [good]}} for y in ("2017", "2030")],
        {"flow_code": "Z", "year": "2018", "response": {"data": [good]}}, {"flow_code": "X", "response": {"data": [good]}},
    ])
    prefix = f"p{uuid.uuid4().hex[:6]}_"
    cfg = FlowConfig(series, annual, trade, "2024-03-10T06:00:00", RUN_DATE, prefix=prefix,
                     base=f"{tmp_path}/lake", staging=f"{tmp_path}/staging")
    catalog.ensure_layers(spark, prefix, base=f"{tmp_path}/lake", partitions=BRONZE_PARTITIONS)
    loaded, failures = ingest_sources(spark, cfg)
    assert failures == {} and loaded == {
        "series": {"accepted": 4, OUTSIDE: 4, "rejected": {NO_KEY: 1, NOT_REQUESTED: 1, "malformed json": 2}},
        "annual": {"accepted": 2, OUTSIDE: 2, "rejected": {}},
        "trade": {"accepted": 1, OUTSIDE: 2,
                  "rejected": {NO_KEY: 1, NOT_REQUESTED: 1, "primaryValue is not a number": 1}},
    }
    stored = spark.table(f"{prefix}bronze.bcrp_indicators")
    assert rows(stored, "series_id", "period") == sorted(
        [(daily, "02.Ene.20"), (daily, "10.Mar.2024"), (monthly, "Ene.2020"), (monthly, "Mar.2024")], key=repr)
    assert len(missing_requests(spark, cfg)) == 2 * 6 - 1
    for layer in LAYER_TABLES:
        catalog.drop_layer(spark, prefix + layer)

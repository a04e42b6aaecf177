"""Damaged and landed files, schemaless documents and upserts by file, on hand-made folders."""

from __future__ import annotations

import datetime as dt
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from andesite.operators import snapshots
from andesite.operators.joins import star_trade, star_trade_by_year, with_date_year
from andesite.plans.flow import OUTSIDE, FlowConfig, ingest_sources
from andesite.plans.flow import BRONZE_PARTITIONS
from andesite.plans.gold import describe_days
from andesite.schemas import LAYER_TABLES
from andesite.sinks import assignment, catalog, tables
from andesite.sinks.catalog import ensure_layers
from andesite.sources import landing, schemaless


def parts(folder) -> list[Path]:
    return sorted(p for p in Path(folder).rglob("part-*") if not p.name.endswith(".crc"))


def truncate(path: Path) -> None:
    raw = path.read_bytes()
    path.write_bytes(raw[: len(raw) // 2])
    crc = path.with_name(f".{path.name}.crc")
    if crc.exists():
        os.truncate(crc, 0)
        crc.write_bytes(b"")


# --- damaged files -----------------------------------------------------------------------


def test_damaged_files_cost_only_themselves_and_are_named(spark, tmp_path):
    folder = str(tmp_path / "in 1")
    spark.range(12).select("id", (F.col("id") % 4).cast("int").alias("k")).coalesce(1).write.partitionBy("k").parquet(folder)
    files = parts(folder)
    truncate(files[1])
    files[2].write_bytes(b"PAR1 no footer")
    files[2].with_name(f".{files[2].name}.crc").unlink()
    (Path(folder) / "empty.parquet").write_bytes(b"")
    spark.range(0).select("id").coalesce(1).write.parquet(f"{folder}/k=9")
    good, errors = landing.read_isolated_files(spark, folder, "parquet", "id bigint")
    assert sorted(r.id for r in good.collect()) == [0, 3, 4, 7, 8, 11]
    got = {(r.file_path.rsplit("/", 1)[1], r.error) for r in errors.collect()}
    assert got == {(files[n].name, landing.UNREADABLE) for n in (1, 2)}


def test_text_files_without_rows_are_named_and_missing_folders_are_empty(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "b.txt.gz").write_bytes(b"not a gzip file")
    (tmp_path / "c.txt").write_text("")
    good, errors = landing.read_isolated_files(spark, str(tmp_path), "text", "value string")
    assert sorted(r.value for r in good.collect()) == ["one", "two"]
    assert [(r.file_path.rsplit("/", 1)[1], r.size) for r in errors.collect()] == [("b.txt.gz", 15)]
    good, errors = landing.read_isolated_files(spark, f"{tmp_path}/none", "text", "value string")
    assert good.isEmpty() and errors.isEmpty()


def test_listing_reads_no_content(spark, tmp_path, capsys):
    (tmp_path / "a.txt").write_text("one")
    landing.landed_files(spark, str(tmp_path)).explain()
    assert "content:binary" not in capsys.readouterr().out


# --- ledger ------------------------------------------------------------------------------


def test_only_new_and_changed_files_are_loaded(spark, tmp_path):
    landed, ledger = tmp_path / "landed", str(tmp_path / "ledger")
    landed.mkdir()
    seen = []

    def load(found):
        seen.append((sorted(r.value for r in found.rows.collect()), found.unreadable.count()))

    def run():
        return landing.pick_up(spark, str(landed), ledger, load, "t")

    assert run() == 0 and seen == []
    (landed / "a b.txt").write_text("a\n")
    (landed / "b.txt").write_text("b\n")
    (landed / "bad.txt.gz").write_bytes(b"junk")
    assert run() == 3 and seen.pop() == (["a", "b"], 1)
    assert run() == 0 and seen == []
    (landed / "b.txt").write_text("b\nmore\n")
    (landed / "c.txt").write_text("c\n")
    assert run() == 2 and seen.pop() == (["b", "c", "more"], 0)
    assert run() == 0 and seen == []
    assert spark.read.parquet(ledger).count() == 5


def test_a_failed_load_is_not_entered(spark, tmp_path):
    (tmp_path / "landed").mkdir()
    (tmp_path / "landed" / "a.txt").write_text("a\n")

    def fail(found):
        raise RuntimeError("no")

    for _ in range(2):
        with pytest.raises(RuntimeError):
            landing.pick_up(spark, f"{tmp_path}/landed", f"{tmp_path}/ledger", fail, "t")
    assert landing.pick_up(spark, f"{tmp_path}/landed", f"{tmp_path}/ledger", lambda found: None, "t") == 1


def test_flow_with_a_ledger_loads_each_response_once(spark, tmp_path):
    prefix = f"led_{tmp_path.name.replace('-', '_')[:12]}_"
    ensure_layers(spark, prefix, base=str(tmp_path / "lake"), partitions=BRONZE_PARTITIONS)
    for name in ("series", "annual", "trade"):
        (tmp_path / name).mkdir()
    line = lambda v: json.dumps({"id": "PN01207PM", "response": {"periods": [{"name": "Ene.2022", "values": [v]}]}})
    (tmp_path / "series" / "1.json").write_text(line("3.5") + "\n")
    (tmp_path / "series" / "2.json.gz").write_bytes(b"damaged")
    cfg = FlowConfig(
        str(tmp_path / "series"), str(tmp_path / "annual"), str(tmp_path / "trade"), "2024-03-10T06:00:00",
        dt.date(2024, 3, 10), prefix=prefix, staging=str(tmp_path / "staging"), ledger=str(tmp_path / "ledger"))
    loaded, failures = ingest_sources(spark, cfg)
    assert failures == {} and loaded["annual"] == {"files": 0, "accepted": 0, OUTSIDE: 0, "rejected": {}}
    assert loaded["series"]["files"] == 2 and loaded["series"]["rejected"].get(landing.UNREADABLE) == 1
    first = loaded["series"]["accepted"] + sum(loaded["series"]["rejected"].values())
    assert first == 2
    assert ingest_sources(spark, cfg)[0]["series"] == {"files": 0, "accepted": 0, OUTSIDE: 0, "rejected": {}}


# --- schemaless documents ----------------------------------------------------------------

TEXTS = [
    '{"a":1,"b":"x","c":{"d":1.5,"OBJECT":null,"e f":[1,2]},"m":1,"n":null,"ar":[1,"x"],"o":1,"VOID":{"VARIANT":2}}',
    '{"a":2.25,"b":null,"c":{"d":"t"},"m":"txt","z":true,"o":{"p":1}}', "[1]", '{"a"', None, '{"a":1} {"a":2}',
]


@pytest.mark.parametrize("conflicts", ["variant", "text"])
def test_types_are_merged_over_all_documents(spark, conflicts):
    df = spark.createDataFrame([(t,) for t in TEXTS], "value string")
    documents, errors = schemaless.typed_documents(df, conflicts=conflicts)
    types = {f.name: f.dataType.simpleString() for f in documents.schema}
    clash = "variant" if conflicts == "variant" else "string"
    assert types["m"] == types["o"] == clash and types["n"] == "string" and types["z"] == "boolean"
    assert types["a"].startswith("decimal") and types["ar"] == f"array<{clash}>"
    assert types["c"] == f"struct<OBJECT:string,d:{clash},e f:array<bigint>>" and types["VOID"] == "struct<VARIANT:bigint>"
    assert all(f.nullable for f in documents.schema)
    got = documents.orderBy("a").select("a", F.col("m").cast("string"), "c.`e f`", "VOID.VARIANT").collect()
    assert [(float(r[0]), r[1], r[2], r[3]) for r in got] == [(1.0, "1", [1, 2], 2), (2.25, "txt", None, None)]
    assert sorted(r.error for r in errors.collect()) == ["document is not an object"] + ["malformed json"] * 3


def test_documents_without_fields_or_objects(spark):
    for texts, n in (([], 0), (["{}", "{}"], 2), (["[1]", "2"], 0)):
        df = spark.createDataFrame([(t,) for t in texts], "value string")
        documents, errors = schemaless.typed_documents(df)
        assert documents.columns == [] and documents.count() == n and errors.count() == len(texts) - n
    with pytest.raises(ValueError):
        schemaless.typed_documents(df, conflicts="x")


# --- upsert by file ----------------------------------------------------------------------


@pytest.fixture
def stored(spark, tmp_path):
    folder = str(tmp_path / "table")
    spark.range(0, 1000).select("id", F.lit("old").alias("v"), F.lit(1).alias("t")).repartitionByRange(10, "id").write.parquet(folder)
    return folder


def batch(spark, ids, v="new", t=2):
    return spark.createDataFrame([(i, v, t) for i in ids], "id int, v string, t int")


def test_only_files_with_keys_of_the_batch_are_rewritten(spark, stored, tmp_path):
    before = {p.name for p in parts(stored)}
    frame = batch(spark, [5, 7, -3]).union(batch(spark, [5], "newest", 3))
    assert tables.upsert_files(spark, frame, stored, ["id"], ["t"], staging=str(tmp_path / "s")) == 1
    after = {p.name for p in parts(stored)}
    assert len(before & after) == 9
    got = {r.id: r.v for r in spark.read.parquet(stored).collect()}
    assert len(got) == 1001 and spark.read.parquet(stored).count() == 1001
    assert (got[5], got[7], got[-3], got[8]) == ("newest", "new", "new", "old")
    assert tables.upsert_files(spark, batch(spark, [5000]), stored, ["id"], ["t"], staging=str(tmp_path / "s")) == 0
    assert tables.upsert_files(spark, batch(spark, []), stored, ["id"], ["t"], staging=str(tmp_path / "s")) == 0
    assert spark.read.parquet(stored).count() == 1002
    assert not [p for p in Path(stored).iterdir() if p.name.startswith(("_upsert", "_replaced"))]


def test_file_upsert_in_partitions_and_with_null_keys(spark, tmp_path):
    folder = str(tmp_path / "table")
    schema = "id int, v string, t int, k string"
    first = [(i, "old", 1, k) for i in range(20) for k in ("a", "b")] + [(None, "old", 1, "a")]
    spark.createDataFrame(first, schema).repartition(4, "id").write.partitionBy("k").parquet(folder)
    new = spark.createDataFrame([(3, "new", 2, "a"), (None, "new", 2, "a"), (99, "new", 2, "c")], schema)
    tables.upsert_files(spark, new, folder, ["k", "id"], ["t"], ["k"], staging=str(tmp_path / "s"))
    got = sorted((str(r.id), r.k, r.v) for r in spark.read.parquet(folder).collect())
    want = {(str(i), k): v for i, v, _, k in first} | {("3", "a"): "new", ("None", "a"): "new", ("99", "c"): "new"}
    assert got == sorted((i, k, v) for (i, k), v in want.items())
    with pytest.raises(ValueError, match="must be among"):
        tables.upsert_files(spark, new, folder, ["id"], ["t"], ["k"], staging=str(tmp_path / "s"))


@pytest.mark.parametrize("moved", [False, True])
def test_an_upsert_cut_off_after_its_commit_is_completed(spark, stored, tmp_path, monkeypatch, moved):
    real = tables.finish_upserts
    calls = []

    def cut(spark, path):
        calls.append(path)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(spark, path)

    monkeypatch.setattr(tables, "finish_upserts", cut)
    with pytest.raises(KeyboardInterrupt):
        tables.upsert_files(spark, batch(spark, [5]), stored, ["id"], ["t"], staging=str(tmp_path / "s"))
    if moved:  # cut off again, after a new file was moved in
        new = next(p for p in parts(stored) if "_upsert-" in str(p))
        new.rename(Path(stored) / new.name)
    assert real(spark, stored) == 1 and real(spark, stored) == 0
    table = spark.read.parquet(stored)
    assert table.count() == 1000 and table.filter("id = 5").first().v == "new"


def test_an_upsert_cut_off_before_its_commit_leaves_the_table(spark, stored, tmp_path):
    batch(spark, [1]).write.parquet(f"{stored}/_upsert-1")
    (Path(stored) / "_replaced-1").mkdir()
    assert tables.finish_upserts(spark, stored) == 0
    assert spark.read.parquet(stored).filter("v = 'new'").isEmpty() and spark.read.parquet(stored).count() == 1000


# --- snapshots ---------------------------------------------------------------------------


def test_snapshots_are_read_as_of_a_day(spark, tmp_path):
    for day, n in ((dt.date(2024, 1, 31), 1), (dt.date(2024, 2, 29), 2), (dt.date(2024, 3, 1), 3)):
        tables.snapshot_parquet(spark.range(n), str(tmp_path), "s", day)
    (tmp_path / "s/2024/03/01/_SUCCESS").unlink()  # a write that was cut off

    def rows(*day):
        return snapshots.read_snapshot(spark, str(tmp_path), "s", dt.date(*day), "id bigint").count()

    assert (rows(2024, 1, 31), rows(2024, 2, 28), rows(2024, 3, 15)) == (1, 1, 2)
    for source in ("s", "none"):
        with pytest.raises(FileNotFoundError):
            snapshots.read_snapshot(spark, str(tmp_path), source, dt.date(2024, 1, 30))


def test_changes_of_nulls_repeats_and_further_columns(spark):
    schema = "k string, n int, v double, t string"
    before = spark.createDataFrame(
        [(None, 1, None, "a"), (None, 2, 1.0, "a"), ("x", 1, float("nan"), "a"), ("x", 2, 0.0, None), ("y", 1, 1.0, "r"),
         ("y", 1, 1.0, "r"), ("y", 1, 1.0, "r")], schema)
    after = spark.createDataFrame(
        [(None, 1, None, "a", 1), (None, 2, 2.0, "b", None), ("x", 1, float("nan"), "a", None), ("x", 2, -0.0, None, None),
         ("y", 1, 1.0, "r", None), ("z", 9, 1.0, None, None)], schema + ", more int")
    got = {(r.k, r.n): (r.change, r.n_gone, r.n_added, r.columns) for r in snapshots.snapshot_changes(before, after, ["k", "n"]).collect()}
    assert got == {(None, 1): ("changed", 1, 1, ["more"]), (None, 2): ("changed", 1, 1, ["v", "t"]),
                   ("y", 1): ("gone", 2, 0, None), ("z", 9): ("added", 0, 1, None)}
    assert snapshots.snapshot_changes(before, before, ["k", "n"]).isEmpty()
    assert snapshots.snapshot_changes(before.limit(0), before, list(before.columns)).count() == 5


# --- store assignment --------------------------------------------------------------------


def test_values_a_table_would_refuse_are_named_before_the_insert(spark, tmp_path):
    spark.sql(f"CREATE TABLE narrow (i INT, c VARCHAR(3), d DECIMAL(4,1), day DATE) USING parquet LOCATION '{tmp_path}/narrow'")
    good = spark.createDataFrame([(1, "abc  ", 999.94, dt.date(2024, 1, 1)), (None, None, None, None)], "i bigint, c string, d double, day date")
    assignment.overwrite_checked(good, "narrow")
    bad = spark.createDataFrame([(2**40, "abcd", 999.96, "x"), (5, "b", 1.0, "y")], "i bigint, c string, d double, day string")
    with pytest.raises(assignment.AssignmentError) as e:
        assignment.overwrite_checked(bad, "narrow")
    for part in ("i: value does not fit in 1 rows, such as 1099511627776", "c: text too long in 1 rows, such as abcd",
                 "d: value does not fit in 1 rows", "day: type not assignable"):
        assert part in str(e.value)
    assert spark.table("narrow").count() == 2
    wanted = assignment.table_types(spark, "narrow")
    assert assignment.assignment_report(good.limit(0), wanted).isEmpty()
    assert assignment.assignment_report(spark.createDataFrame([(None,)], "q int").limit(0), wanted).count() == 5
    assert assignment.assignment_report(spark.createDataFrame([(None,)], "i int"), {"i": ("int", False)}).first().problem == "null"
    spark.sql("DROP TABLE narrow")


# --- drift -------------------------------------------------------------------------------


def test_drift_of_layers_is_reported_and_additions_are_made_once(spark, rows):
    prefix = "drifting_"
    ensure_layers(spark, prefix)
    assert catalog.layer_drift(spark, prefix).isEmpty()
    layer, name = next((layer, next(iter(t))) for layer, t in LAYER_TABLES.items())
    declared = {layer: {name: LAYER_TABLES[layer][name] + ", later int, `odd name` array<string>", "other": "a int"}}
    missing = [(layer, name, "later", "int", None, catalog.NO_COLUMN), (layer, name, "odd name", "array<string>", None, catalog.NO_COLUMN)]
    absent = (layer, "other", None, None, None, catalog.NO_TABLE)
    assert set(rows(catalog.layer_drift(spark, prefix, declared))) == {*missing, absent}
    assert len(catalog.add_missing_columns(spark, prefix, declared)) == 1
    assert catalog.add_missing_columns(spark, prefix, declared) == []
    assert rows(catalog.layer_drift(spark, prefix, declared)) == [absent]
    for layer in LAYER_TABLES:
        catalog.drop_layer(spark, prefix + layer)


# --- facts stored by year ----------------------------------------------------------------


def test_a_filter_on_dates_prunes_the_years_of_stored_facts(spark, tmp_path, capsys):
    days = spark.sql("SELECT explode(sequence(DATE '2015-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS full_date")
    describe_days(days).write.parquet(f"{tmp_path}/dates")
    facts = spark.createDataFrame([(y * 10000 + 101, p, float(y)) for y in range(2015, 2025) for p in range(3)] + [(None, 1, 0.0)],
                                  "date_key int, partner_key int, value double")
    with_date_year(facts).write.partitionBy("date_year").parquet(f"{tmp_path}/facts")
    partners = spark.createDataFrame([(0, "p0", "r"), (1, "p1", "r")], "partner_key int, partner_name string, region string")
    stored, dates = spark.read.parquet(f"{tmp_path}/facts"), spark.read.parquet(f"{tmp_path}/dates")
    star = star_trade_by_year(stored, dates, partners)
    plain = star_trade(facts, dates, partners)
    assert set(star.columns) == set(plain.columns)
    assert sorted(star.select(plain.columns).collect(), key=repr) == sorted(plain.collect(), key=repr)
    late = star.filter("full_date >= DATE '2023-01-01'")
    capsys.readouterr()
    late.explain()
    assert "dynamicpruning" in capsys.readouterr().out
    assert late.count() == 6

"""What large tables shuffle: texts go through no more exchanges than the result needs."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from andesite.llm import mixing
from andesite.llm.common import key_filter, split_by_filter

DOCS = "doc_id bigint, text string, source string, key int, range int"


def test_rows_are_split_by_a_filter_without_a_shuffle(spark, capsys):
    docs = spark.range(5000).select(
        F.col("id").cast("int").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.lit(1).alias("row"),
        F.lit(2).alias("bits"), F.lit(3).alias("a.b"))
    docs = docs.union(docs.select(F.lit(None).cast("int"), F.lit(None).cast("string"), "row", "bits", "`a.b`").limit(1))
    keys = spark.range(0, 5000, 7).select("id", F.xxhash64(F.concat(F.lit("t"), "id")).alias("mark"))
    perhaps, others = split_by_filter(
        docs, [docs["doc_id"].cast("bigint"), F.xxhash64(docs["text"])], key_filter(keys))
    found, left = ({r.doc_id for r in df.collect()} for df in (perhaps, others))
    assert set(range(0, 5000, 7)) <= found and len(found) < 800
    assert found | left == {None, *range(5000)} and not found & left and perhaps.columns == docs.columns
    nothing = key_filter(keys.limit(0))
    assert split_by_filter(docs, [docs["doc_id"].cast("bigint"), F.xxhash64(docs["text"])], nothing)[1].count() == 5001
    others.drop("a.b").join(spark.range(1).hint("broadcast")).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_texts_are_shuffled_once_to_their_block(spark, capsys):
    rows = [(i, f"{i} " * (1 + i % 9), "abc"[i % 3], 1, 2) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    mixed = mixing.mixed_documents(docs, max_repeats=2.0, keep_all=True, block_tokens=40)
    mixed.explain()
    plan = capsys.readouterr().out
    assert plan.count("hashpartitioning") == 1 and "SortMergeJoin" not in plan
    taken = Counter(r.row.doc_id for r in mixing.mix(docs, max_repeats=2.0, keep_all=True, block_tokens=40).collect())
    assert Counter(r.doc_id for r in mixed.collect()) == taken and set(taken) == set(range(200))


def test_bounds_between_equal_rows_and_without_broadcast(spark, monkeypatch):
    """Equal rows go to the blocks and past the quota one by one, as positions say."""
    rows = [(i, f"{i} " * (1 + i % 9), "abc"[i % 3], 1, 2) for i in range(60)]
    rows += [(7, "a b c", "a", 1, 2)] * 90 + [(None, "x y", "b", 1, 2)] * 70 + [(None, None, None, 1, 2)] * 30
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for most in (mixing.MOST_BOUNDS, 0):
        monkeypatch.setattr(mixing, "MOST_BOUNDS", most)
        for options in (dict(max_repeats=2.0, keep_all=True), dict(max_repeats=3.0, budget_share=0.4)):
            want = mixing.mix(docs, block_tokens=25, **options).orderBy("block", "order_key").collect()
            mixed = mixing.mixed_documents(docs, block_tokens=25, **options).collect()
            assert Counter(mixed) == Counter(r.row for r in want) and len(mixed) > 60
            at = mixing.all_copies(docs, mixing.source_quotas(docs, options.get("budget_share", 1.0), options[
                "max_repeats"], None, 25, "keep_all" in options), mixing.SEED, None)
            assert any(b.cut for r in mixing.block_bounds(at).collect() for b in r.bounds)

"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from andesite.llm import (
    centroids, divergence, fertility, langid, mixing, near_dup, ngram_join, packed_files, packing, pii, topk, unigram, urls,
)
from andesite.llm.common import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.pii_spans(table(spark, sf_dir, "documents")))


@query
def op5_packed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments read back from the files of packed rows."""
    folder = f"{shared_folder(spark)}/packed-{uuid.uuid4().hex}"
    packed = packed_files.write_packed(table(spark, sf_dir, "documents"), folder)
    return packed_files.packed_pieces(packed)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(table(spark, sf_dir, "documents"))


@query
def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"))


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()))
    held = F.coalesce(langid.held_out(), F.lit(False)).alias("held_out")
    return langid.predict(docs, model).select("doc_id", held, "lang_pred", "score", "languages")


@query
def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "row.doc_id", "source", "epoch", "tokens", "position", "block", "order_key"
    )


SQL["op9_mixing"] = mixing.MIX_SQL


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query
def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


SQL["op2_top_k"] = topk.SEARCH_SQL
SQL["op8_urls"] = urls.URLS_SQL
SQL["op10_near_duplicates"] = near_dup.NEAR_SQL
SQL["op11_centroids"] = centroids.CLUSTER_SQL
SQL["op12_divergence"] = divergence.DIVERGENCE_SQL
SQL["op13_ngram_join"] = ngram_join.JOIN_SQL

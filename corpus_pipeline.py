"""From raw documents to packed sequences, in stages that are each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one before kept; all but
the last return the columns of the documents.

language  learn languages from the training part of the documents; those of unknown language go, and
          those of which the languages chosen for them explain too little
near_dup  one document of each group of near-duplicates (word runs alike by at least 80 per cent)
          stays, that with the smallest doc_id
pii       personal data is replaced by its kind
mixing    sources are mixed to flatter weights: every document is taken, those of small sources up to
          MAX_REPEATS times, in the order of permuted blocks
packing   pieces of the documents, placed in sequences

Null and empty texts are of unknown language and go in the first stage.  Repeated rows count as one
document from the second stage on; rows with a null doc_id are kept as they are.  Further columns
ride along; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from andesite.llm import langid, mixing, near_dup, packing, pii
from andesite.llm.common import stage, table

# The least share of a document's text in the languages chosen for it, of all languages.
LEAST_EXPLAINED = 0.35
# Documents of at least this similarity, in per cent, are near-duplicates.
NEAR_PERCENT = 80
# No document is taken more often by the mixture.
MAX_REPEATS = 2.0


# Rows and bytes of the batches in which texts go to Python and come back.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def _small_batches(spark: SparkSession) -> None:
    for name, value in BATCH.items():
        spark.conf.set(name, value)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    model = langid.train(docs.filter(~langid.held_out()))
    return langid.keep_known(docs, model, LEAST_EXPLAINED)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return near_dup.drop_near_duplicates(docs, NEAR_PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_pii(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, max_repeats=MAX_REPEATS, keep_all=True)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).drop("ids")


STAGES = [
    ("language", language),
    ("near_dup", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixture),
    ("packing", sequences),
]

# Signatures, learned models and tokenizers are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Scans over landed JSON responses.

A *response frame* holds one row per response: the request keys, the text and the parsed
``payload`` (VARIANT, null when the text is not JSON).  The ``parse_*`` functions flatten it
to one row per data element and keep whatever cannot be read as rows with a reason in
``_error``; ``accepted`` and ``rejected`` split the two.  A bad response never hides another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from andesite.functions.measures import json_num_or_zero
from andesite.functions.semistructured import (
    computed_once,
    field,
    holds_other,
    is_object,
    list_at,
    with_json,
)

MALFORMED = "malformed json"
# Fields read from the rows of annual and trade responses.
META_FIELDS = "date string, value string, unit string, country struct<value: string>"
DATA_FIELDS = (
    "partnerCode string, cmdCode string, cmdDescE string, primaryValue variant, netWgt variant"
)
NUMBERS = ("primaryValue", "netWgt")
NOT_AN_OBJECT = "row is not an object"
NO_RESPONSE_OBJECT = "response is not an object"
NO_RESPONSE_LIST = "response is not a list"
ERROR_COLUMNS = ("_error", "_rejected_text")


def responses_from(df: DataFrame, text: str = "response", keys: Sequence[str] = ("id",)) -> DataFrame:
    """Response frame from a frame that has the request keys and the response text."""
    return with_json(df.select(*keys, F.col(text).alias("text")), "text", "payload")


def load_envelopes(spark: SparkSession, path: str, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Response frame from JSON lines ``{"id": ..., "response": ...}``.

    Lines split over tasks, so one large file (or one busy source) spreads over the cluster.
    """
    return envelopes(spark.read.text(path), keys)


def envelopes(lines: DataFrame, keys: Sequence[str] = ("id",), text: str = "value") -> DataFrame:
    """Response frame from lines of text that are read already."""
    named = lines.select(F.col(text).alias("text"))
    return with_json(named, "text", "doc").select(
        *[field("doc", f"$.{k}").alias(k) for k in keys],
        "text",
        F.try_variant_get("doc", "$.response", "variant").alias("payload"),
    )


def load_response_files(
    spark: SparkSession, path: str, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """Response frame from one file per response, keys taken from ``key=value`` directories.

    A response is read as one row, as the source sends it in one bounded page.
    """
    layout = ", ".join(["value string"] + [f"{k} string" for k in keys])
    files = spark.read.schema(layout).text(path, wholetext=True)
    return responses_from(files, "value", keys)


def spread(raw: DataFrame) -> DataFrame:
    """Rows of fewer files than there are cores, dealt over the cores.

    Expanding a response costs far more than shipping its text, and one row group is read by one
    task.  Frames of many files stay as they are, so nothing of size is shuffled.
    """
    cores = raw.sparkSession.sparkContext.defaultParallelism
    return raw.repartition(cores) if len(raw.inputFiles()) < cores else raw


def _keys(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in ("text", "payload")]


def _explode_items(
    raw: DataFrame, keys: list[str], path: str, wrong: str, shape: str
) -> DataFrame:
    """One row per element of the list at ``path``, or a single row that carries an error.

    ``shape`` is the error of a response of another kind.  Lists and errors are computed before
    they are exploded, in steps of their own: written in one step, they would be computed again
    for every element.
    """
    located = raw.select(*keys, "text", "payload", list_at("payload", path).alias("_items"))
    fits = is_object("payload") if shape == NO_RESPONSE_OBJECT else list_at("payload", "$").isNotNull()
    error = (
        F.when(F.col("payload").isNull(), F.lit(MALFORMED))
        .when(F.col("_items").isNull() & ~fits, F.lit(shape))
        .when(F.col("_items").isNull() & holds_other("payload", path), F.lit(f"{wrong} is not a list"))
    )
    judged = located.select(*keys, "text", "_items", error.alias("_error"))
    texts = judged.select(
        *keys, "_items", "_error", F.when(F.col("_error").isNotNull(), F.col("text")).alias("_rejected_text")
    )
    return texts.select(*keys, *ERROR_COLUMNS, F.explode_outer("_items").alias("item")).filter(
        F.col("item").isNotNull() | F.col("_error").isNotNull()
    )


def _reject(df: DataFrame, reason: Column) -> DataFrame:
    """Fill the error columns of the rows for which ``reason`` is not null."""
    judged = df.withColumn("_reason", reason)
    text = F.coalesce("_rejected_text", F.when(F.col("_reason").isNotNull(), F.to_json("item")))
    return judged.withColumns(
        {"_rejected_text": text, "_error": F.coalesce("_error", "_reason")}
    ).drop("_reason")


def parse_period_series(raw: DataFrame) -> DataFrame:
    """Flatten ``{periods: [{name, values: [...]}]}`` to (keys, period, value, raw_response).

    A response without ``periods`` has no rows.  An element of ``values`` is an object with a
    ``value`` field or a bare scalar.  ``raw_response`` is the period as JSON text.
    """
    keys = _keys(raw)
    periods = _explode_items(raw, keys, "$.periods", "periods", NO_RESPONSE_OBJECT)
    named = periods.withColumns(
        {"period": field("item", "$.name"), "_values": list_at("item", "$.values")}
    )
    unread = F.when(
        F.col("item").isNotNull() & F.col("period").isNull(), F.lit("period without name")
    ).when(F.col("_values").isNull() & holds_other("item", "$.values"), F.lit("values is not a list"))
    judged = _reject(named, unread)
    values = judged.select(
        *keys,
        "period",
        F.to_json("item").alias("raw_response"),
        *ERROR_COLUMNS,
        F.when(F.col("_error").isNull(), F.col("_values")).alias("_values"),
    )
    elements = values.select(
        *keys, "period", "raw_response", *ERROR_COLUMNS, F.explode_outer("_values").alias("element")
    ).filter(F.col("element").isNotNull() | F.col("_error").isNotNull())
    text = field("element", "$.value")
    scalar = F.when(text.isNull() & ~is_object("element"), field("element", "$"))
    value = computed_once(F.coalesce(text, scalar)).alias("value")
    return elements.select(*keys, "period", value, "raw_response", *ERROR_COLUMNS)


def _read_fields(rows: DataFrame, keys: list[str], fields: str) -> DataFrame:
    """Add the text of some fields of each row as one struct; null for a row of another kind."""
    read = F.try_variant_get("item", "$", f"struct<{fields}>")
    return rows.select(*keys, "item", *ERROR_COLUMNS, computed_once(read).alias("fields"))


def parse_meta_rows(raw: DataFrame) -> DataFrame:
    """Flatten ``[metadata, rows]`` to (keys, item, fields).

    ``item`` is the whole row; ``fields`` has date, value, unit and country as text.  An empty or
    null second element has no rows.
    """
    keys = _keys(raw)
    rows = _explode_items(raw, keys, "$[1]", "second element", NO_RESPONSE_LIST)
    read = _read_fields(rows, keys, META_FIELDS)
    unread = F.when(
        F.col("item").isNotNull() & F.col("fields").isNull(), F.lit(NOT_AN_OBJECT)
    ).when(
        F.col("fields.value").isNotNull() & F.col("fields.date").isNull(), F.lit("row without date")
    )
    return _reject(read, unread)


def parse_data_rows(raw: DataFrame) -> DataFrame:
    """Flatten ``{data: [...]}`` to (keys, item, fields, numbers).

    ``item`` is the whole row; ``fields`` has partner and product as text, value and weight
    as JSON values, and ``numbers`` the latter two as doubles.  A response without ``data`` has no
    rows.  A row whose value or weight is present but no number is rejected.
    """
    keys = _keys(raw)
    rows = _explode_items(raw, keys, "$.data", "data", NO_RESPONSE_OBJECT)
    read = _read_fields(rows, keys, DATA_FIELDS)
    numbers = F.struct(*[json_num_or_zero(f"fields.{name}").alias(name) for name in NUMBERS])
    numbered = read.select(*read.columns, computed_once(numbers).alias("numbers"))
    unread = F.when(F.col("item").isNotNull() & F.col("fields").isNull(), F.lit(NOT_AN_OBJECT))
    for name in NUMBERS:
        unread = unread.when(F.col(f"numbers.{name}").isNull(), F.lit(f"{name} is not a number"))
    return _reject(numbered, unread)


def accepted(parsed: DataFrame) -> DataFrame:
    """The rows that could be read."""
    return parsed.filter(F.col("_error").isNull()).drop(*ERROR_COLUMNS)


def rejected(parsed: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """What could not be read: request keys, reason and text."""
    return parsed.filter(F.col("_error").isNotNull()).select(
        *keys, F.col("_error").alias("error"), F.col("_rejected_text").alias("text")
    )


def read_isolated(parsed: DataFrame, keys: Sequence[str] = ("id",)) -> tuple[DataFrame, DataFrame]:
    """Split a parsed frame into (rows, errors)."""
    return accepted(parsed), rejected(parsed, keys)


def read_period_series(spark: SparkSession, path: str, keys: Sequence[str] = ("id",)) -> DataFrame:
    return accepted(parse_period_series(load_envelopes(spark, path, keys)))


def read_meta_rows(spark: SparkSession, path: str, keys: Sequence[str] = ("id",)) -> DataFrame:
    return accepted(parse_meta_rows(load_envelopes(spark, path, keys)))


def read_data_rows(
    spark: SparkSession, path: str, keys: Sequence[str] = ("flow_code", "year")
) -> DataFrame:
    return accepted(parse_data_rows(load_envelopes(spark, path, keys)))

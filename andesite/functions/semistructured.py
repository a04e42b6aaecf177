"""Access to parsed JSON held as VARIANT, which keeps *absent* and *null* apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_json(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the JSON document that a text holds, null unless it holds exactly one.

    Spark's parser stops after the first document and would drop what follows it.  The text is
    therefore read as the first of two elements, the second being a number computed from the
    text: a text that closes the list early, or goes on after its document, has another second
    element or a third.
    """
    mark = F.xxhash64(text)
    pair = F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(","), mark.cast("string"), F.lit("]")))
    alone = (F.try_variant_get("_pair", "$[1]", "bigint") == mark) & F.try_variant_get(
        "_pair", "$[2]", "variant"
    ).isNull()
    only = F.when(alone, F.try_variant_get("_pair", "$[0]", "variant"))
    return df.withColumn("_pair", pair).withColumn(out, only).drop("_pair")


def field(v: str | Column, path: str, type_: str = "string") -> Column:
    """Value at a path; null when absent, JSON null or not convertible."""
    return F.try_variant_get(_col(v), path, type_)


def field_or(v: str | Column, path: str, default: str, null_text: str | None = None) -> Column:
    """Text at a path, or ``default`` when the key is absent.

    An explicit JSON null also gives ``default`` unless ``null_text`` names another text.
    """
    text = field(v, path)
    if null_text is None:
        return F.coalesce(text, F.lit(default))
    explicit = F.is_variant_null(F.try_variant_get(_col(v), path, "variant"))
    return F.coalesce(text, F.when(explicit, F.lit(null_text)), F.lit(default))


def computed_once(c: Column) -> Column:
    """The same value, as a generator of one row.

    Spark moves a filter on a projected column below the projection and computes the column
    once for the filter and once more for its result.  It moves no filter below a generator.
    """
    return F.explode(F.array(c))


def list_at(v: str | Column, path: str) -> Column:
    """Array of VARIANT at a path; null when there is no array there."""
    return F.try_variant_get(_col(v), path, "array<variant>")


def holds_other(v: str | Column, path: str) -> Column:
    """Something stands at the path and is not JSON null."""
    node = F.try_variant_get(_col(v), path, "variant")
    return node.isNotNull() & ~F.is_variant_null(node)


def is_object(v: str | Column) -> Column:
    return F.try_variant_get(_col(v), "$", "map<string,variant>").isNotNull()

"""Numeric measures and year-over-year change."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# What counts as the text of a number: decimal digits with single underscores between them, or a
# name of infinity or not-a-number; blanks around it are allowed.
DIGITS = r"[0-9](?:_?[0-9])*"
FINITE = rf"[+-]?(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?"
INFINITE = r"[+-]?(?i:inf|infinity)"
NOT_A_NUMBER = r"[+-]?(?i:nan)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole(pattern: str) -> str:
    return rf"^\s*(?:{pattern})\s*$"


def text_to_number(c: str | Column) -> Column:
    """Double of a text that is written as a number; null for any other text."""
    text = _col(c)
    return F.when(text.rlike(_whole(NOT_A_NUMBER)), F.lit(float("nan"))).when(
        text.rlike(_whole(f"{FINITE}|{INFINITE}")), F.replace(F.trim(text), F.lit("_"), F.lit("")).try_cast("double")
    )


def num_or_zero(c: str | Column) -> Column:
    """Number of a text as double; 0.0 for null and for the empty text.

    Any other text that is not written as a number is null; ``is_bad_number`` finds it.
    """
    text = _col(c)
    return F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(text_to_number(text))


def json_num_or_zero(c: str | Column) -> Column:
    """Number of a JSON value as double, by the kind of the value.

    Absent and JSON null, the empty text, ``false``, ``[]`` and ``{}`` are 0.0, and ``true`` is 1.0;
    a text counts as in ``num_or_zero``, and any other list or object is null.
    """
    v = _col(c)
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit(0.0))
        .when(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), F.try_variant_get(v, "$", "double"))
        .when(kind == "STRING", num_or_zero(text))
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double"))
        .when(text.isin("[]", "{}"), F.lit(0.0))
        .otherwise(F.try_variant_get(v, "$", "double"))
    )


def is_bad_number(c: str | Column) -> Column:
    """True for present, non-empty text that is not a number."""
    return num_or_zero(c).isNull()


def is_bad_json_number(c: str | Column) -> Column:
    """True for a JSON value that is neither a number nor empty."""
    return json_num_or_zero(c).isNull()


def to_millions(c: str | Column) -> Column:
    return F.round(_col(c) / 1000000, 2)


def with_base(prev: Column, change: Column) -> Column:
    return F.when(prev.isNotNull() & (prev != 0), change)


def yoy_abs(value: str | Column, prev: str | Column) -> Column:
    """Change in percent over the absolute base, unrounded; null without a non-zero base."""
    v, p = _col(value), _col(prev)
    return with_base(p, (v - p) / F.abs(p) * 100)


def yoy_signed(value: str | Column, prev: str | Column) -> Column:
    """Change in percent over the signed base, two decimals; null without a non-zero base."""
    v, p = _col(value), _col(prev)
    return with_base(p, F.round((v - p) / p * 100, 2))

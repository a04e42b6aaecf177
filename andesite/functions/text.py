"""Text cleaning and key building."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Exact texts a source publishes in place of a number.
PLACEHOLDERS = ("", "n.d.", "N.D.")

# Trade flow codes and their descriptions.
FLOW_NAMES = (("M", "Importaciones"), ("X", "Exportaciones"))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_number(c: str | Column) -> Column:
    """Text to double after deleting every character except digits, dot and minus.

    The deletion is literal: ``1,250.5`` reads as 1250.5, but an exponent loses its
    letter (``2.5E3`` reads as 2.53) and a decimal comma vanishes (``-3,2%`` is -32).
    Text that is still no number gives null.
    """
    return F.regexp_replace(_col(c), "[^0-9.-]", "").try_cast("double")


def strip_ws(c: str | Column) -> Column:
    """Remove surrounding whitespace of every kind, not blanks alone."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def is_placeholder(c: str | Column) -> Column:
    """True for null, blank and the exact no-data marks."""
    return _col(c).isNull() | strip_ws(c).isin(*PLACEHOLDERS)


def value_as_text(c: str | Column) -> Column:
    """A number as text, to be read back with ``try_cast``."""
    return _col(c).cast("string")


def compose_id(*parts: str | Column, missing: str = "") -> Column:
    """Underscore-joined key; a null part becomes ``missing`` and keeps its place."""
    return F.concat_ws("_", *[F.coalesce(_col(p).cast("string"), F.lit(missing)) for p in parts])


def flow_desc(c: str | Column, names: tuple[tuple[str, str], ...] = FLOW_NAMES) -> Column:
    """Description of a flow code, null for a code that is not listed."""
    code = _col(c)
    return F.coalesce(*[F.when(code == k, F.lit(v)) for k, v in names])

"""Side-by-side comparison of a Spark result with DuckDB's on the same files."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results have the same columns and rows, else what differs."""
    got_cols, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = _rows([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ: {wrong[:3]}" if wrong else None

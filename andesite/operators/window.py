"""Previous-row values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def with_prev(
    df: DataFrame,
    value: str,
    offset: int,
    keys: Sequence[str],
    order_by: Sequence[str],
    out: str = "prev_year_value",
    chunks: Sequence[Column] = (),
) -> DataFrame:
    """Add the value ``offset`` rows earlier among rows of equal ``keys``.

    The offset counts rows, not calendar steps: with gaps, the earlier row is an older one.

    Without ``chunks`` a key is ordered inside one task.  That fits inputs whose rows per key
    are bounded, such as a deduplicated series with one row per month.  For unbounded keys give
    ``chunks``, expressions that never decrease along ``order_by`` (say, a numeric position
    divided by a thousand, then by a million), finest first.  Chunks are ordered in parallel;
    only the first and last ``offset`` rows of each are compared across its borders, at the next
    coarser level.  The result is the same as long as ``order_by`` is a total order within a key.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    if not chunks:
        return df.withColumn(out, F.lag(value, offset).over(window))

    # The rows just before a chunk's first ones are the last ones of earlier chunks, so the
    # border rows alone hold every value that reaches across a border.
    local = Window.partitionBy(*keys, "_chunk").orderBy(*order_by)
    ranked = df.withColumn("_chunk", chunks[0]).withColumns(
        {
            "_head": F.row_number().over(local) <= offset,
            "_tail": F.lead(F.lit(1), offset).over(local).isNull(),
            out: F.lag(value, offset).over(local),
        }
    )
    inner = ranked.filter(~F.col("_head")).select(*df.columns, out)
    border = ranked.filter(F.col("_head") | F.col("_tail")).select(*df.columns, "_head")
    crossed = with_prev(
        border.withColumnRenamed("_head", f"_head{len(chunks)}"),
        value, offset, keys, order_by, out, chunks[1:],
    )
    return inner.unionByName(crossed.filter(f"_head{len(chunks)}").select(*df.columns, out))

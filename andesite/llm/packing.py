"""Packing of documents into sequences by a plan over the histogram of lengths.

Every document becomes its ids and one id 0, cut into full windows and a rest.  Lengths are counted
in bins of ``RESOLUTION`` ids.  All combinations of up to ``DEPTH`` bins that fill a window are
enumerated; non-negative least squares finds how often each is repeated so that the histogram is
used up; the repeats are rounded, and what is left is packed greedily, the longest first and then
the longest that still fits.  The histogram and the plan have at most as many entries as there are
bins and combinations of them, however many documents there are, so they are solved on the driver.

The plan numbers the places of a bin.  Tasks number their pieces of a bin in order, and counts by
task and bin turn these into global numbers, so each piece finds its place by a join with small
tables and the ids themselves are never shuffled to decide it.

Null and empty texts are the id 0 alone.  Repeated rows are packed each; a null doc_id stays null.
Further columns are ignored, an empty table gives no rows, and a very long text is cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from andesite.llm.common import stage
from andesite.llm.tokens import END_OF_DOCUMENT, TokenIds

WINDOW = 1024
RESOLUTION = 4
DEPTH = 3
PIECE = T.StructType([
    T.StructField("task", T.IntegerType()), T.StructField("bin", T.IntegerType()),
    T.StructField("rank", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])
SLOT = "bin int, first long, end long, base long, place int"


def cut_pieces(docs: DataFrame, tokenizer_path: str, window: int, resolution: int) -> DataFrame:
    """The pieces of all documents with their ids, numbered by task and bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenIds.at(tokenizer_path)
        task = TaskContext.get().partitionId()
        seen = [0] * (window // resolution + 2)
        for batch in batches:
            out: list[list] = [[] for _ in PIECE]
            size = 0
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = encoder.encode(text.as_py()) + END_OF_DOCUMENT
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    length = len(piece) // 4
                    which = -(-length // resolution)
                    row = (task, which, seen[which], doc_id.as_py(), start, length, total,
                           zlib.crc32(piece), piece)
                    seen[which] += 1
                    for column, value in zip(out, row):
                        column.append(value)
                size += total
                if size > 2_000_000:
                    yield _piece_batch(out)
                    out, size = [[] for _ in PIECE], 0
            yield _piece_batch(out)

    return docs.select("doc_id", "text").mapInArrow(run, PIECE)


def _piece_batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 6, pa.binary()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, PIECE.names)


def combinations(present: list[int], total: int, depth: int) -> list[tuple[int, ...]]:
    """The non-increasing tuples of at most ``depth`` present bins that add up to ``total``."""
    have, found = set(present), []

    def extend(parts: tuple[int, ...], rest: int) -> None:
        if rest == 0:
            found.append(parts)
        elif len(parts) == depth - 1:
            if rest in have and rest <= (parts[-1] if parts else total):
                found.append((*parts, rest))
        elif len(parts) < depth:
            for p in present:
                if p <= rest and p <= (parts[-1] if parts else total):
                    extend((*parts, p), rest - p)

    extend((), total)
    return found


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Non-negative least squares by active sets: x >= 0 with the least |ax - b|."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(3 * max(a.shape)):
        gradient = a.T @ (b - a @ x)
        gradient[passive] = -np.inf
        j = int(np.argmax(gradient)) if n else 0
        if not n or gradient[j] <= 1e-9 * scale:
            break
        passive[j] = True
        while True:
            z = np.zeros(n)
            used = a[:, passive]
            gram = used.T @ used + 1e-9 * np.eye(used.shape[1])
            z[passive] = np.linalg.solve(gram, used.T @ b)
            bad = passive & (z <= 0)
            if not bad.any():
                break
            step = np.min(x[bad] / (x[bad] - z[bad] + 1e-300))
            x += step * (z - x)
            passive &= x > 1e-12 * scale
            x[~passive] = 0
        x = z
    return x


def plan(histogram: dict[int, int], total: int, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of bins, none above ``total``, and their repeats; they use up the histogram."""
    left = dict(histogram)
    steps: list[tuple[tuple[int, ...], int]] = []

    def use(parts: tuple[int, ...], most: float) -> None:
        repeats = min([most, *(left.get(p, 0) // parts.count(p) for p in set(parts))])
        if repeats >= 1:
            steps.append((parts, int(repeats)))
            for p in parts:
                left[p] -= int(repeats)

    candidates = combinations(sorted(left), total, depth)
    rows = {p: i for i, p in enumerate(sorted(left))}
    a = np.zeros((len(rows), len(candidates)))
    for j, parts in enumerate(candidates):
        for p in parts:
            a[rows[p], j] += 1
    repeats = nnls(a, np.array([left[p] for p in rows], float))
    for j in sorted(np.flatnonzero(repeats >= 0.5), key=lambda j: (-repeats[j], candidates[j])):
        use(candidates[j], np.rint(repeats[j]))
    while any(left.values()):
        bins = sorted((p for p, n in left.items() if n), reverse=True)
        parts, room, taken = [], total, dict.fromkeys(bins, 0)
        for p in bins:
            while p <= room and taken[p] < left[p]:
                parts.append(p)
                taken[p] += 1
                room -= p
        use(tuple(parts), np.inf)
    return steps


def slots(steps: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of a bin go: numbers ``first`` to ``end``, sequences from ``base`` on."""
    used: dict[int, int] = {}
    found, base = [], 0
    for parts, repeats in steps:
        for place, p in enumerate(parts):
            first = used.get(p, 0)
            used[p] = first + repeats
            found.append((p, first, first + repeats, base, place))
        base += repeats
    return found


def pack(
    docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, resolution: int = RESOLUTION
) -> DataFrame:
    """Pieces with their ids, the sequence each goes to and its offset there, gapless from 0."""
    if window % resolution:
        raise ValueError("the window must be a multiple of the resolution")
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    pieces = stage(cut_pieces(docs, path, window, resolution), "pieces")
    counts = pieces.groupBy("task", "bin").count()
    before = F.sum("count").over(
        Window.partitionBy("bin").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = counts.select("task", "bin", F.coalesce(before, F.lit(0)).alias("shift"))
    histogram = {
        r["bin"]: r["n"] for r in counts.groupBy("bin").agg(F.sum("count").alias("n")).collect()
    }
    # At most one row per bin and step of the plan, whatever the number of documents.
    places = docs.sparkSession.createDataFrame(slots(plan(histogram, window // resolution)), SLOT)
    number = F.col("rank") + F.col("shift")
    placed = (
        pieces.join(shifts, ["task", "bin"])
        .withColumn("number", number)
        .join(F.broadcast(places), "bin")
        .filter("number >= first AND number < end")
        .withColumn("sequence_id", F.col("base") + F.col("number") - F.col("first"))
    )
    earlier = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"), "ids",
    )

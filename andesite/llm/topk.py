"""Exact top-k inner-product search with a uniform threshold, in three phases.

Components are turned into ``floor(256 * x)``; the score of a query and a vector is the integer
inner product, the sum of ``LISTS`` local scores over as many ranges of components.

1. Every task gathers, for each query and range, the vectors with the highest local scores, and
   their whole scores.  The k-th best whole score of a query is a cutoff that its result reaches.
2. The cutoff is broadcast.  A vector that reaches it has a local score of at least the cutoff
   divided by the number of ranges, so the entries from there on are sufficient.
3. Entries that cannot reach the cutoff, even if every range not seen is just below the threshold,
   are dropped; the others are resolved to whole scores, and the best k by score, then by smaller
   vec_id, remain.

Queries are handled in waves of about ``WAVE``, so what is broadcast has a fixed size; the vectors
are read twice per wave and never shuffled.

Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with
a null vec_id.  Only vectors of a query's length are candidates.  A repeated vec_id is one query (the
smallest of its vectors) and as many candidates, but none for itself.  Further columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

K = 5
LISTS = 2
WAVE = 16_384
# Scores held at once: queries times vectors of a strip.
STRIP = 2_000_000
ENTRY = "query_id bigint, vec_id bigint, score bigint"
ARROW_ENTRY = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantized(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and components of the vectors that take part, by length of vector."""
    ids, lists = batch.column("vec_id"), batch.column("embedding")
    good = np.asarray(ids.is_valid()) & np.asarray(lists.is_valid())
    lengths = np.where(good, np.asarray(lists.value_lengths().fill_null(0)), 0)
    ids = np.asarray(ids.fill_null(0)).astype(np.int64)
    values = np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    sizes = np.asarray(lists.value_lengths().fill_null(0))
    starts = np.cumsum(sizes) - sizes
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        matrix = values[starts[rows][:, None] + np.arange(n)]
        finite = np.isfinite(matrix).all(1)
        if finite.any():
            yield ids[rows[finite]], np.floor(256 * matrix[finite])


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, exact: in floats while these hold them, else in whole numbers."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= 2**53:
        whole = lambda x: np.array([[int(v) for v in row] for row in x], object)
        return whole(a) @ whole(b).T
    return a @ b.T


class Wave:
    """Queries by length of vector, ids ascending, and a cutoff for each (None: none yet)."""

    def __init__(self, rows: list, cutoffs: dict[int, int] | None = None):
        batch = pa.RecordBatch.from_pydict(
            {"vec_id": pa.array([r[0] for r in rows], pa.int64()),
             "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float64()))})
        self.groups = {}
        for ids, matrix in quantized(batch):
            order = np.argsort(ids)
            self.groups[matrix.shape[1]] = (ids[order], matrix[order])
        self.cutoffs = cutoffs

    def bounds(self, ids: np.ndarray) -> np.ndarray:
        return np.array([self.cutoffs.get(int(i), -(2**62)) for i in ids])


def local_scores(queries: np.ndarray, vectors: np.ndarray) -> list[np.ndarray]:
    ranges = np.array_split(np.arange(queries.shape[1]), min(LISTS, queries.shape[1]))
    return [multiply(queries[:, r], vectors[:, r]) for r in ranges]


def strips(batch: pa.RecordBatch, wave: Wave) -> Iterator[tuple]:
    """Query ids, vector ids, local scores, and which pairs are a query and itself."""
    for ids, vectors in quantized(batch):
        if vectors.shape[1] in wave.groups:
            query_ids, queries = wave.groups[vectors.shape[1]]
            step = max(1, STRIP // len(query_ids))
            for at in range(0, len(ids), step):
                own = ids[at : at + step]
                yield query_ids, own, local_scores(queries, vectors[at : at + step]), query_ids[:, None] == own


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple:
    """The best k entries of each query, ties to the smaller vec_id."""
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], vec[keep], score[keep]


def _entries(query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x.astype(np.int64), pa.int64()) for x in (query, vec, score)], schema=ARROW_ENTRY)


def local_lists(batches: Iterator[pa.RecordBatch], wave: Wave, k: int) -> Iterator[pa.RecordBatch]:
    """Phase 1: the whole scores of the k best of each query and range among a task's vectors."""
    held: dict[tuple[int, int], list] = {}  # by length and range: query, local score, vec_id, whole score
    for batch in batches:
        for query_ids, ids, local, same in strips(batch, wave):
            whole = sum(local)
            for j, scores in enumerate(local):
                scores = np.where(same, -np.inf, scores.astype(np.float64))
                n = min(k, scores.shape[1])
                top = np.argpartition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n :]
                rows = np.arange(len(query_ids))[:, None]
                new = (np.where(same[rows, top], -np.inf, scores[rows, top]), ids[top], whole[rows, top])
                key = (id(query_ids), j)
                if key in held:
                    old = held[key][1]
                    new = tuple(np.concatenate(x, axis=1) for x in zip(old, new))
                    n = min(k, new[0].shape[1])
                    pick = np.argpartition(new[0], new[0].shape[1] - n, axis=1)[:, new[0].shape[1] - n :]
                    new = tuple(x[rows, pick] for x in new)
                held[key] = (query_ids, new)
    for query_ids, (scores, vec, whole) in held.values():
        real = scores > -np.inf
        yield _entries(np.broadcast_to(query_ids[:, None], real.shape)[real], vec[real], whole[real])


def sufficient_entries(batches: Iterator[pa.RecordBatch], wave: Wave, k: int) -> Iterator[pa.RecordBatch]:
    """Phases 2 and 3: entries at the threshold, pruned by what they can reach, resolved."""
    held: list[tuple] = []
    for batch in batches:
        for query_ids, ids, local, same in strips(batch, wave):
            cutoff = wave.bounds(query_ids)
            threshold = -((-cutoff) // len(local))[:, None]
            seen = [scores >= threshold for scores in local]
            row, column = np.nonzero(np.logical_or.reduce(seen) & ~same)
            reach = np.zeros(len(row))
            for scores, at in zip(local, seen):
                reach += np.where(at[row, column], scores[row, column].astype(np.float64), threshold[row, 0] - 1)
            able = reach >= cutoff[row]
            row, column = row[able], column[able]
            score = sum(scores[row, column] for scores in local)
            reached = score >= cutoff[row]
            held.append((query_ids[row[reached]], ids[column[reached]], score[reached]))
            if sum(len(h[0]) for h in held) > STRIP // 4:
                held = [best(*map(np.concatenate, zip(*held)), k)]
    if held:
        yield _entries(*best(*map(np.concatenate, zip(*held)), k))


def search(vectors: DataFrame, is_query: Column, k: int = K, wave: int = WAVE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other vectors for each query."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding").filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    queries = rows.filter(is_query)
    waves = max(1, -(-queries.count() // wave))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = None
    for number in range(waves):
        own = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == number)
        # A wave has a fixed size, so it may pass through the driver.
        asked = own.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).collect()
        first = spark.sparkContext.broadcast(Wave(asked))
        gathered = rows.mapInArrow(lambda b, w=first: local_lists(b, w.value, k), ENTRY).distinct()
        ranked = gathered.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") == k)
        cutoffs = {r[0]: r[1] for r in ranked.select("query_id", "score").collect()}
        second = spark.sparkContext.broadcast(Wave(asked, cutoffs))
        entries = rows.mapInArrow(lambda b, w=second: sufficient_entries(b, w.value, k), ENTRY)
        found = entries if found is None else found.union(entries)
    return (
        found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


SEARCH_SQL = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {K}
"""

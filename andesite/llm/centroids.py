"""Centroid clustering of vectors in Spark's own expressions.

Components become whole numbers ``floor(256 * x)``.  The first centroids are the ``k`` vectors with the
smallest hash of their id; each round assigns every vector to the nearest centroid and moves each
centroid to the floor of its vectors' mean, component by component; then vectors are assigned once more.

1. The vectors are made whole once and written to the shared folder as arrays.
2. A round's centroids are one literal array of arrays.  ``zip_with`` and ``aggregate`` give the squared
   distance to each, and ``array_min`` over (distance, number) chooses the nearest, ties to the smaller
   number.
3. One aggregation adds up the components of each cluster, a column per component, reduced in each
   task before the shuffle: what is shuffled and brought to the driver are ``k`` rows of sums, whatever
   the number of vectors and however full one cluster is.  Sums and floors are exact.

Vectors that are null, of another length, or hold null or non-finite components take no part.  Repeated
rows are as many vectors; of vectors with the same id and hash the smaller array is the earlier
centroid, and a null id comes after all others.  With fewer than ``k`` vectors there are as many
centroids.  Further columns are ignored; an empty table gives no rows.  Sums, components and distances
are 64-bit: a component of 2^55 or more, or a distance beyond 64 bits, raises.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from andesite.llm.common import stage

K, ROUNDS, DIMENSIONS, SEED = 40, 5, 64, "2:"
RESULT = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
          "centroid_sha256 string")


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v): the vectors that take part, as arrays of whole numbers."""
    doubles = F.col("embedding").cast("array<double>")
    unfit = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.filter((F.size("embedding") == dimensions) & ~unfit)
    return kept.select("vec_id", F.transform(doubles, lambda x: F.floor(256 * x)).alias("v"))


def first_centroids(vectors: DataFrame, k: int = K, seed: str = SEED) -> list[list[int]]:
    """The vectors with the smallest hash of their id, in that order."""
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(digest.asc_nulls_last(), "v").limit(k).select("v").collect()
    return [list(r.v) for r in rows]


def literal(centroids: list[list[int]]) -> Column:
    """The centroids as one constant array of arrays."""
    rows = (f"array({', '.join(f'{x}L' for x in c)})" for c in centroids)
    return F.expr(f"array({', '.join(rows)})")


def nearest(centroids: list[list[int]], vector: str = "v") -> Column:
    """(distance, cluster) of the nearest centroid."""

    def distance(c: Column) -> Column:
        squares = F.zip_with(F.col(vector), c, lambda x, y: (x - y) * (x - y))
        return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, x: total + x)

    return F.array_min(F.transform(
        literal(centroids), lambda c, i: F.struct(distance(c).alias("distance"), i.alias("cluster"))))


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round."""
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"sum{i}") for i in range(len(centroids[0]))]
    assigned = vectors.select("v", nearest(centroids)["cluster"].alias("cluster"))
    new = list(centroids)
    for cluster, n, *totals in assigned.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        new[cluster] = [total // n for total in totals]
    return new


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: str = SEED
) -> DataFrame:
    """Each vector's cluster and distance, the inertia of its cluster and of all, its centroid's hash."""
    whole = stage(whole_vectors(vectors, dimensions), "vectors")
    centroids = first_centroids(whole, k, seed)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], RESULT)
    for _ in range(rounds):
        centroids = moved(whole, centroids)
    near = whole.select("vec_id", nearest(centroids).alias("near"))
    assigned = stage(near.select("vec_id", "near.cluster", "near.distance"), "assigned")
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    own = F.expr(f"array({', '.join(f'{inertia.get(i, 0)}L' for i in range(len(centroids)))})")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return assigned.select(
        "vec_id", "cluster", "distance",
        F.get(own, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"),
    )


def _assigned_sql(n: int, cluster_of: str) -> str:
    return f"""
a{n} AS MATERIALIZED (
  SELECT r, v.vec_id, v.v, min({{'distance': list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
                         'cluster': c.cluster}}) AS near
  FROM vectors v, {cluster_of} c GROUP BY ALL
)"""


def _moved_sql(n: int) -> str:
    """The floor of a mean is exact in whole numbers: ``//`` rounds towards zero."""
    return f"""
s{n} AS MATERIALIZED (
  SELECT cluster, i, (total - ((total % n) + n) % n) // n AS x
  FROM (SELECT near.cluster AS cluster, i, sum(v[i]) AS total, count(*) AS n
        FROM (SELECT near, v, unnest(range(1, {DIMENSIONS + 1})) AS i FROM a{n}) GROUP BY ALL)
), c{n + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v
  FROM c{n} c LEFT JOIN (SELECT cluster, list(CAST(x AS BIGINT) ORDER BY i) AS v FROM s{n} GROUP BY cluster) m
  ON c.cluster = m.cluster
)"""


CLUSTER_SQL = f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMENSIONS}
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}' || vec_id) NULLS LAST, v) - 1 AS INTEGER) AS cluster, v
  FROM vectors QUALIFY cluster < {K}
), {", ".join(_assigned_sql(n, f"c{n}") + "," + _moved_sql(n) for n in range(ROUNDS))},
{_assigned_sql(ROUNDS, f"c{ROUNDS}")}
SELECT vec_id, near.cluster AS cluster, CAST(near.distance AS BIGINT) AS distance,
       CAST(sum(near.distance) OVER (PARTITION BY near.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(near.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} c ON near.cluster = c.cluster
"""

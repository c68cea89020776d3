"""Clusters of embedding vectors around integer centroids, filtered by n-simplex projection.

Vectors are rounded down to integers, so distances, sums and means are exact.

A few pivots span a simplex. The distances of a vector to the pivots place it
as an apex over that simplex: coordinates within the pivots' subspace and a
height above it. Two vectors are at least as far apart as their apexes with
both heights on one side, at most as far as with the heights on opposite
sides. The coordinates of every vector are computed once and kept next to it;
centroids get theirs in each round. A centroid whose lower bound lies above
the smallest upper bound can't be the nearest; the others are compared by
exact integer distance.

A round reads the kept table and leaves one row of sums a cluster and task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asphalt.session import materialise

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
PIVOTS = 6
ROWS_AT_ONCE = 4_096
# Rounding: a coordinate's error grows by the inverse of a pivot's height with each pivot and with the distance from the
# simplex. With heights of at least FLAT and vectors within FAR extents it stays below SLACK of the squared size.
FLAT = 0.05
FAR = 1_000.0
SLACK = 1e-6


def largest(dimensions: int) -> int:
    """Size of components up to which squared distances stay within a signed long."""
    return math.isqrt((1 << 62) // dimensions) // 2


def quantised(vectors: DataFrame, id_column: str, vector_column: str, dimensions: int, scale: float) -> DataFrame:
    """Vectors of the right length with finite components only, as integers: (id, vector array<int>).

    A component too large for exact distances stops the run with a message.
    """
    v, steps, bound = F.col(vector_column), F.lit(float(scale)), largest(dimensions)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    kept = vectors.where((F.size(v) == dimensions) & finite).select(F.col(id_column).alias("id"), v.cast("array<double>").alias("v"))
    refused = F.raise_error(F.lit(f"a component beyond {bound} steps of 1/{scale}: use a smaller scale")).cast("array<int>")
    whole = F.transform("v", lambda x: F.floor(steps * x).cast("int"))
    return kept.select("id", F.when(F.exists("v", lambda x: F.abs(steps * x) >= bound), refused).otherwise(whole).alias("vector"))


@dataclass(frozen=True)
class Simplex:
    """Pivots and what places vectors over the simplex that they span."""

    pivots: np.ndarray  # integers, one row a pivot
    base: np.ndarray  # lower triangular: coordinates of the pivots, the first at the origin
    extent: float  # largest squared distance between pivots

    @classmethod
    def over(cls, candidates: np.ndarray, pivots: int) -> Simplex:
        """The simplex of up to ``pivots`` candidates, each the one highest above those before it."""
        first = candidates[0]
        offsets = (candidates - first).astype(np.float64)
        chosen, axes = [0], np.zeros((0, candidates.shape[1]))
        for _ in range(pivots - 1):
            heights = np.sqrt(((offsets - offsets @ axes.T @ axes) ** 2).sum(axis=1))
            top = int(heights.argmax())
            if heights[top] == 0 or heights[top] < FLAT * np.sqrt((offsets ** 2).sum(axis=1).max()):
                break
            axis = offsets[top] - offsets[top] @ axes.T @ axes
            axis -= axis @ axes.T @ axes
            axes = np.vstack([axes, axis / np.sqrt((axis ** 2).sum())])
            chosen.append(top)
        own = candidates[chosen]
        return cls(own, offsets[chosen[1:]] @ axes.T, float(((own[:, None] - own[None]) ** 2).sum(axis=2).max()))

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Apex coordinates of integer vectors from their distances to the pivots, the height last."""
        squared = np.stack([((vectors - p) ** 2).sum(axis=1) for p in self.pivots], axis=1).astype(np.float64)
        inside = np.zeros((len(vectors), len(self.base)))
        for i, vertex in enumerate(self.base):
            known = inside[:, :i] @ vertex[:i]
            inside[:, i] = ((squared[:, 0] - squared[:, i + 1] + vertex @ vertex) / 2 - known) / vertex[i]
        height = np.sqrt(np.maximum(squared[:, 0] - (inside ** 2).sum(axis=1), 0.0))
        return np.hstack([inside, height[:, None]])

    def possible(self, apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Which centroids may be nearest: a row a vector, a column a centroid."""
        own = self.apexes(centroids)
        inside = sum((apexes[:, i, None] - own[None, :, i]) ** 2 for i in range(own.shape[1] - 1)) + np.zeros((len(apexes), len(own)))
        lower = inside + (apexes[:, -1, None] - own[None, :, -1]) ** 2
        upper = inside + (apexes[:, -1, None] + own[None, :, -1]) ** 2
        size = self.extent + (apexes ** 2).sum(axis=1) + (own ** 2).sum(axis=1).max() + 1
        far = size > FAR ** 2 * (self.extent + 1)
        return (lower <= upper.min(axis=1, keepdims=True) + SLACK * size[:, None]) | far[:, None]

    def nearest(self, vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each vector, the first one on a tie, and its squared distance."""
        best = np.full(len(vectors), np.iinfo(np.int64).max, dtype=np.int64)
        cluster = np.zeros(len(vectors), dtype=np.int32)
        possible = self.possible(apexes, centroids)
        for c, centroid in enumerate(centroids):
            rows = np.flatnonzero(possible[:, c])
            squared = ((vectors[rows] - centroid) ** 2).sum(axis=1)
            closer = squared < best[rows]
            best[rows[closer]] = squared[closer]
            cluster[rows[closer]] = c
        return cluster, best


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(kind)


def _slices(batches: Iterator[pa.RecordBatch], width: int, axes: int):
    """Bounded pieces of the kept table: (ids, vectors, apexes)."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_AT_ONCE):
            piece = whole.slice(at, ROWS_AT_ONCE)
            yield piece.column(0), _matrix(piece.column(1), width, np.int64), _matrix(piece.column(2), axes, np.float64)


def placed(whole: DataFrame, simplex: Simplex) -> DataFrame:
    """Integer vectors with their apex coordinates: (id, vector, apex)."""
    width = simplex.pivots.shape[1]

    def apexes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simplex.apexes(_matrix(batch.slice(at, ROWS_AT_ONCE).column(1), width, np.int64))
                     for at in range(0, batch.num_rows, ROWS_AT_ONCE)]
            rows = np.vstack(found) if found else np.zeros((0, len(simplex.pivots)))
            apex = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), apex], ["id", "vector", "apex"])

    return whole.mapInArrow(apexes, f"id {dict(whole.dtypes)['id']}, vector array<int>, apex array<double>")


def moved(rows: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floors of the means of their vectors; those without any stay."""
    clusters, width = centroids.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(clusters, dtype=np.int64), np.zeros((clusters, width), dtype=np.int64)
        for _, vectors, apexes in _slices(batches, width, len(simplex.pivots)):
            cluster, _ = simplex.nearest(vectors, apexes, centroids)
            order = np.argsort(cluster, kind="stable")
            present, first = np.unique(cluster[order], return_index=True)
            sums[present] += np.add.reduceat(vectors[order], first, axis=0)
            n += np.bincount(cluster, minlength=clusters)
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), pa.array(n[own]), pa.array(list(sums[own]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    partial = rows.mapInArrow(totals, "cluster int, n long, sums array<long>")
    exact = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = centroids.copy()
    for r in partial.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect():  # one row a cluster
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return out


def assigned(rows: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    """Nearest centroid of every vector: (id, cluster, distance)."""
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors, apexes in _slices(batches, centroids.shape[1], len(simplex.pivots)):
            cluster, distance = simplex.nearest(vectors, apexes, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array(distance)], ["id", "cluster", "distance"])

    return rows.mapInArrow(nearest, f"id {dict(rows.dtypes)['id']}, cluster int, distance long")


def digest(centroid) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def clustered(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", dimensions: int = DIMENSIONS,
    scale: float = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, pivots: int = PIVOTS,
) -> DataFrame:
    """Every kept vector's cluster: (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Kept are vectors of ``dimensions`` components, none of them null or not
    finite; others have no row. The first centroids are the vectors whose hash
    of seed and id is smallest, those of equal ids by their components; with
    fewer vectors there are fewer clusters. A null id hashes as empty text.
    Ties go to the smaller cluster number. Repeated rows each give a row. Other
    columns are ignored. An empty table gives an empty result.
    """
    whole = quantised(vectors, id_column, vector_column, dimensions, scale)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = whole.select("vector", key.alias("key")).orderBy("key", "vector").limit(clusters).collect()
    if not first:
        empty = whole.select(F.col("id").alias("vec_id"))
        numbers = {n: F.lit(0).cast(t) for n, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"))}
        return empty.withColumns({**numbers, "centroid_sha256": F.lit("")})
    centroids = np.array([r["vector"] for r in first], dtype=np.int64)
    simplex = Simplex.over(centroids, pivots)
    rows = materialise(placed(whole, simplex))
    for _ in range(rounds):
        centroids = moved(rows, simplex, centroids)
    found = materialise(assigned(rows, simplex, centroids))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    names = found.sparkSession.createDataFrame([(c, digest(v)) for c, v in enumerate(centroids)], "number int, centroid_sha256 string")
    # One row a cluster.
    table = sums.join(F.broadcast(names), F.col("cluster") == F.col("number")).select(
        F.col("cluster").alias("number"), F.col("own").cast("long").alias("cluster_inertia"), "centroid_sha256")
    total = sums.agg(F.sum("own").cast("long").alias("inertia")).scalar()
    return found.join(F.broadcast(table), F.col("cluster") == F.col("number")).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid_sha256")


def _round_sql(n: int) -> str:
    """One assignment and move in SQL: a<n> from centroids c<n>, then c<n + 1>."""
    return f"""
a{n} AS MATERIALIZED (
  SELECT vec_id, id, min_by(number, (d, number)) AS number, min(d) AS d FROM (
    SELECT v.vec_id, v.id, number, sum((x - y) * (x - y)) AS d FROM parts v JOIN c{n} USING (place) GROUP BY v.vec_id, v.id, number)
  GROUP BY vec_id, id),
m{n} AS MATERIALIZED (
  SELECT number, place, sum(x) AS s, count(*) AS n FROM parts JOIN a{n} USING (vec_id, id) GROUP BY number, place),
c{n + 1} AS MATERIALIZED (
  SELECT c.number, c.place, CASE WHEN n IS NULL THEN y ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS y
  FROM c{n} c LEFT JOIN m{n} m ON c.number = m.number AND c.place = m.place)"""


ORACLE = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS id, list_transform(embedding, lambda x: CAST(floor({SCALE}::DOUBLE * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, id, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM kept),
firsts AS (
  SELECT v, row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR)), v) - 1 AS number FROM kept
  QUALIFY number < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT number, unnest(v) AS y, generate_subscripts(v, 1) AS place FROM firsts),
{",".join(_round_sql(n) for n in range(ROUNDS + 1))},
names AS (SELECT number, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY number)
SELECT vec_id, CAST(number AS INT) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY number) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN names USING (number)
"""

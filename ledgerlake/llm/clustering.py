"""Centroid clustering on integer vectors, pruned by Ptolemaic pivots.

For a vector x, a centroid c and two pivots p, q, Ptolemy's inequality gives
``d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)``. The pivots are fixed, so the distances of
the vectors to them are computed once and written beside the vectors; a round only computes those of its
few centroids. The bounds are rounded down by more than their floating point error, and every centroid
whose bound doesn't exceed the best exact distance is checked in integers, so that the pivots decide
how much is computed and never what comes out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut, table

DIMENSIONS, CLUSTERS, ROUNDS, SEED = 64, 8, 10, "3"
#: Components are floor(SCALE * x).
SCALE = 1024
#: Pivots are chosen among the SAMPLE vectors with the smallest hashes; they only affect the speed.
PIVOTS, SAMPLE = 8, 256
#: Integer components stay below this, so that squared distances fit a long.
LIMIT = 1 << 27
EPS = float(np.finfo(float).eps)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    gap = x - y
    return np.einsum("...i,...i->...", gap, gap)


@dataclass(frozen=True)
class Pivots:
    points: np.ndarray

    @classmethod
    def among(cls, sample: np.ndarray, n: int) -> Pivots:
        """The first vector, then again and again the one farthest from those taken, as long as it differs."""
        taken = sample[:1]
        while 0 < len(taken) < n:
            far = squared(sample[:, None], taken[None]).min(axis=1)
            if not far.max():
                break
            taken = np.concatenate([taken, sample[[far.argmax()]]])
        return cls(taken)

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(squared(x[:, None], self.points[None]).astype(float)) if len(self.points) else np.zeros((len(x), 0))

    def squared_bounds(self, to_x: np.ndarray, to_c: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances (vectors by centroids) from both sides' pivot distances."""
        best = np.zeros((len(to_x), len(to_c)))
        between = self.distances(self.points)
        for p, q in combinations(range(len(self.points)), 2):
            one, other = to_x[:, p, None] * to_c[None, :, q], to_x[:, q, None] * to_c[None, :, p]
            # each product is off by a few EPS of itself
            np.maximum(best, (np.abs(one - other) - 16 * EPS * (one + other)) / between[p, q], out=best)
        return best * best * (1 - 16 * EPS)


def nearest(x: np.ndarray, to_x: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and squared distance of every vector (ties: smaller number), and the exact distances computed."""
    bounds = pivots.squared_bounds(to_x, pivots.distances(centroids))
    first = bounds.argmin(axis=1)
    cluster, best, checked = first.copy(), squared(x, centroids[first]), len(x)
    for k in range(len(centroids)):
        rows = np.flatnonzero((bounds[:, k] <= best * (1 + 4 * EPS)) & (first != k))
        found = squared(x[rows], centroids[k])
        better = (found < best[rows]) | ((found == best[rows]) & (k < cluster[rows]))
        cluster[rows[better]], best[rows[better]] = k, found[better]
        checked += len(rows)
    return cluster, best, checked


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, ints: the vectors of exactly ``dimensions`` components, none null or non-finite."""
    real = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    small = F.forall(real, lambda x: F.abs(x) * SCALE < LIMIT)
    ints = F.transform(real, lambda x: F.floor(x * SCALE).cast("int"))
    checked = F.when(small, ints).otherwise(F.raise_error(F.lit(f"a component of {LIMIT // SCALE} or more: its squared distance fits no long")))
    return vectors.where((F.size("embedding") == dimensions) & finite).select(F.col("vec_id").cast("long").alias("vec_id"), checked.alias("ints"))


def _assigned(rows: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """vec_id, cluster, distance, checked (exact distances in the row's batch, on its first row)."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, to_x = _matrix(batch["ints"], np.int64, centroids.shape[1]), _matrix(batch["far"], float, len(pivots.points))
            cluster, best, checked = nearest(x, to_x, centroids, pivots)
            count = np.zeros(len(x), np.int64)
            count[:1] = checked
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(cluster.astype(np.int32)), pa.array(best), pa.array(count)], ["vec_id", "cluster", "distance", "checked"])

    return rows.mapInArrow(assign, "vec_id long, cluster int, distance long, checked long")


def _moved(rows: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """The centroids after one round. A task sends one sum per cluster and component."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            x, to_x = _matrix(batch["ints"], np.int64, centroids.shape[1]), _matrix(batch["far"], float, len(pivots.points))
            cluster, _, _ = nearest(x, to_x, centroids, pivots)
            np.add.at(total, cluster, x)
            count += np.bincount(cluster, minlength=len(centroids))
        k, i = np.indices(centroids.shape, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), pa.array(i.ravel()), pa.array(total.ravel()), pa.array(np.repeat(count, centroids.shape[1]))], ["k", "i", "total", "n"])

    parts = rows.select("ints", "far").mapInArrow(sums, "k int, i int, total long, n long")
    moved = centroids.copy()
    for r in parts.groupBy("k", "i").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n")).collect():
        if r.n:
            moved[r.k, r.i] = int(r.total) // r.n
    return moved


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: str = SEED, n_pivots: int = PIVOTS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, checked for every kept vector.

    Kept are vectors of exactly ``dimensions`` components, none null or non-finite; components become
    floor(1024 * x). Fewer kept vectors than ``clusters`` give as many centroids as vectors; none, or an
    empty table, an empty result. A null id counts as the text "null" in the hash that picks the first
    centroids; rows with one id are ordered by their components. Repeated rows are rows of their own, and
    other columns are ignored. A component of 131,072 or more raises, as its squared distance fits no
    long. ``checked`` counts exact distances: its sum is what the bounds left to do in the last round.

    The driver holds the centroids, the pivots and their ``SAMPLE`` candidates, and nothing that grows.
    """
    kept = kept_vectors(vectors, dimensions)
    at = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    head = kept.select("ints", at.alias("at")).orderBy("at", "ints").limit(max(SAMPLE, clusters)).collect()
    sample = np.array([r.ints for r in head], np.int64).reshape(len(head), dimensions)
    pivots, centroids = Pivots.among(sample, n_pivots), sample[:clusters]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = pivots.distances(_matrix(batch["ints"], np.int64, dimensions))
            offsets = np.arange(0, far.size + 1, far.shape[1] or 1, dtype=np.int32)[: len(far) + 1]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["ints"], pa.ListArray.from_arrays(offsets, far.ravel())], ["vec_id", "ints", "far"])

    rows = cut(kept.mapInArrow(measured, "vec_id long, ints array<int>, far array<double>"))
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(rows, centroids, pivots)
    last = cut(_assigned(rows, centroids, pivots))
    return _with_totals(last, centroids)


def _with_totals(last: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds cluster_inertia, inertia and centroid_sha256, one value per cluster."""
    sums = {r.cluster: int(r.total) for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def per_cluster(values: Sequence, kind: str):
        listed = F.array(*map(F.lit, values)).cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")
        return F.get(listed, F.col("cluster"))

    return last.select(
        "vec_id", "cluster", "distance",
        per_cluster([sums.get(k, 0) for k in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        per_cluster(sha, "string").alias("centroid_sha256"),
        "checked",
    )


def _sql() -> str:
    """The same rounds, each a common table expression."""
    nearest_of = """(
  SELECT rid, vec_id, v, k, d FROM (
    SELECT x.rid, x.vec_id, x.v, c.k, list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept x, {c} c
  ) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1
)"""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {DIMENSIONS}
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, 'null')), v) - 1 AS k, v FROM kept QUALIFY k < {CLUSTERS}
)""",
    ]
    for r in range(ROUNDS):
        parts.append(f"a{r} AS MATERIALIZED {nearest_of.format(c=f'c{r}')}")
        parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT k, list((s - (s % n + n) % n) // n ORDER BY i) AS v FROM (
      SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range({DIMENSIONS})) AS i FROM a{r}) GROUP BY k, i
    ) GROUP BY k
  ) m ON m.k = c.k
)""")
    return f"""WITH {', '.join(parts)}, last AS MATERIALIZED {nearest_of.format(c=f'c{ROUNDS}')}
SELECT vec_id, last.k::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY last.k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM last JOIN c{ROUNDS} c ON c.k = last.k"""


SQL = _sql()


def op11_ptolemaic_clusters(spark, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings")).drop("checked")

"""Centroid clustering of integer vectors, with Ptolemaic pivots to skip distances.

Vectors become integers (floor of ``SCALE`` times a component). The starting centroids
are the vectors with the smallest hashes; the first of them double as fixed pivots. Each
vector's distances to the pivots are worked out once and kept beside it in a written
table. In a round, Ptolemy's inequality over a fixed pair of pivots (p, q) bounds the
distance of vector x and centroid c from below without touching their components:

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)

The bounds are rounded down by more than the floating-point error of their few steps
(``SLACK``). A centroid whose bound lies above the best distance so far is skipped; the
survivors are checked exactly, in integers. So the result is that of a full search.

Every round is one pass of tasks over the table: each task sends one count and one sum
of components a centroid (16 rows of 64 numbers), Spark adds them up, and the driver
sees 16 rows. A cluster that holds a third of all vectors costs no more than another.

Defined cases: a vector with another number of components, or with one that is null, NaN
or infinite, is left out; fewer vectors than centroids make fewer centroids, none make no
rows; a missing vec_id is hashed as the empty text; repeated ids and rows are vectors of
their own, and equal hashes are ordered by the vectors; of equally near centroids the
first one counts; components beyond 32 bits are taken as the largest of 32 bits, and a distance or
sum that no long can hold as the largest long; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ship

SIZE, SCALE, K, ROUNDS = 64, 64.0, 16, 3
PIVOTS = 8                      # the first ones of the starting centroids
SLACK = 1e-12                   # relative; a bound takes about ten steps, each rounded by 1.1e-16
PLAIN = 1 << 20                 # components up to this have products and sums below 2**53: doubles hold them exactly
MOST, MOST_LONG = 2 ** 31 - 1, 2 ** 63 - 1


def kept_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = SIZE) -> DataFrame:
    """vec_id, v: the usable vectors as integers."""
    v, most = embeddings[vector_col], F.lit(float(MOST))
    usable = (F.size(v) == size) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.greatest(-most, F.least(most, x.cast("double") * SCALE))).cast("int"))
    return embeddings.where(usable).select(embeddings[id_col].cast("long").alias("vec_id"), whole.alias("v"))


def starting_centroids(vectors: DataFrame, k: int = K) -> list[list[int]]:
    """The vectors with the smallest hashes: a heap of ``k`` rows a task."""
    name = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in vectors.orderBy(name, "v").limit(k).select("v").collect()]


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to the point ``c``: doubles where they hold them, else Python integers."""
    if max(np.abs(x).max(initial=0), np.abs(c).max()) <= PLAIN:
        d = x.astype(np.float64) - c
        return np.einsum("ij,ij->i", d, d)
    d = x.astype(object) - c.astype(object)
    return (d * d).sum(axis=1)


def _roots(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(x, p).astype(np.float64) for p in points], axis=1))


class Pivots:
    """Fixed pivots and the pairs of neighbours among them that lie apart."""

    def __init__(self, points: list[list[int]]):
        self.points = np.array(points, np.int64)
        self.apart = _roots(self.points, self.points)
        ring = [(p, (p + 1) % len(points)) for p in range(len(points))]
        self.pairs = [(p, q) for p, q in dict.fromkeys(tuple(sorted(x)) for x in ring) if self.apart[p, q] > 0]

    def distances(self, x: np.ndarray) -> np.ndarray:
        return _roots(x, self.points)

    def bounds(self, of_x: np.ndarray, of_c: np.ndarray) -> np.ndarray:
        """What the squared distances of all x (rows) and c (columns) reach at least, from their distances to the pivots."""
        best = np.zeros((len(of_x), len(of_c)))
        for p, q in self.pairs:
            a, b = np.outer(of_x[:, p], of_c[:, q]), np.outer(of_x[:, q], of_c[:, p])
            np.maximum(best, (np.abs(a - b) - SLACK * (a + b)) / self.apart[p, q], out=best)
        return best * best * (1 - SLACK)


def nearest(x: np.ndarray, of_x: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row of ``x``, the exact squared distance, and how many distances were worked out."""
    bounds = pivots.bounds(of_x, pivots.distances(centroids))
    guess = bounds.argmin(axis=1)
    cluster, best = guess.copy(), np.zeros(len(x), object if max(np.abs(x).max(initial=0), np.abs(centroids).max()) > PLAIN else np.float64)
    for j in np.unique(guess):
        rows = np.flatnonzero(guess == j)
        best[rows] = squared(x[rows], centroids[j])
    checked = len(x)
    for j, c in enumerate(centroids):
        rows = np.flatnonzero((guess != j) & (bounds[:, j] <= best.astype(np.float64)))
        if not len(rows):
            continue
        d = squared(x[rows], c)
        checked += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (j < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = d[better], j
    return cluster, best, checked


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def with_pivot_distances(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    """vec_id, v, to_pivots."""
    shipped = ship(vectors, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = shipped.value.distances(_matrix(batch.column("v")).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(list(far), pa.list_(pa.float64()))],
                                                 names=["vec_id", "v", "to_pivots"])

    return vectors.mapInArrow(run, "vec_id long, v array<int>, to_pivots array<double>")


def _assigned(batches, centroids: np.ndarray, pivots: Pivots):
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("v")).astype(np.int64)
            yield batch, x, *nearest(x, _matrix(batch.column("to_pivots")), centroids, pivots)[:2]


def moved(table: DataFrame, centroids: list[list[int]], pivots: Pivots) -> list[list[int]]:
    """One round: the floor of the mean of every centroid's vectors, an empty one where it was."""
    shipped, k, size = ship(table, (np.array(centroids, np.int64), pivots)), len(centroids), len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for _, x, cluster, _ in _assigned(batches, *shipped.value):
            for j in np.unique(cluster):
                n[j] += (cluster == j).sum()
                total[j] += x[cluster == j].sum(axis=0)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(n[held]), pa.array(list(total[held]), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])

    sums = table.mapInArrow(run, "cluster int, n long, total array<long>")
    found = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(
        *(F.sum(F.col("total")[i].cast("decimal(20,0)")) for i in range(size))).alias("total")).collect()       # k rows at most
    out = list(centroids)
    for r in found:
        out[r["cluster"]] = [int(s) // r["n"] for s in r["total"]]
    return out


def assign(table: DataFrame, centroids: list[list[int]], pivots: Pivots) -> DataFrame:
    """vec_id, cluster, distance."""
    shipped = ship(table, (np.array(centroids, np.int64), pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, best in _assigned(batches, *shipped.value):
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array([min(int(d), MOST_LONG) for d in best], pa.int64())],
                names=["vec_id", "cluster", "distance"])

    return table.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance of every usable vector, in a written table; the final centroids)."""
    vectors = kept_vectors(embeddings, size=size)
    centroids = starting_centroids(vectors, k)
    if not centroids:
        return vectors.selectExpr("vec_id", "0 as cluster", "0L as distance").limit(0), []
    pivots = Pivots(centroids[:PIVOTS])
    table = cut_lineage(with_pivot_distances(vectors, pivots), "centroids-pivots")
    for _ in range(rounds):
        centroids = moved(table, centroids, pivots)
    return cut_lineage(assign(table, centroids, pivots), "centroids-assigned"), centroids


def report(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    found, centroids = cluster(embeddings, k, rounds, size)
    sums = {r["cluster"]: int(r["s"]) for r in
            found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}     # k rows at most
    each = F.array(*(F.lit(min(sums.get(j, 0), MOST_LONG)).cast("long") for j in range(max(1, len(centroids)))))
    names = F.array(*(F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids or [[]]))
    return found.select("vec_id", "cluster", "distance", each[F.col("cluster")].alias("cluster_inertia"),
                        F.lit(min(sum(sums.values()), MOST_LONG)).cast("long").alias("inertia"),
                        names[F.col("cluster")].alias("centroid_sha256"))

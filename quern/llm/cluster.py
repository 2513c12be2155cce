"""Centroid clustering of vectors in whole numbers.

Components are scaled and floored to integers, so every result is exact and
doesn't depend on how rows are dealt out. A round assigns each vector to its
nearest centroid (ties: the smaller number) and replaces centroids by the
floored means of theirs. Tasks expand the squared distance to
|x|^2 - 2 x.c + |c|^2 and compute it in float64 matrix products over blocks of
rows: where components are small enough, all terms and sums are integers below
2^53 and hence exact. Rows and centroids beyond that bound take part in integer
arithmetic. The sums of tasks are combined by ``treeAggregate``; only centroids
and sums (some numbers per cluster) reach the driver.

Defined cases: vectors of another length, with nulls, NaN or infinities are left
out. A null id is an empty one in the hash that picks the first centroids; rows
that tie there are in the order of their vectors. With fewer vectors than
clusters each vector is a centroid. A sum or distance that doesn't fit in a long
is null. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a matrix product, and of a block of integer arithmetic.
BLOCK, SMALL_BLOCK = 4096, 128
LONG_MAX = (1 << 63) - 1


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector of doubles has ``dims`` finite components."""
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole(x: float, scale: int) -> int:
    """floor(scale * x), exactly, ``scale`` being a power of two."""
    return math.floor(x * scale) if abs(x) < 1e290 else int(x) * scale


@dataclass
class Centroids:
    """Centroids as exact integers, and those small enough for float64 as a matrix."""

    rows: list[list[int]]
    scale: int
    #: Rows and centroids with components up to this: no term or sum of a squared distance reaches 2^53.
    bound: int = 0

    def __post_init__(self) -> None:
        self.bound = math.isqrt((1 << 53) // max(1, len(self.rows[0]))) // 2 - 1
        sizes = [max(map(abs, r), default=0) for r in self.rows]
        self.small = np.array([k for k, m in enumerate(sizes) if m <= self.bound], dtype=np.int64)
        self.large = np.array([k for k, m in enumerate(sizes) if m > self.bound], dtype=np.int64)
        self.matrix = np.array([self.rows[k] for k in self.small], dtype=np.float64).reshape(len(self.small), len(self.rows[0]))
        self.squares = (self.matrix**2).sum(axis=1)

    def nearest(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a block of rows: cluster and distance of each, the rows as integers, and which of them are within the bound."""
        with np.errstate(over="ignore"):
            x = np.floor(raw * self.scale)
        within = np.abs(x).max(axis=1, initial=0) <= self.bound
        if within.all() and not len(self.large):
            d = (x**2).sum(axis=1)[:, None] - 2 * (x @ self.matrix.T) + self.squares
            best = d.argmin(axis=1)
            return best, d[np.arange(len(x)), best].astype(np.int64), x, within
        exact = np.array([[whole(v, self.scale) for v in r] for r in raw.tolist()], dtype=object).reshape(raw.shape)
        best, distance = np.zeros(len(x), np.int64), np.zeros(len(x), object)
        for a in range(0, len(x), SMALL_BLOCK):
            rows = slice(a, a + SMALL_BLOCK)
            d = self._mixed(x[rows], exact[rows], within[rows])
            best[rows] = d.argmin(axis=1)
            distance[rows] = d[np.arange(len(d)), best[rows]]
        return best, distance, exact, within

    def _mixed(self, x: np.ndarray, exact: np.ndarray, within: np.ndarray) -> np.ndarray:
        """Distances of which some are beyond float64, as Python integers."""
        d = np.zeros((len(x), len(self.rows)), object)
        ok = np.flatnonzero(within)
        if len(ok) and len(self.small):
            part = (x[ok] ** 2).sum(axis=1)[:, None] - 2 * (x[ok] @ self.matrix.T) + self.squares
            d[np.ix_(ok, self.small)] = part.astype(np.int64).astype(object)
        for k, centroid in enumerate(self.rows):
            of = np.flatnonzero(~within) if k in self.small else np.arange(len(x))
            if len(of):
                d[of, k] = ((exact[of] - np.array(centroid, object)) ** 2).sum(axis=1)
        return d


def _vectors(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of a batch's vectors, with the number of their first row."""
    column = batch.column("vector")
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    for a in range(0, len(values), BLOCK):
        yield a, values[a : a + BLOCK]


def _combined(a: tuple, b: tuple) -> tuple:
    """Sums of two parts, in Python integers."""
    return tuple(x + y for x, y in zip(a, b, strict=True))


def _tree_sum(rows: DataFrame, centroids: Centroids, with_sums: bool) -> tuple:
    """Per cluster: the number of vectors, the sum of their distances and, if asked for, of their components."""
    k, dims = len(centroids.rows), len(centroids.rows[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, inertia, sums = np.zeros(k, object), np.zeros(k, object), np.zeros((k, dims), object)
        for batch in batches:
            for _, raw in _vectors(batch, dims):
                best, distance, x, within = centroids.nearest(raw)
                counts += np.bincount(best, minlength=k).astype(object)
                np.add.at(inertia, best, distance.astype(object))
                if not with_sums:
                    continue
                if within.all():  # a block's sums are below 2^53, too
                    own = np.zeros((len(best), k))
                    own[np.arange(len(best)), best] = 1
                    sums += (own.T @ x.astype(np.float64)).astype(np.int64).astype(object)
                else:
                    np.add.at(sums, best, x)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((counts, inertia, sums))], pa.binary())], ["part"])

    zero = (np.zeros(k, object), np.zeros(k, object), np.zeros((k, dims), object))
    return rows.select("vector").mapInArrow(run, "part binary").rdd.treeAggregate(zero, lambda total, row: _combined(total, pickle.loads(row[0])), _combined)


def _first(rows: DataFrame, clusters: int, seed: int, scale: int) -> list[list[int]]:
    """The first centroids: the vectors whose ids have the least hashes."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    found = rows.select(order.alias("order"), "vector").orderBy("order", "vector").limit(clusters).collect()
    return [[whole(v, scale) for v in x["vector"]] for x in found]


def fit(rows: DataFrame, clusters: int, rounds: int, seed: int, scale: int) -> Centroids | None:
    """Centroids of usable rows (id, vector) after ``rounds`` rounds; None if there are no rows."""
    first = _first(rows, clusters, seed, scale)
    if not first:
        return None
    centroids = Centroids(first, scale)
    for _ in range(rounds):
        counts, _, sums = _tree_sum(rows, centroids, with_sums=True)
        centroids = Centroids([[int(v) // int(n) for v in own] if n else c for n, own, c in zip(counts, sums, centroids.rows, strict=True)], scale)
    return centroids


def _long(x: int) -> int | None:
    return int(x) if abs(int(x)) <= LONG_MAX else None


def cluster(vectors: DataFrame, clusters: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector: id, cluster, distance, cluster_inertia, inertia and centroid_sha256."""
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector"), dims))
    out = f"id {rows.schema['id'].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = fit(rows, clusters, rounds, seed, scale)
    if centroids is None:
        return rows.sparkSession.createDataFrame([], out).withColumnRenamed("id", id_col)
    _, by_cluster, _ = _tree_sum(rows, centroids, with_sums=False)
    return rows.mapInArrow(_assigner(centroids, dims, by_cluster), out).withColumnRenamed("id", id_col)


def _assigner(centroids: Centroids, dims: int, by_cluster: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    own = pa.array([_long(x) for x in by_cluster], pa.int64())
    total = _long(sum(map(int, by_cluster)))
    digests = pa.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, raw in _vectors(batch, dims):
                best, distance, _, _ = centroids.nearest(raw)
                at = pa.array(best, pa.int64())
                far = pa.array([_long(x) for x in distance.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, len(raw)), at.cast(pa.int32()), far, own.take(at), pa.array([total] * len(raw), pa.int64()), digests.take(at)],
                    ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return run

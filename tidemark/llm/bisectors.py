"""Clusters around integer centroids, each vector placed by a tournament of bisectors.

For centroids a < b a vector x is no farther from a than from b if 2 (b - a) . x <= |b|^2 - |a|^2.
These normals and thresholds are computed once a round for all pairs; a vector then needs the signs
of k - 1 linear tests, each of which eliminates a centroid, and one distance, that to the winner.
Everything is whole numbers: sums stay within 2^53 where floating point does the products (checked
for each block), and use 64-bit integers otherwise.

Vectors are read where they lie. Rounds move one row per task, cluster and component; only centroids,
k times as many numbers as a vector has, reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, written

#: Beyond this a component's squared distances would not fit into 64 bits.
LARGEST = 1 << 27
#: Centroids at most: normals of all pairs are held by every task.
MOST = 512
#: Vectors tested at a time.
_BLOCK = 4096


class Bisectors:
    """Normals and thresholds of all pairs of centroids (k x d whole numbers)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = c = centroids.astype(np.int64)
        self.normals = 2 * (c[None, :, :] - c[:, None, :])  # [a, b]: from a to b
        norms = (c * c).sum(axis=1)
        self.thresholds = norms[None, :] - norms[:, None]
        self.floats = self.normals.astype(np.float64)
        self.reach = int(np.abs(self.normals).max(initial=0)) * c.shape[1]
        self.plain = int(np.abs(self.thresholds).max(initial=0)) < 1 << 53

    def _stays(self, x, y, a, b) -> np.ndarray:
        """Whether centroid a is as near as b or nearer, for each vector; equal means a."""
        normals = self.normals if y is x else self.floats
        if np.ndim(a) == 0:
            return y @ normals[a, b] <= self.thresholds[a, b]
        return np.einsum("nd,nd->n", y, normals[a, b]) <= self.thresholds[a, b]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (the smaller number if equally near) and squared distance, of each row."""
        exact = self.plain and int(np.abs(x).max(initial=0)) * self.reach < 1 << 53
        y = x.astype(np.float64) if exact else x
        field = list(range(len(self.centroids)))  # what is left of each part: a number, or one a vector
        while len(field) > 1:
            left = []
            for a, b in zip(field[::2], field[1::2]):
                left.append(np.where(self._stays(x, y, a, b), a, b))
            field = left + field[len(left) * 2 :]
        won = np.broadcast_to(np.asarray(field[0], np.int64), (len(x),))
        apart = x - self.centroids[won]
        return won, np.einsum("nd,nd->n", apart, apart)


def whole_vectors(vectors: DataFrame, column: str = "embedding", size: int = 64, scale: int = 256) -> DataFrame:
    """vec_id and q, the bytes of floor(scale * x) as 32-bit integers, of the vectors that are kept.

    Kept are those of ``size`` components, none of them null or not finite, nor so large that
    floor(scale * x) exceeds 2^27 in size: their squared distances would not fit into a long.
    """

    def make(batches):
        for batch in batches:
            ids, lists = batch.columns
            fits = pc.fill_null(pc.equal(pc.list_value_length(lists), size), False)
            flat = lists.filter(fits).flatten().to_numpy(zero_copy_only=False)  # nulls become NaN
            with np.errstate(over="ignore", invalid="ignore"):
                grid = np.floor(scale * flat.astype(np.float64).reshape(-1, size))
                good = (np.abs(grid) <= LARGEST).all(axis=1)
            rows = grid[good].astype("<i4")
            q = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * size), len(rows), [None, pa.py_buffer(rows.tobytes())])
            yield pa.RecordBatch.from_arrays([ids.filter(fits).filter(pa.array(good, pa.bool_())), q.cast(pa.binary())], names=["vec_id", "q"])

    rows = columns_of(vectors, "vec_id", column).select(F.col("vec_id").cast("long"), F.col(f"`{column}`").cast("array<double>"))
    return rows.mapInArrow(make, "vec_id long, q binary")


def _blocks(column, size: int):
    """The q column of a batch as blocks of vectors."""
    for at in range(0, len(column), _BLOCK):
        part = column.slice(at, _BLOCK)
        raw = b"".join(part.to_pylist())
        yield at, np.frombuffer(raw, "<i4").reshape(-1, size).astype(np.int64)


def _first(rows: DataFrame, k: int, seed: int, size: int) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = rows.select(order.alias("h"), "q").orderBy("h", "q").limit(k).collect()
    return np.frombuffer(b"".join(bytes(r.q) for r in found), "<i4").reshape(-1, size).astype(np.int64)


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid that has vectors becomes their exact componentwise floor(sum / count)."""
    k, size = centroids.shape

    def sums(batches):
        planes = Bisectors(centroids)
        total, count = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, x in _blocks(batch.column(0), size):
                won, _ = planes.nearest(x)
                order = np.argsort(won, kind="stable")
                here, starts = np.unique(won[order], return_index=True)
                total[here] += np.add.reduceat(x[order], starts, axis=0)
                count += np.bincount(won, minlength=k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, size)), pa.array(np.tile(np.arange(size), len(some))), pa.array(total[some].ravel()), pa.array(np.repeat(count[some], size))],
            names=["cluster", "component", "total", "n"])

    parts = rows.select("q").mapInArrow(sums, "cluster long, component long, total long, n long")
    total = parts.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for r in total.collect():  # k times size rows at most
        moved[r.cluster, r.component] = int(r.total) // r.n
    return moved


def fit(rows: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, size: int = 64) -> np.ndarray:
    """Centroids after so many rounds, from the k vectors that come first by the hash of their id."""
    if not 1 <= k <= MOST:
        raise ValueError(f"k must be between 1 and {MOST}")
    centroids = _first(rows, k, seed, size)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(rows, centroids)
    return centroids


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every whole vector."""
    size = centroids.shape[1]

    def place(batches):
        planes = Bisectors(centroids)
        for batch in batches:
            won, apart = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int64)
            for at, x in _blocks(batch.column(1), size):
                won[at : at + len(x)], apart[at : at + len(x)] = planes.nearest(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(won), pa.array(apart)], names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(place, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, column: str = "embedding", size: int = 64) -> DataFrame:
    """Every kept vector with its cluster, its distance and the sums and centroid of its cluster.

    See ``whole_vectors`` for which are kept; others give no row. Starting centroids are the k kept
    vectors with the smallest sha256 of ``seed:vec_id`` (a null id counts as an empty one), equal
    ids by their components; with fewer vectors there are fewer centroids. Rows that repeat are
    vectors each. Ties go to the smaller number, and a centroid without vectors stays. Extra
    columns are not returned. An empty table, or one without a kept vector, gives no row.
    """
    spark = vectors.sparkSession
    rows = written(whole_vectors(vectors, column, size), "whole")
    centroids = fit(rows, k, rounds, seed, size)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    placed = written(assign(rows, centroids), "placed")
    inertia = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    sums = {r.cluster: int(r.d) for r in inertia.collect()}  # k rows at most
    total = sum(sums.values())
    named = [(c, d, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, d in sums.items()]
    known = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 40, rounds: int = 5, seed: int = 2, size: int = 64) -> str:
    """The contract's columns in DuckDB SQL: all distances, instead of a tournament."""
    steps = [f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS cluster, q
  FROM (SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, q FROM v ORDER BY h LIMIT {k}))"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, q, min(p) AS best FROM (
    SELECT v.vec_id, v.q, struct_pack(distance := CAST(list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), cluster := c.cluster) AS p
    FROM v, c{i} AS c) GROUP BY vec_id, q)""")
        if i < rounds:
            steps.append(f"""
s{i} AS MATERIALIZED (
  SELECT cluster, pos, sum(x) AS s, count(*) AS n
  FROM (SELECT best.cluster AS cluster, unnest(q) AS x, generate_subscripts(q, 1) AS pos FROM a{i}) GROUP BY 1, 2),
m{i} AS (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS q FROM s{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{i} AS c LEFT JOIN m{i} AS m USING (cluster))""")
    return ",".join(steps) + f"""
SELECT vec_id, best.cluster AS cluster, best.distance AS distance,
       CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} AS c ON c.cluster = best.cluster"""

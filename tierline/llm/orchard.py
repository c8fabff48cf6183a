"""Centroid clustering with Orchard's search, in whole numbers.

Vectors become whole numbers (``floor(scale * x)``), so every distance, sum and
centroid is exact and no result depends on the order of additions or on the number
of tasks. Each round assigns every vector to its nearest centroid by squared
Euclidean distance (ties: the smaller number) and moves every non-empty centroid to
the floor of its vectors' mean.

Search. Each centroid has a list of the others by ascending distance from it. A
vector walks the list of the nearest centroid seen so far; when it finds a closer
one (or an equally close one of a smaller number), it goes on in that one's list
from the start, and marks keep it from measuring a centroid twice. The walk stops
at the first centroid that lies strictly beyond twice the current distance: by the
triangle inequality that one and all after it are strictly farther from the vector,
so ties are never lost. The first guess is the nearest of a few pivots. A batch of
vectors walks together, in numpy.

Every round is one map-only pass over a written table plus a sum of one row a
cluster and task; only the centroids (``k`` rows) pass through the driver.

Defined results: vectors that are null, of another length or with a null, NaN or
infinite component are left out. Repeated rows are vectors of their own. Fewer
vectors than ``k`` give that many centroids; of starts with equal hashes (a repeated
id, or null ids, which count as empty) the smaller vector goes first. An empty table
gives no rows. Components whose whole number exceeds ``BOUND`` in magnitude raise an
error, since squared distances would leave the range of a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import ship_package, staged

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SIZE = 64
SEED = "3"
#: Largest magnitude of a whole-numbered component.
BOUND = 1 << 27
#: Vectors that walk together.
_ROWS = 4096


class OrchardIndex:
    """Centroids with every centroid's list of the others by ascending distance."""

    def __init__(self, centroids: np.ndarray):
        """centroids: k x size whole numbers, k at least 1."""
        self.centroids = centroids.astype(np.int64)
        k = len(centroids)
        gap = np.empty((k, k), dtype=np.int64)
        for i in range(k):
            gap[i] = self._squared(self.centroids, self.centroids[i])
            gap[i, i] = -1  # itself comes first, whatever equals it
        order = np.argsort(gap, axis=1, kind="stable")[:, 1:]
        self.neighbours = order.astype(np.int32)
        # a centroid is strictly beyond twice the distance if a quarter of its squared gap, rounded up, is above it
        self.quarter = (np.take_along_axis(gap, order, axis=1) + 3) // 4
        self.pivots = range(isqrt(k))

    @staticmethod
    def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        d = a - b
        return np.einsum("ij,ij->i", d, d)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(centroid, squared distance) of each row, and how many distances were measured."""
        n, k = len(x), len(self.centroids)
        visited = np.zeros((n, k), dtype=bool)
        best = np.zeros(n, dtype=np.int64)
        distance = self._squared(x, self.centroids[0])
        visited[:, 0] = True
        for p in self.pivots[1:]:
            d = self._squared(x, self.centroids[p])
            visited[:, p] = True
            closer = d < distance
            best[closer], distance[closer] = p, d[closer]
        at = np.zeros(n, dtype=np.int64)  # place in the list of the nearest centroid so far
        live = np.arange(n)
        while live.size:
            live = live[at[live] < k - 1]
            b, place = best[live], at[live]
            inside = self.quarter[b, place] <= distance[live]
            live, b = live[inside], b[inside]
            j = self.neighbours[b, place[inside]].astype(np.int64)
            new = ~visited[live, j]
            rows, to = live[new], j[new]
            visited[rows, to] = True
            d = self._squared(x[rows], self.centroids[to])
            closer = (d < distance[rows]) | ((d == distance[rows]) & (to < best[rows]))
            at[live] += 1
            jump = rows[closer]
            best[jump], distance[jump], at[jump] = to[closer], d[closer], 0
        return best, distance, int(visited.sum())


def whole_vectors(df: DataFrame, key: str, vector: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(__k, __v): usable vectors as whole numbers."""
    x = F.col(f"`{vector}`").cast("array<double>")
    usable = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = df.select(F.col(f"`{key}`").alias("__k"), x.alias("__x")).filter((F.size(x) == size) & usable)
    fits = F.forall("__x", lambda e: F.abs(e * scale) <= BOUND)
    whole = F.transform("__x", lambda e: F.floor(e * scale).cast("int"))
    error = F.raise_error(F.lit(f"a component exceeds {BOUND / scale} in magnitude")).cast("array<int>")
    return rows.select("__k", F.when(fits, whole).otherwise(error).alias("__v"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: str = SEED) -> np.ndarray:
    """The vectors whose ids have the least hashes, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__k").cast("string"), F.lit(""))), 256)
    rows = vectors.select(name.alias("h"), "__v").orderBy("h", "__v").limit(k).collect()
    return np.array([r["__v"] for r in rows], dtype=np.int64)


def _walked(batches: Iterator[pa.RecordBatch], index: OrchardIndex, size: int):
    """(part, vectors, centroid, distance) of each part of the batches."""
    for batch in batches:
        for lo in range(0, batch.num_rows, _ROWS):
            part = batch.slice(lo, _ROWS)
            x = part.column("__v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.int64)
            best, distance, _ = index.nearest(x)
            yield part, x, best, distance


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of each cluster's mean; empty clusters keep theirs."""
    spark = vectors.sparkSession
    size = centroids.shape[1]
    shared = spark.sparkContext.broadcast(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = OrchardIndex(shared.value)
        count = np.zeros(len(index.centroids), dtype=np.int64)
        total = np.zeros(index.centroids.shape, dtype=np.int64)
        for _, x, best, _ in _walked(batches, index, size):
            order = np.argsort(best, kind="stable")
            found, start, n = np.unique(best[order], return_index=True, return_counts=True)
            count[found] += n
            total[found] += np.add.reduceat(x[order], start, axis=0)
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(count[seen]), pa.array(list(total[seen]), pa.list_(pa.int64()))],
            names=["c", "n", "s"],
        )

    parts = vectors.select("__v").mapInArrow(sums, "c int, n long, s array<long>")
    each = parts.select("c", "n", F.posexplode("s").alias("at", "s"))
    out = centroids.copy()
    for r in each.groupBy("c", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        out[r["c"], r["at"]] = r["s"] // r["n"]
    shared.unpersist()
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(__k, __c, __d): each vector's nearest centroid and squared distance."""
    size = centroids.shape[1]
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    schema = T.StructType([vectors.schema["__k"], T.StructField("__c", T.IntegerType()), T.StructField("__d", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = OrchardIndex(shared.value)
        for part, _, best, distance in _walked(batches, index, size):
            yield pa.RecordBatch.from_arrays(
                [part.column("__k"), pa.array(best.astype(np.int32)), pa.array(distance)], names=schema.names
            )

    return vectors.mapInArrow(run, schema)


def centroid_text(centroid: np.ndarray) -> str:
    return ",".join(map(str, centroid.tolist()))


def cluster_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per usable vector."""
    spark = df.sparkSession
    ship_package(spark)
    vectors = staged(whole_vectors(df, key, vector, size, scale), "whole-vectors")
    centroids = first_centroids(vectors, k, seed)
    info: list[tuple] = []
    if len(centroids):
        for _ in range(rounds):
            after = moved(vectors, centroids)
            if np.array_equal(after, centroids):
                break  # later rounds would repeat this one
            centroids = after
        found = staged(assigned(vectors, centroids), "assigned-vectors")
        spread = {r["__c"]: r["s"] for r in found.groupBy("__c").agg(F.sum("__d").alias("s")).collect()}
        whole = sum(spread.values())
        for c, s in spread.items():
            info.append((c, s, whole, hashlib.sha256(centroid_text(centroids[c]).encode()).hexdigest()))
    else:
        found = vectors.select("__k", F.lit(0).alias("__c"), F.lit(0).cast("long").alias("__d"))
    about = spark.createDataFrame(info, "__of int, cluster_inertia long, inertia long, centroid_sha256 string")
    rows = found.join(F.broadcast(about), F.col("__c") == F.col("__of"))  # one row a cluster
    named: list[Column] = [F.col("__k").alias(key), F.col("__c").alias("cluster"), F.col("__d").alias("distance")]
    return rows.select(*named, "cluster_inertia", "inertia", "centroid_sha256")

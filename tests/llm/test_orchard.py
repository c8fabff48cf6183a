from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.oracle_check import compare, duck
from tierline.llm import orchard, queries

NAME = "op11_orchard_clusters"


def plain(rows, k=8, rounds=10, size=64):
    """Clusters by measuring everything, with Python's whole numbers."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in starts[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for c, m in zip(centroids, members)]
    found = [(i, *nearest(v)) for i, v in kept]
    of = {j: sum(d for _, d, c in found if c == j) for j in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i or 0), c, d, of[c], sum(of.values()), digest[c]) for i, d, c in found)


def rows_of(df):
    return sorted((r[0] or 0, *tuple(r)[1:]) for r in df.collect())


def test_query(spark, sf):
    got = queries.QUERIES[NAME](spark, sf)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert dict(got.dtypes)["cluster"] == "int" and dict(got.dtypes)["distance"] == "bigint"
    want = plain([(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()])
    assert rows_of(got) == want and len({r[1] for r in want}) == 8


def test_query_matches_oracle(spark, sf):
    assert compare(spark, duck(sf), NAME, queries.QUERIES[NAME], queries.ORACLE[NAME], sf)[0] == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 30), st.integers(1, 4), st.integers(0, 6), st.integers(0, 2**32))
def test_search_finds_the_nearest(k, size, spread, seed):
    rng = np.random.default_rng(seed)
    centroids = rng.integers(-spread, spread + 1, (k, size))  # ties and equal centroids are frequent
    x = rng.integers(-spread - 2, spread + 3, (50, size)).astype(np.int64)
    best, distance, _ = orchard.OrchardIndex(centroids).nearest(x)
    every = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert best.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()


def test_search_measures_few_distances():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-1000, 1000, (200, 2))
    x = centroids[rng.integers(0, 200, 2000)] + rng.integers(-5, 6, (2000, 2))
    assert orchard.OrchardIndex(centroids).nearest(x)[2] < 0.4 * 200 * 2000


def test_largest_components():
    ends = np.array([[orchard.BOUND] * 64, [-orchard.BOUND] * 64])
    best, distance, _ = orchard.OrchardIndex(ends).nearest(np.array([[orchard.BOUND] * 64, [-orchard.BOUND] * 63 + [0]]))
    assert best.tolist() == [0, 1] and distance.tolist() == [0, orchard.BOUND**2]


ODD = [
    (1, None), (2, []), (3, [1.0]), (4, [0.5, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [0.25, -0.25]),
    (None, [0.125, 3.0]), (7, [0.0, 0.0]), (7, [0.0, 0.0]), (7, [1.0, 0.0]), (8, [-0.0001, 0.0]), (9, [1.0, 2.0, 3.0]),
]


@pytest.mark.parametrize("k", [1, 2, 3, 20])
def test_odd_rows(spark, k):
    df = spark.createDataFrame(ODD, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x")).withColumn("__k", F.lit(1))
    assert rows_of(orchard.cluster_vectors(df, k=k, size=2)) == plain(ODD, k=k, size=2)


def test_empty_and_too_large(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    got = orchard.cluster_vectors(none)
    assert got.columns[1] == "cluster" and got.count() == 0
    huge = spark.createDataFrame([(1, [1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exceeds"):
        orchard.cluster_vectors(huge, size=1)

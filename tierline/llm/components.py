"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import staged


def _is_stars(edges: DataFrame) -> bool:
    """Whether every edge (a, b) joins a node to its root: no second edge from a, none from b (one shuffle)."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("root"))
    )
    found = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("root").alias("root"))
    return found.filter((F.col("below") > 1) | (F.col("below") + F.col("root") > 1)).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's least node.

    Alternating large-star and small-star rounds: each round replaces the edges by
    stars around smaller nodes, until every edge joins a node to its root, in a number
    of rounds that grows with the logarithm of the longest chain. Minima are aggregated map-side,
    and the joins are plain equi-joins, so a node with very many neighbours is
    pre-aggregated or split by the planner. Every round's edges are written to the
    shared folder, which cuts the lineage.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs if not large else pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above the node; small star: neighbours below it (a > b holds)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(least, "a")
        if large:
            out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
                least.select("a", F.col("m").alias("b"))
            )
        return out.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    current = staged(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "components",
    )
    while not _is_stars(current):
        current = staged(star(star(current, True), False), "components")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

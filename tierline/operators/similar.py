"""Near-equal names: a set-similarity self-join over q-grams.

Names that are equal after normalising are one node, named by its least key, so
repeats never multiply. Two nodes are near when the Jaccard similarity of their
q-gram sets is at least ``similarity``. Candidates come from a prefix filter: with the
grams of all names ordered from rare to frequent, two near sets share a gram among
the first ``n - ceil(t * n) + 1`` of each, so only those are joined. The join's key is the
gram and the partner's set size, of which only those between ``t * n`` and ``n / t``
are possible (length filter), so a frequent gram's rows are spread over the sizes.
Every candidate is verified on the whole sets.

Defined results: a NULL name is nobody's neighbour and has no node; a name without any
character is a node without neighbours; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Q = 3
SIMILARITY = 0.8


def normalised(name: str | Column) -> Column:
    """Lower case, runs of white space as one space, no space at the ends."""
    col = F.col(f"`{name}`") if isinstance(name, str) else name
    return F.trim(F.regexp_replace(F.lower(col), "\\s+", " "))


def grams(text: str | Column, q: int = Q) -> Column:
    """Distinct q-grams of the text between q - 1 marks on either side; none of an empty text."""
    col = F.col(text) if isinstance(text, str) else text
    marks = F.lit("\u0001" * (q - 1))
    padded = F.concat(marks, col, marks)
    places = F.sequence(F.lit(1), F.length(padded) - (q - 1))
    found = F.array_distinct(F.transform(places, lambda i: F.substr(padded, i, F.lit(q))))
    return F.when(F.length(col) > 0, found).otherwise(F.array().cast("array<string>"))


def members(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, node): every row with a name and the least key of the rows whose name is equal after normalising."""
    rows = df.select(F.col(f"`{key}`").alias("_tl_key"), normalised(name).alias("_tl_text")).filter(F.col("_tl_text").isNotNull())
    nodes = rows.groupBy("_tl_text").agg(F.min("_tl_key").alias("node"))
    return rows.join(nodes, "_tl_text").select(F.col("_tl_key").alias(key), "node")


def near_pairs(df: DataFrame, key: str, name: str, similarity: float = SIMILARITY, q: int = Q) -> DataFrame:
    """(node, other, common, together): near nodes, each pair once, with the sizes of intersection and union."""
    rows = df.select(F.col(f"`{key}`").alias("key"), normalised(name).alias("text")).filter(F.length("text") > 0)
    nodes = rows.groupBy("text").agg(F.min("key").alias("node")).select("node", grams("text", q).alias("grams"))
    nodes = nodes.withColumn("n", F.size("grams"))
    # grams from rare to frequent; a gram's frequency is one row a distinct gram
    spread = nodes.select("node", "n", F.explode("grams").alias("gram"))
    often = spread.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    ranked = spread.join(often, "gram").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("often", "gram"))).alias("ranked"))
    limit = F.lit(similarity) * F.col("n")
    least = F.ceil(limit - 1e-9).cast("int")
    prefix = F.slice(F.transform("ranked", lambda g: g["gram"]), 1, F.col("n") - least + 1)
    heads = ranked.select("node", "n", F.explode(prefix).alias("gram"))
    most = F.floor(F.col("n") / F.lit(similarity) + 1e-9).cast("int")
    asking = heads.select(F.col("node").alias("a"), "gram", F.explode(F.sequence(F.greatest(least, F.lit(1)), most)).alias("size"))
    asked = heads.select(F.col("node").alias("b"), "gram", F.col("n").alias("size"))
    candidates = asking.join(asked, ["gram", "size"]).filter(F.col("a") < F.col("b")).select("a", "b").distinct()
    sets = nodes.select("node", "grams")
    both = candidates.join(sets.toDF("a", "_tl_a"), "a").join(sets.toDF("b", "_tl_b"), "b")
    both = both.select("a", "b", F.size(F.array_intersect("_tl_a", "_tl_b")).alias("common"), F.size(F.array_union("_tl_a", "_tl_b")).alias("together"))
    return both.filter(F.col("common") >= F.lit(similarity) * F.col("together") - 1e-9).toDF("node", "other", "common", "together")

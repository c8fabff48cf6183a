"""SimHash near-duplicates, searched with BK-trees.

A document's fingerprint has a bit set where more than half of its shingle hashes
have it set. Two fingerprints link when they differ in at most ``radius`` bits.

Search. Equal fingerprints are one node from the start. Cut into B blocks of bits,
two linked fingerprints agree in at least B - ``radius`` blocks, so each node goes
to one bucket for every choice of B - ``radius`` blocks, and every link is inside
some bucket. Four blocks give 4 buckets a node; with more nodes five or six blocks
give 10 or 20 buckets whose longer keys keep them small. A bucket's fingerprints
form a BK-tree: each child hangs on its parent by their integer
Hamming distance, and a search follows only the edges within ``radius`` of the
query's distance to the node. Trees are never collected: a task receives a bounded
shard of many buckets and grows all its trees together, level by level, in numpy.

Hot buckets. A bucket with more than ``TREE_NODES`` fingerprints is cut into
chunks; each chunk is a tree, and every chunk's fingerprints also search the other
chunks' trees, one bounded task per pair of chunks. No link is lost.

What leaves a task is a spanning forest of the links that it found, never the
links themselves, so a dense group of n near copies gives at most n - 1 rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import checked_broadcast, ship_package, slices, staged, with_fields
from tierline.llm.components import connected_components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
#: Most fingerprints of one tree; larger buckets are cut into that many chunks.
TREE_NODES = 4096
#: Fingerprints that one search task receives, about.
SHARD_ROWS = 40_000
#: Most (query, node) pairs held while searching.
FRONTIER = 1 << 20


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits, unsigned. No text or no word: zero."""
    found = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space cuts
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = [b" ".join(s) for s in zip(*(found[i:] for i in range(words)), strict=False)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    total = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[lo : lo + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", words: int = SHINGLE_WORDS, name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint as a (signed) long; other columns stay, one of that name is replaced."""
    ship_package(df.sparkSession)
    schema = with_fields(df.schema, T.StructField(name, T.LongType()))
    kept = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                prints = [fingerprint(t, words) for t in part.column(text).to_pylist()]
                column = pa.array(np.array(prints, dtype=np.uint64).view(np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [column], names=schema.names)

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------- BK-trees


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class BkForest:
    """BK-trees of several buckets, one root each, grown together."""

    def __init__(self, points: np.ndarray, buckets: np.ndarray):
        """points: distinct within a bucket; buckets: 0, 1, ..."""
        self.points = points
        first = np.unique(buckets, return_index=True)[1]
        self.roots = first  # the root of bucket k is points[roots[k]]
        waiting = np.setdiff1d(np.arange(len(points)), first)
        at = first[buckets[waiting]]
        keys, children = [], []
        while waiting.size:
            key = at * 65 + _distance(points[waiting], points[at])
            taken, index, group = np.unique(key, return_index=True, return_inverse=True)
            keys.append(taken)
            children.append(waiting[index])
            stay = np.ones(len(waiting), dtype=bool)
            stay[index] = False
            at, waiting = waiting[index][group][stay], waiting[stay]
        keys = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]  # parent * 65 + edge, so one parent's edges are neighbours
        self.children = (np.concatenate(children) if children else keys)[order]

    def search(self, queries: np.ndarray, buckets: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, point index) within the radius, in pieces."""
        stack = [(np.arange(len(queries)), self.roots[buckets])]
        while stack:
            query, node = stack.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                stack += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            d = _distance(queries[query], self.points[node])
            near = d <= radius
            if near.any():
                yield query[near], node[near]
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), side="right")
            count = hi - lo
            total = int(count.sum())
            if total:
                starts = np.repeat(lo - (np.cumsum(count) - count), count)
                stack.append((np.repeat(query, count), self.children[starts + np.arange(total)]))


def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        x = up


def forest_edges(count: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Component label (least index) of 0..count-1 joined by the pairs."""
    parent = np.arange(count)
    for a, b in pairs:
        while a.size:
            a, b = _find(parent, a), _find(parent, b)
            open_ = a != b
            a, b = a[open_], b[open_]
            if a.size:
                low, high = np.minimum(a, b), np.maximum(a, b)
                np.minimum.at(parent, high, low)
        parent = _find(parent, parent)
    return _find(parent, parent)


def search_shard(pdf: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Spanning forest of the links in one shard.

    Rows: fp, bucket (which tree), role 0 (in the tree and searching) or 1 (searching only).
    Every edge joins a fingerprint to the least of its component here, so shards that
    hold parts of one group mostly name the same root.
    """
    points = pdf["fp"].to_numpy().view(np.uint64)
    bucket = pd.factorize(pdf["bucket"])[0]
    tree = np.flatnonzero(pdf["role"].to_numpy() == 0)
    if not tree.size:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    kept, tree_bucket = np.unique(bucket[tree], return_inverse=True)
    forest = BkForest(points[tree], tree_bucket)
    where = np.searchsorted(kept, bucket)
    known = (where < len(kept)) & (kept[np.minimum(where, len(kept) - 1)] == bucket)
    asking = np.flatnonzero(known)
    found = forest.search(points[asking], where[asking], radius)
    ordered, place = np.unique(points.view(np.int64), return_inverse=True)  # a node per fingerprint, in signed order
    label = forest_edges(len(ordered), ((place[asking[q]], place[tree[n]]) for q, n in found))
    moved = np.flatnonzero(label != np.arange(len(ordered)))
    return pd.DataFrame({"a": ordered[moved], "b": ordered[label[moved]]})


def blocks_for(nodes: int, radius: int) -> int:
    """Blocks that keep an even bucket at some hundred nodes; every choice finds every link."""
    extra = 1 + (nodes > 1 << 24) + (nodes > 1 << 32)
    return min(radius + extra, 64)


def links(prints: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """(a, b): edges that connect exactly the fingerprints that links connect.

    ``prints`` has one distinct long column ``fp`` (a written table: it is read more than once).
    """
    spark = prints.sparkSession
    ship_package(spark)
    blocks = blocks or blocks_for(prints.count(), radius)
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [
        F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(cuts, cuts[1:], strict=False)
    ]
    agreeing = itertools.combinations(parts, blocks - radius)
    buckets = F.array(*(F.xxhash64(F.lit(i), *chosen) for i, chosen in enumerate(agreeing)))
    rows = prints.select("fp", F.explode(buckets).alias("bucket"))
    large = (
        rows.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        .select("bucket", F.ceil(F.col("n") / TREE_NODES).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("chunks")).cast("int")
    # chunk c is the tree of (c, c), (c, d > c), and searches the trees of (b < c, c)
    rows = rows.join(large, "bucket").withColumn("chunk", chunk)
    rows = rows.select(
        "fp", "bucket", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    ).select(
        "fp",
        F.xxhash64("bucket", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("bucket"),
        F.when(F.col("chunk") <= F.col("other"), 0).otherwise(1).alias("role"),
    )
    rows = staged(rows, "simhash-buckets")
    shards = max(1, rows.count() // SHARD_ROWS)
    return (
        rows.withColumn("shard", F.pmod("bucket", F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(lambda pdf: search_shard(pdf, radius), "a long, b long")
    )


# ---------------------------------------------------------------- components


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """(key, fingerprint long, component_id, root) for every row of ``df``.

    ``component_id`` is the least key among the documents reachable over links,
    ``root`` the least fingerprint (signed) among them. Defined results: null and
    empty texts have fingerprint zero and link like any other; repeated rows stay
    rows of one component; a null key never is a component id unless all the
    component's keys are null; an empty table gives no rows.
    """
    prints = staged(with_fingerprint(df.select(key, text), text, words).select(key, "fingerprint"), "simhash")
    nodes = staged(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(key).alias("least")), "simhash-nodes")
    roots = connected_components(links(nodes.select("fp"), radius))
    classes = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    classes = staged(classes, "simhash-classes")
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.select("fp", "root").join(least, "root")
    return prints.join(classes, prints["fingerprint"] == classes["fp"], "left").select(
        key, "fingerprint", "component_id", "root"
    )


def keep_one_per_group(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """The rows of ``df`` without near copies: each group keeps exactly one document.

    It is the least by key (a null key comes last) and then by text hash. Rows are
    matched by key and text hash together, so different texts under one key, or
    without any, are judged each in its own group. Of rows that repeat both, the least by a hash
    of all columns stays.
    """
    name = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("k"), F.xxhash64(text).alias("h"))
    found = near_duplicates(df.select(name.alias("__name"), F.col(text).alias("text")), "__name", "text", words, radius)
    names = found.groupBy("__name", "component_id").agg(F.count("*").alias("__n"))
    names = names.select(
        F.col("__name.k").alias("__key"),
        F.col("__name.h").alias("__hash"),
        (F.col("__name") == F.col("component_id")).alias("__kept"),
        "__n",
    )
    names = staged(names.filter(~F.col("__kept") | (F.col("__n") > 1)), "simhash-names")
    gone = checked_broadcast(names.filter(~F.col("__kept")))
    same = df[key].eqNullSafe(F.col("__key")) & (F.xxhash64(df[text]) == F.col("__hash"))
    left = df.join(gone, same, "left_anti")  # the texts stay where they are unless very many documents go
    repeated = names.filter("__kept")
    if repeated.isEmpty():
        return left
    repeated = checked_broadcast(repeated)
    rows = left.join(repeated, same, "left_semi").select(
        F.struct(*(df[c] for c in df.columns)).alias("__row"), df[key].alias("__k"), F.xxhash64(df[text]).alias("__h"),
        F.xxhash64(*(df[c] for c in df.columns)).alias("__all"),
    )
    once = rows.groupBy("__k", "__h").agg(F.min_by("__row", "__all").alias("__row")).select("__row.*")
    return left.join(repeated, same, "left_anti").unionByName(once)

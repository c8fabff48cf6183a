"""Source divergence audit by single-pass in-memory indexing.

How far does each source of a language use terms differently from the language as
a whole, and from each other source? Terms are runs of ASCII letters and characters
beyond ASCII, with A-Z lower-cased. A language keeps the terms that at least
``MIN_DOCUMENTS`` of its documents hold. Over the kept terms a group's probability is
``p = 1 + floor(10^9 * (count + 5) / (N + 5 * V))``, in whole numbers.

Index. A task reads its documents once and builds block postings in memory: term,
group, occurrences, documents. When ``BLOCK_POSTINGS`` are held, the block is spilled as
runs: one row a hash shard with its terms in byte order. Runs go to their shards in
the order of their first terms; a shard's task merges them by a heap, cuts off the
terms that no later run can hold, and adds equal postings up, so it holds the runs
that overlap and no more. The document frequency then decides
which terms a language keeps. No term's rows are gathered: what moves are the blocks'
sums, so a frequent term sends one posting a block and group.

Pairs. The divergence of two sources starts from the two probabilities of a term
that neither has, times all kept terms. Terms that one source has correct this by a sum
over its own probabilities (a running sum at the other's base), and terms that both
have correct it once more: the merged terms are streamed, and each adds its
correction to a bounded set of tiles (``TILE`` x ``TILE`` sources), which leave the task as
sums when there are too many. Nothing grows with pairs of postings but the result,
which has a row for each pair of sources by definition.

Defined results: null text, lang and source count as empty; every occurring (lang,
source) is a group, even without terms; a language of a single source has no pair
rows; a language without kept terms has pair values 0 and no term rows. Repeated rows
count as documents of their own. Ties go to the smaller term or source by its bytes.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import ship_package, slices, staged, text_or_empty

MIN_DOCUMENTS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTHING = 5
#: Postings that a block holds before it is spilled (some 200 bytes each).
BLOCK_POSTINGS = 400_000
#: Most postings of one run row, and run rows of one Arrow batch.
RUN_POSTINGS = 1024
_RUN_ROWS = 256
#: Postings that a merge reads before it cuts off complete terms, and that it holds before it adds up open ones.
CUT_POSTINGS = 200_000
OPEN_POSTINGS = 1_000_000
#: Sources along one side of a tile, and tiles held before they leave the task.
TILE = 128
TILES = 256

#: Bytes that stand in no term become spaces; A-Z become a-z.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """All terms of a text in order, as UTF-8."""
    return text.encode().translate(_TERM_BYTES).split()


# ---------------------------------------------------------------- blocks and runs


_POSTING = pa.schema(
    [("term", pa.binary()), ("lang", pa.string()), ("source", pa.string()), ("n", pa.int64()), ("documents", pa.int64())]
)
_KEYS = ["term", "lang", "source"]
_RUN = (
    "shard int, first binary, term array<binary>, lang array<string>, source array<string>, n array<long>, documents array<long>"
)


class Block:
    """Postings in memory: per (lang, source) the occurrences and documents of each term."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]] = {}
        self.postings = 0

    def add(self, lang: str, source: str, text: str) -> None:
        found = terms_of(text)
        if not found:
            return
        counts, documents = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before = len(counts)
        counts.update(found)
        documents.update(set(found))
        self.postings += len(counts) - before

    def runs(self, shards: int) -> Iterator[pa.RecordBatch]:
        """Rows (shard, first term, postings by term, lang and source), at most ``RUN_POSTINGS`` postings each."""
        parts = []
        for (lang, source), (counts, documents) in self.groups.items():
            n = len(counts)
            parts.append(
                pa.table(
                    [
                        pa.array([zlib.crc32(t) % shards for t in counts], pa.int32()), pa.array(counts.keys(), pa.binary()),
                        pa.repeat(pa.scalar(lang), n), pa.repeat(pa.scalar(source), n),
                        pa.array(counts.values(), pa.int64()), pa.array([documents[t] for t in counts], pa.int64()),
                    ],
                    names=["shard", *_POSTING.names],
                )
            )
        if not parts:
            return
        held = pa.concat_tables(parts)
        held = held.sort_by([(c, "ascending") for c in ("shard", *_KEYS)]).combine_chunks()
        shard = held.column("shard").to_numpy()
        starts = np.flatnonzero(np.diff(shard, prepend=-1))
        sizes = np.diff(np.append(starts, len(shard)))
        # cut long rows
        pieces = -(-sizes // RUN_POSTINGS)
        inside = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        cuts = np.append(np.repeat(starts, pieces) + inside * RUN_POSTINGS, len(shard))
        for lo in range(0, len(cuts) - 1, _RUN_ROWS):
            at = cuts[lo : lo + _RUN_ROWS + 1]
            part = held.slice(at[0], at[-1] - at[0])
            offsets = pa.array(at - at[0], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, part.column(c).combine_chunks()) for c in _POSTING.names]
            firsts = held.column("term").take(pa.array(at[:-1])).combine_chunks()
            yield pa.RecordBatch.from_arrays([pa.array(shard[at[:-1]]), firsts, *lists], names=["shard", "first", *_POSTING.names])


def indexed(docs: DataFrame, shards: int, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Runs of all blocks; ``docs`` has (lang, source, text) without nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for part in slices(batch):
                for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                    block.add(lang, source, text)
                    if block.postings >= block_postings:
                        yield from block.runs(shards)
                        block = Block()
        yield from block.runs(shards)

    return docs.select("lang", "source", "text").mapInArrow(run, _RUN)


def _added_up(pieces: list[pa.Table]) -> pa.Table:
    """The pieces' postings, equal ones added up."""
    found = pa.concat_tables(pieces).group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("documents", "sum")])
    return found.select([*_KEYS, "n_sum", "documents_sum"]).rename_columns(_POSTING.names)


def merged(runs: Iterable[pa.Table], cut_postings: int = CUT_POSTINGS, open_postings: int = OPEN_POSTINGS) -> Iterator[pa.Table]:
    """Postings of runs that come in the order of their first terms, equal ones added up, in tables that split no term.

    A heap holds what is left of the runs read so far by the first term left. Terms
    before the next run's first one are complete: they are cut off the heap's runs
    and added up together. Where many runs share a term, what is left of them is
    added up into one.
    """
    heap: list[tuple[bytes, int, pa.Table]] = []
    waiting = iter(runs)
    after = next(waiting, None)
    number = 0
    while heap or after is not None:
        read = 0
        while after is not None and read < cut_postings:
            heapq.heappush(heap, (after["term"][0].as_py(), number, after))
            number += 1
            read += after.num_rows
            after = next(waiting, None)
        bound = None if after is None else after["term"][0].as_py()
        done = []
        while heap and (bound is None or heap[0][0] < bound):
            _, _, piece = heapq.heappop(heap)
            terms = piece["term"]
            cut = len(terms) if bound is None else bisect_left(range(len(terms)), bound, key=lambda i: terms[i].as_py())
            done.append(piece.slice(0, cut))
            if cut < len(terms):
                heapq.heappush(heap, (terms[cut].as_py(), number, piece.slice(cut)))
                number += 1
        if done:
            yield _added_up(done)
        if sum(piece.num_rows for _, _, piece in heap) > open_postings:
            rest = _added_up([piece for _, _, piece in heap]).sort_by([(c, "ascending") for c in _KEYS]).combine_chunks()
            heap = [(rest["term"][0].as_py(), number, rest)]
            number += 1
            open_postings = max(open_postings, 2 * rest.num_rows)  # different ones all: no use in trying again soon


def kept_terms(postings: pa.Table, least: int) -> pa.RecordBatch | None:
    """(lang, term, its sources, their counts) of terms that enough of the lang's documents hold."""
    found = postings.group_by(["term", "lang"], use_threads=False)
    found = found.aggregate([("documents", "sum"), ("source", "list"), ("n", "list")])
    found = found.filter(pc.greater_equal(found["documents_sum"], least)).combine_chunks()
    if not found.num_rows:
        return None
    columns = [found["lang"], found["term"].cast(pa.string()), found["source_list"], found["n_list"]]
    return pa.table(columns, names=["lang", "term", "source", "n"]).combine_chunks().to_batches()[0]


_TERMS = "lang string, term string, source array<string>, n array<long>"


def frequencies(runs: DataFrame, shards: int, least: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term, source, n): the kept terms, one row a language and term, merged per shard."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in batches:
            lists = [batch.column(c) for c in _POSTING.names]
            ends = lists[0].offsets.to_numpy()
            whole = pa.table([x.values for x in lists], names=_POSTING.names).cast(_POSTING)
            for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                yield whole.slice(lo, hi - lo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for postings in merged(tables(batches)):
            found = kept_terms(postings, least)
            if found is not None:
                yield found

    dealt = runs.repartitionById(shards, F.col("shard")).sortWithinPartitions("first")
    return dealt.mapInArrow(run, _TERMS)


# ---------------------------------------------------------------- probabilities and pairs


def probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * kept)), exactly; 1 where nothing is kept."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")
    bottom = (total + SMOOTHING * kept).cast("decimal(20,0)")
    share = F.call_function("div", top, F.when(bottom > 0, bottom))
    return F.coalesce(share, F.lit(0)).cast("long") + 1


def _tile_sums(size: int, most: int):
    """A map over (lang, posting) rows: corrections of pairs of sources that share a term, added up by tile of sources."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, int], np.ndarray] = {}

        def left() -> Iterator[pa.RecordBatch]:
            for (lang, a, b), tile in held.items():
                i, j = np.nonzero(tile)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(i), pa.string()), pa.array(i + a * size, pa.int32()),
                        pa.array(j + b * size, pa.int32()), pa.array(tile[i, j]),
                    ],
                    names=["lang", "lo", "hi", "part"],
                )
            held.clear()

        for batch in batches:
            for lang, posting in zip(batch.column("lang").to_pylist(), batch.column("posting"), strict=True):
                values = posting.values
                at, p, base = (values.field(c).to_numpy(zero_copy_only=False) for c in ("at", "p", "base"))
                order = np.argsort(at)
                cuts = np.flatnonzero(np.diff(at[order] // size)) + 1
                parts = list(zip(*(np.split(x[order], cuts) for x in (at, p, base)), strict=True))
                for k, (ai, pi, bi) in enumerate(parts):
                    for aj, pj, bj in parts[k:]:
                        name = (lang, int(ai[0]) // size, int(aj[0]) // size)
                        tile = held.get(name)
                        if tile is None:
                            if len(held) >= most:
                                yield from left()
                            tile = held[name] = np.zeros((size, size), dtype=np.int64)
                        only = np.abs(pi[:, None] - bj) + np.abs(bi[:, None] - pj)
                        add = np.abs(pi[:, None] - pj) - only + np.abs(bi[:, None] - bj)
                        # of a tile on the diagonal the half above it
                        tile[np.ix_(ai % size, aj % size)] += np.triu(add, 1) if aj is ai else add
        yield from left()

    return run


def audit(
    df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    least: int = MIN_DOCUMENTS, top: int = TOP_TERMS, shards: int | None = None,
    block_postings: int = BLOCK_POSTINGS, tile: int = TILE, tiles: int = TILES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): every pair of a language's sources, and each source's leading terms.

    ``shards`` (default: the session's shuffle partitions) cut the terms by hash.
    """
    spark = df.sparkSession
    ship_package(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(*(text_or_empty(F.col(f"`{c}`")).alias(n) for n, c in (("lang", lang), ("source", source), ("text", text))))
    terms = staged(frequencies(indexed(docs, shards, block_postings), shards, least), "source-terms")

    # totals: one row a group, numbered within its language
    sizes = terms.select("lang", F.inline(F.arrays_zip("source", "n"))).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)).alias("whole"))
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = groups.select(
        "lang", "source", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "kept", "whole")),
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("at"),
    ).withColumn("base", probability(F.lit(0).cast("long"), F.col("total"), F.col("kept")))
    groups = staged(groups, "source-groups")

    # each occurring (term, group) with its probability and the language's
    whole = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    postings = terms.select("lang", "term", whole.alias("everywhere"), F.inline(F.arrays_zip("source", "n")))
    postings = postings.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "at", "base",
        probability(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        probability(F.col("everywhere"), F.col("whole"), F.col("kept")).alias("q"),
    )
    postings = staged(postings, "source-postings")

    over = Window.partitionBy("lang", "source").orderBy((F.col("p") - F.col("q")).desc(), "term")
    leading = postings.filter(F.col("p") > F.col("q")).select("*", F.row_number().over(over).alias("rank")).filter(F.col("rank") <= top)
    leading = leading.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"), "rank"
    )
    pairs = _pairs(groups, postings, _tile_sums(tile, tiles))
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank")
    )
    return pairs.unionByName(leading)


def _pairs(groups: DataFrame, postings: DataFrame, tile_sums) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language."""
    # sums over a source's own probabilities below each other source's base
    own = postings.groupBy("lang", "at", "p").agg(F.count("*").alias("n"))
    own = own.select("lang", "at", F.col("p").alias("x"), "n", (F.col("p") * F.col("n")).alias("s"), F.lit(None).cast("int").alias("to"))
    bases = groups.select("lang", F.col("at").alias("to"), F.col("base").alias("x"))
    asked = groups.select("lang", "at").join(bases, "lang").filter(F.col("at") != F.col("to"))
    asked = asked.select("lang", "at", "x", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("s"), "to")
    by = Window.partitionBy("lang", "at")
    # a question stands before equal probabilities: only smaller ones count as below
    below = by.orderBy("x", F.col("to").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    asked = asked.unionByName(own).select(
        "lang", "at", "to", "x",
        F.sum("n").over(below).alias("n_below"), F.sum("s").over(below).alias("s_below"),
        F.sum("n").over(by).alias("n_all"), F.sum("s").over(by).alias("s_all"),
    ).filter(F.col("to").isNotNull())
    # sum of |p - x| over the source's own terms, less the gap of the bases for each
    apart = F.col("s_all") - F.col("x") * F.col("n_all") + 2 * (F.col("x") * F.col("n_below") - F.col("s_below"))
    mine = groups.select("lang", "at", "base", "kept")
    gap = F.abs(F.col("base") - F.col("x"))
    absent = F.when(F.col("at") < F.col("to"), F.col("kept") * gap).otherwise(F.lit(0))  # once a pair
    one = asked.join(mine, ["lang", "at"]).select(
        "lang", F.least("at", "to").alias("lo"), F.greatest("at", "to").alias("hi"),
        (absent + apart - F.col("n_all") * gap).alias("part"),
    )
    shared = postings.groupBy("lang", "term").agg(F.collect_list(F.struct("at", "p", "base")).alias("posting"))
    both = shared.select("lang", "posting").mapInArrow(tile_sums, "lang string, lo int, hi int, part long")
    found = one.unionByName(both).groupBy("lang", "lo", "hi").agg(F.sum("part").alias("value"))
    low, high = (groups.select("lang", F.col("at").alias(n), F.col("source").alias(s)) for n, s in (("lo", "a"), ("hi", "b")))
    found = found.join(low, ["lang", "lo"]).join(high, ["lang", "hi"])
    ways = F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("a", "b"), ("b", "a"))))
    return found.select("lang", F.inline(ways), "value")

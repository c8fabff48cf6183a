"""Bottom-k sketches of shingle hashes.

A sketch is the ascending array of the ``k`` least distinct 64-bit shingle hashes
of a text (all of them where there are fewer). Sketches of parts merge into the
sketch of the whole; two sketches estimate resemblance, containment and the number
of distinct shingles. Built from SQL functions only.

Shingles are five words in a row, a shorter text's whole word sequence is its one
shingle, and a null, empty or wordless text has an empty sketch. Two empty
sketches have likeness 1, an empty and a filled one 0. Hashes are compared as
unsigned numbers by flipping the sign bit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import staged, text_or_empty
from tierline.operators.keys import assign_keys

SHINGLE_WORDS = 5
K = 128
#: Documents that one neighbour group holds, until there would be more than so many groups.
GROUP_ROWS = 2000
MOST_GROUPS = 1 << 20
#: Most groups whose last keys (a few dozen bytes each) are broadcast; beyond it that join shuffles.
BROADCAST_GROUPS = 200_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: str | Column) -> Column:
    """Lower-cased words: runs of characters other than ASCII white space."""
    cut = F.split(F.lower(text_or_empty(text)), "[\\x20\\x09-\\x0D]+")
    return F.array_remove(cut, "")


def shingle_hashes(text: str | Column, size: int = SHINGLE_WORDS) -> Column:
    """Hash of each shingle, in order, repeats included."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))

    def of(h: Column) -> Column:
        count = F.greatest(F.size(h) - (size - 1), F.lit(1))
        return F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(size)))
        )

    return _let(hashed, lambda h: F.when(F.size(h) == 0, F.array().cast("array<long>")).otherwise(of(h)))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def bottom(hashes: Column, k: int = K) -> Column:
    """The k least distinct hashes, ascending as unsigned numbers (kept sign-flipped)."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: str | Column, k: int = K, size: int = SHINGLE_WORDS) -> Column:
    """Array of at most k longs. XORing the hash with the sign bit makes signed order the unsigned order."""
    flipped = F.transform(shingle_hashes(text, size), lambda h: h.bitwiseXOR(F.lit(-(1 << 63))))
    return bottom(flipped, k)


def merge(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Sketch of two parts' union of shingles."""
    return F.slice(F.sort_array(F.array_union(_col(a), _col(b))), 1, k)


def to_text(s: str | Column) -> Column:
    """The sketch as hex digits, 16 a hash, ascending."""
    return F.lower(F.array_join(F.transform(_col(s), lambda h: F.lpad(F.hex(h.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")), ""))


def resemblance(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the two shingle sets: the share of the union's sketch that both hold."""
    a, b = _col(a), _col(b)
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(s: str | Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the k-th least hash's place in [0, 1]."""
    s = _col(s)
    place = (F.element_at(s, F.lit(k)).cast("double") + F.lit(float(1 << 63)) + 1) / F.lit(float(1 << 64))
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / place)


def containment(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds, from resemblance and the union's size."""
    a, b = _col(a), _col(b)
    of_a = distinct_shingles(a, k)
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(of_a == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / of_a))


def merge_parts(df: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts, however many there are.

    Every task first cuts its own rows of a key to k hashes (group limit below the
    exchange), so a key with a third of all rows moves at most k rows per task.
    """
    w = Window.partitionBy(*keys).orderBy("__h")
    least = (
        df.select(*keys, F.explode(column).alias("__h")).distinct()
        .withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k)
    )
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("__h")).alias(column))


# ---------------------------------------------------------------- neighbours


def _order() -> Column:
    """What rows are ordered by: the key (of any type that has an order; null first), then the text's hash."""
    return F.struct("__k", "__h")


def _cuts(docs: DataFrame) -> tuple[DataFrame, int]:
    """((number, cut) of every group's last row in ascending order, how many), from the narrow rows alone.

    The rows are numbered in order without any step that sees them all; every
    ``GROUP_ROWS``-th row and the last one are cuts.
    """
    numbered = assign_keys(docs.select("__k", "__h"), ["__k", "__h"], "__n")
    rows = numbered.agg(F.max("__n")).first()[0] or 0
    size = max(GROUP_ROWS, -(-rows // MOST_GROUPS))
    last = (F.col("__n") % size == 0) | (F.col("__n") == rows)
    cuts = numbered.filter(last).select(F.ceil(F.col("__n") / size).cast("long").alias("__j"), _order().alias("__cut"))
    return staged(cuts.select((F.col("__j") - 1).alias("__j"), "__cut"), "group-cuts"), -(-rows // size)


def _grouped(docs: DataFrame) -> tuple[DataFrame, int]:
    """The rows with their group's number ``__g`` and whether they are its last row, and how many groups there are.

    A group's number is how many cuts lie before the row, found in two steps: among
    the last cuts of blocks of cuts (literals), then among the block's own cuts.
    """
    cuts, groups = _cuts(docs)
    fan = max(1, math.isqrt(max(groups, 1) - 1) + 1)
    blocks = cuts.groupBy(F.floor(F.col("__j") / fan).cast("int").alias("__block")).agg(
        F.sort_array(F.collect_list("__cut")).alias("__own")
    )  # at most the root of the number of groups in a row
    blocks = staged(blocks, "cut-blocks")
    ends = blocks.select("__block", F.element_at("__own", -1).alias("__end")).orderBy("__block").collect()
    kind = docs.schema["__k"].dataType
    known = F.array(*(F.struct(F.lit(r["__end"]["__k"]).cast(kind).alias("__k"), F.lit(r["__end"]["__h"]).alias("__h")) for r in ends))
    rows = docs.withColumn("__o", _order())
    rows = rows.withColumn("__b", F.size(F.filter(known, lambda c: c < F.col("__o"))) if ends else F.lit(0))
    rows = rows.join(F.broadcast(blocks) if groups <= BROADCAST_GROUPS else blocks, F.col("__b") == F.col("__block"))
    rows = rows.withColumn("__in", F.size(F.filter("__own", lambda c: c < F.col("__o"))))
    return rows.select(
        "__k", "__t", "__h", (F.col("__b") * fan + F.col("__in")).alias("__g"),
        (F.element_at("__own", F.col("__in") + 1) == F.col("__o")).alias("__last"),
    ), groups


def with_next_sketch(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """(key, text, next_text, sketch, next_sketch) of each row and its follower in descending key order.

    The last row is followed by the first. Rows go to contiguous ranges of
    about ``GROUP_ROWS`` rows, and a range's last row in ascending order also to the range
    after it, so one shuffle of the texts and one sort give every follower; no step sees
    the whole order. Ranges are cut by key and text together, so many rows of one key, or
    without key, are many ranges; only rows equal in both share one.
    Defined results: keys are of any type with an order; a null text counts as empty;
    equal keys follow one another by their texts' hash; null keys come last; a single
    row follows itself; an empty table gives no rows.
    """
    docs = df.select(F.col(f"`{key}`").alias("__k"), text_or_empty(F.col(f"`{text}`")).alias("__t")).withColumn("__h", F.xxhash64("__t"))
    docs, groups = _grouped(docs)
    own = F.struct(F.col("__g").alias("g"), F.lit(False).alias("copy"))
    ahead = F.struct(F.pmod(F.col("__g") + 1, F.lit(max(groups, 1))).alias("g"), F.lit(True).alias("copy"))
    places = F.when(F.col("__last"), F.array(own, ahead)).otherwise(F.array(own))
    rows = docs.select("__k", "__t", "__h", F.inline(places).alias("__at", "__copy"))
    order = Window.partitionBy("__at").orderBy(F.col("__copy").desc(), F.col("__k").asc_nulls_first(), "__h")
    rows = rows.withColumn("__next", F.lag("__t").over(order)).withColumn("__s", sketch("__t", k))
    rows = rows.withColumn("__next_s", F.lag("__s").over(order)).filter(~F.col("__copy"))
    return rows.select(
        F.col("__k").alias(key),
        F.col("__t").alias(text),
        F.col("__next").alias("next_text"),
        F.col("__s").alias("sketch"),
        F.col("__next_s").alias("next_sketch"),
    )

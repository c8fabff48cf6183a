"""Benchmark decontamination by spaced-seed hashing.

Texts become lower-cased words of letters and digits. A seed is a fixed mask over
consecutive words that looks at some positions and ignores the others, so a window
with substituted words still hashes alike when the substitutions fall on ignored
positions. Test and training windows are joined on their seed hashes; each hit
fixes an alignment of a document with a benchmark item, and the alignment is
verified word by word: it counts when some stretch of ``OVERLAP_WORDS`` words (or
the whole item, if that is shorter) agrees in at least ``SIMILARITY`` of its
positions. Built from SQL functions only.

Short items. The masks find every allowed substitution in a stretch of
``OVERLAP_WORDS`` words, but not in fewer. Items below that have masks of their
length besides, anchored at the item's first word, until every allowed set of
substitutions leaves some mask untouched (:func:`masks_for`). Items under
``1 / (1 - SIMILARITY)`` words allow no substitution and are searched exactly.

Defined results: null, empty and wordless texts have no windows. Each character of
scripts written without spaces is a word. Items with equal words count as one, named
by their least id. An empty benchmark or document table gives no rows. Repeated
documents give one row per distinct key.
"""

from __future__ import annotations

import itertools
import math
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import checked_broadcast, staged, text_or_empty

#: Word positions that each seed looks at.
MASKS: tuple[tuple[int, ...], ...] = ((0, 1, 3, 6, 7), (0, 2, 3, 5, 8))
SIMILARITY = 0.8
OVERLAP_WORDS = 13
#: Fewest positions that a mask of a short item looks at, in items that have more.
LEAST_LOOKS = 4
#: Scripts written without spaces between words.
UNSPACED = "[\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}]"
#: Most benchmark windows of one broadcast (some 60 bytes each); a larger benchmark takes several passes.
BROADCAST_WINDOWS = 1_000_000


def word_hashes(text: str | Column) -> Column:
    """Hash of each lower-cased word of letters and digits, in order."""
    lowered = F.lower(text_or_empty(text))
    lowered = F.when(lowered.rlike(UNSPACED), F.regexp_replace(lowered, f"({UNSPACED})", " $1 ")).otherwise(lowered)
    words = F.array_remove(F.split(lowered, "[^\\p{L}\\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def least_equal(length: int, similarity: float = SIMILARITY) -> int:
    """Fewest equal words of a stretch that counts."""
    return math.ceil(length * similarity - 1e-9)


@cache
def masks_for(length: int, masks: tuple[tuple[int, ...], ...] = MASKS, similarity: float = SIMILARITY) -> tuple[tuple[int, ...], ...]:
    """Positions of an item of ``length`` words to look at besides the windows of ``masks``, for every allowed substitution.

    Each further mask is the one, of those that look at the most positions still
    leaving out an allowed set, that misses the most sets not covered yet; the
    fewest looks are ``LEAST_LOOKS``.
    """
    wrong = length - least_equal(length, similarity)
    looks = [{at + p for p in m} for m in masks for at in range(length - m[-1])]
    open_ = [set(c) for c in itertools.combinations(range(length), wrong)]
    open_ = [c for c in open_ if not any(look.isdisjoint(c) for look in looks)]
    size = length - wrong if length <= LEAST_LOOKS else max(LEAST_LOOKS, (length - wrong + 1) // 2)
    found = []
    while open_:
        some = [c for c in itertools.combinations(range(length), size) if any(x.isdisjoint(c) for x in open_)]
        best = max(some, key=lambda c: sum(x.isdisjoint(c) for x in open_))
        found.append(best)
        open_ = [x for x in open_ if not x.isdisjoint(best)]
    return tuple(found)


def _seed(hashes: str, at: Column, mask: tuple[int, ...], number: int) -> Column:
    return F.xxhash64(F.lit(number), *(F.get(F.col(hashes), at + p) for p in mask))


def _positions(hashes: str, span: int) -> Column:
    """0-based window starts; none where the text is too short."""
    count = F.size(hashes) - (span - 1)
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _windows(df: DataFrame, hashes: str, masks: list[tuple[int, ...]]) -> DataFrame:
    """Add (__at, __plan, __seed): one row per window and mask, whose number is ``__plan``."""
    shortest = min(m[-1] + 1 for m in masks)
    seeds = [
        F.when(F.col("__at") + m[-1] < F.size(hashes), _seed(hashes, F.col("__at"), m, k)) for k, m in enumerate(masks)
    ]
    rows = df.select("*", F.explode(_positions(hashes, shortest)).alias("__at"))
    return rows.select("*", F.posexplode(F.array(*seeds)).alias("__plan", "__seed")).filter(F.col("__seed").isNotNull())


def benchmark_items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, __words, __n): distinct word sequences of at least one word."""
    items = benchmark.select(F.col(item).alias("__item"), word_hashes(text).alias("__words"))
    items = items.filter(F.size("__words") > 0)
    return items.groupBy("__words").agg(F.min("__item").alias("__item")).select("__item", "__words", F.size("__words").alias("__n"))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    masks: tuple[tuple[int, ...], ...] = MASKS,
    similarity: float = SIMILARITY,
    overlap_words: int = OVERLAP_WORDS,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """Verified overlaps, one row per document and item: (key, item, doc_word, item_word, n_words, n_equal).

    The row is the best stretch found: ``n_equal`` of ``n_words`` words agree,
    starting at word ``doc_word`` of the document and ``item_word`` of the item
    (from 0). Documents are never shuffled, only hits are, whatever the benchmark's
    size: its windows are dealt by seed to as many passes over the documents as
    keep each pass's broadcast under ``broadcast_windows`` rows.
    """
    items = staged(benchmark_items(benchmark, item, item_text), "benchmark-items")
    short = [r[0] for r in items.filter(F.col("__n") < overlap_words).select("__n").distinct().collect()]
    # shapes from their first position on, and for which lengths they start where
    starts: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for n in sorted(short):
        for m in masks_for(n, tuple(masks), similarity):
            starts.setdefault(tuple(p - m[0] for p in m), []).append((n, m[0]))
    plans = list(masks) + [m for m in starts if m not in masks]
    wanted = _windows(items, "__words", plans)
    extra = [(k, at) for k, m in enumerate(plans) if m not in masks for at in starts[m]]
    if extra:  # own shapes only where items of their length place them
        anchored = [(F.col("__plan") == k) & (F.col("__n") == n) & (F.col("__at") == at) for k, (n, at) in extra]
        wanted = wanted.filter(reduce(lambda a, b: a | b, anchored, F.col("__plan") < len(masks)))
    wanted = staged(wanted.select("__seed", F.col("__at").alias("__item_at"), "__item", "__n").distinct(), "benchmark-windows")
    passes = max(1, -(-wanted.count() // broadcast_windows))

    hashed = docs.select(F.col(key).alias("__key"), word_hashes(text).alias("__hashes"))
    begin = F.col("__at") - F.col("__item_at")  # document word under the item's first word, may be below 0
    shift = F.greatest(-begin, F.lit(0))
    def found_in(some: DataFrame, windows: DataFrame) -> DataFrame:
        return windows.join(F.broadcast(some), "__seed").select(
            "__key", "__item", begin.alias("__begin"), shift.alias("__shift"),
            F.slice("__hashes", F.greatest(begin, F.lit(0)) + 1, F.col("__n")).alias("__part"),
        )

    windows = _windows(hashed, "__hashes", plans)
    if passes == 1:
        hits = found_in(wanted, windows)
    else:  # equal seeds are in the same pass, on both sides
        share = [F.pmod("__seed", F.lit(passes)) == k for k in range(passes)]
        hits = reduce(DataFrame.unionByName, [found_in(wanted.filter(p), windows.filter(p)) for p in share])
    hits = hits.groupBy("__key", "__item", "__begin").agg(F.first("__part").alias("__part"), F.first("__shift").alias("__shift"))
    hits = hits.join(items, "__item").withColumn(
        "__equal",
        F.transform(
            "__words",
            lambda w, j: F.coalesce(F.get("__part", j - F.col("__shift")) == w, F.lit(False)).cast("int"),
        ),
    )
    length = F.least(F.col("__n"), F.lit(overlap_words))
    stretches = F.transform(
        F.sequence(F.lit(0), F.col("__n") - length),
        lambda s: F.struct(
            F.aggregate(F.slice("__equal", s + 1, length), F.lit(0), lambda a, x: a + x).alias("n_equal"), (-s).alias("s")
        ),
    )
    found = (
        hits.withColumn("__best", F.array_max(stretches))
        .filter(F.col("__best.n_equal") >= F.ceil(length * F.lit(similarity) - F.lit(1e-9)))
        .groupBy("__key", "__item")
        .agg(F.max(F.struct(F.col("__best.n_equal").alias("e"), length.alias("l"), F.col("__best.s").alias("s"), (-F.col("__begin")).alias("b"))).alias("x"))
    )
    return found.select(
        F.col("__key").alias(key),
        F.col("__item").alias(item),
        (-F.col("x.b") - F.col("x.s")).alias("doc_word"),
        (-F.col("x.s")).alias("item_word"),
        F.col("x.l").alias("n_words"),
        F.col("x.e").alias("n_equal"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item; all columns stay.

    Rows are matched by key and text hash together, so a null or repeated key
    never takes a clean row along.
    """
    name = F.struct(F.col(key).alias("k"), F.xxhash64(text).alias("h"))
    found = overlaps(docs.select(name.alias("__name"), F.col(text).alias("text")), benchmark, key="__name")
    bad = staged(found.select(F.col("__name.k").alias("__bad"), F.col("__name.h").alias("__bad_hash")).distinct(), "leaks")
    bad = checked_broadcast(bad)
    return docs.join(bad, docs[key].eqNullSafe(bad["__bad"]) & (F.xxhash64(docs[text]) == bad["__bad_hash"]), "left_anti")

"""Quality rules: a table of thresholds, compiled into one projection.

A rule bounds a measure of a text, or a measure's share of another in thousandths,
from below, above or both. ``verdicts`` turns a whole table of rules into one
projection over the measures: the array of the rules that a text breaks, and
whether it is kept. Comparisons are between whole numbers
(``1000 * measure >= bound * other``), so no result rests on rounding. Built from
SQL functions only; nothing is shuffled.

Measures (:func:`measured`): words are runs of characters other than ASCII white
space; lines are cut at ``\\n`` and count where they hold a word. Repeated words are
the words that lie in some window of ``WINDOW`` words found twice or more in the text,
its first occurrence included; windows are compared by 64-bit hashes of their
words' hashes, sorted by hash inside the text's own row.

Defined results: a null text counts as empty and measures zero everywhere; a share
of a measure that is zero breaks no rule. Ties cannot occur; repeated rows and
null keys are judged one by one, other columns stay, and an empty table gives no
rows. A column named like a measure is replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import text_or_empty

#: Words of a window whose repetition counts.
WINDOW = 3
_SPACE = "[\\x20\\x09-\\x0D]"
_WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"

# Frequent function words of the languages that are judged.
STOP_WORDS: Mapping[str, str] = {
    "de": "das dem den der des die ein eine für im in ist mit nicht sich und von zu",
    "en": "and are as be by for from in is it of on that the this to was with",
    "es": "con de del el en la las los para por que se su un una y",
    "fr": "avec dans de des du en est et la le les par pas pour que qui un une",
}

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "line_chars", "dup_line_chars", "n_repeat_words",
    "n_stop_words", "n_lettered_words", "n_bullet_lines", "n_open_lines",
)


@dataclass(frozen=True)
class Rule:
    """``at_least`` <= measure <= ``at_most``; with ``of``, of the measure's thousandths of that other measure."""

    name: str
    measure: str
    of: str | None = None
    at_least: int | None = None
    at_most: int | None = None

    def broken(self) -> Column:
        value = F.col(self.measure).cast("long")
        scale = F.lit(1).cast("long")
        if self.of is not None:
            value, scale = value * 1000, F.col(self.of).cast("long")
        sides = []
        if self.at_least is not None:
            sides.append(value < scale * self.at_least)
        if self.at_most is not None:
            sides.append(value > scale * self.at_most)
        if not sides:
            raise ValueError(f"rule {self.name} has no bound")
        out = reduce(lambda a, b: a | b, sides)
        return out if self.of is None else (scale > 0) & out


#: Rules whose breach alone is the fixed base of the verdict.
BASE_RULES = (
    Rule("too_few_words", "n_words", at_least=50),
    Rule("repeated_windows", "n_repeat_words", "n_words", at_most=500),
)
#: The threshold table.
RULES = (
    *BASE_RULES,
    Rule("too_many_words", "n_words", at_most=100_000),
    Rule("word_length", "word_chars", "n_words", at_least=2_000, at_most=12_000),
    Rule("symbols", "n_symbols", "n_words", at_most=100),
    Rule("lettered_words", "n_lettered_words", "n_words", at_least=800),
    Rule("stop_words", "n_stop_words", at_least=2),
    # by length, so that a heading repeated in a text of a few lines is no fault
    Rule("duplicate_lines", "dup_line_chars", "line_chars", at_most=300),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", at_most=900),
    Rule("open_lines", "n_open_lines", "n_lines", at_most=300),
)


def _count(items: Column | str, test) -> Column:
    return F.size(F.filter(items, test)).cast("long")


def _length(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + F.length(x))


def _repeated(window: int) -> list[dict[str, Column]]:
    """Steps from ``__h`` (word hashes) to ``n_repeat_words``; each step names columns for the next."""
    count = F.size("__h") - (window - 1)
    at = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    # places by window hash, where any window repeats at all
    placed = F.sort_array(F.transform("__g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    some = F.size(F.array_distinct("__g")) < F.size("__g")

    def equal(a: Column, b: Column) -> Column:
        return F.coalesce(a == F.get(F.col("__s"), b)["g"], F.lit(False))

    again = F.filter("__s", lambda e, j: equal(e["g"], j - 1) | equal(e["g"], j + 1))
    covered = F.transform("__p", lambda p, j: F.least(F.coalesce(F.get(F.col("__p"), j + 1) - p, F.lit(window)), F.lit(window)))
    return [
        {"__g": F.transform(at, lambda i: F.xxhash64(*(F.get(F.col("__h"), i + j) for j in range(window))))},
        {"__s": F.when(some, placed).otherwise(F.array().cast("array<struct<g:bigint,i:int>>"))},
        {"__p": F.sort_array(F.transform(again, lambda e: e["i"]))},
        {"n_repeat_words": F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)},
    ]


def measured(
    df: DataFrame,
    text: str = "text",
    stop_words: Sequence[str] = tuple(sorted({w for words in STOP_WORDS.values() for w in words.split()})),
    window: int = WINDOW,
) -> DataFrame:
    """Add the ``MEASURES`` (longs) of each whole text."""
    kept = [c for c in df.columns if c.lower() not in MEASURES]
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("__row"), text_or_empty(F.col(f"`{text}`")).alias("__t"))
    rows = rows.select(
        "*",
        F.array_remove(F.split("__t", f"{_SPACE}+"), "").alias("__w"),
        F.filter(F.split("__t", "\n"), lambda x: x.rlike(_WORD)).alias("__l"),
    )
    rows = rows.select("*", F.array_distinct("__l").alias("__d"))
    rows = rows.select(
        "__row",
        F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"),
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("__t", f"{_SPACE}+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("__t", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size("__d")).cast("long").alias("n_dup_lines"),
        _length(F.col("__l")).alias("line_chars"),
        (_length(F.col("__l")) - _length(F.col("__d"))).alias("dup_line_chars"),
        _count("__w", lambda w: F.lower(w).isin(*stop_words)).alias("n_stop_words"),
        _count("__w", lambda w: w.rlike("\\p{L}")).alias("n_lettered_words"),
        _count("__l", lambda x: x.rlike("^[\\x20\\t]*[-*•‣·]")).alias("n_bullet_lines"),
        _count("__l", lambda x: x.rlike("(\\.\\.\\.|…)[\\x20\\t\\r]*$")).alias("n_open_lines"),
    )
    for step in _repeated(window):
        rows = rows.select("*", *(c.alias(n) for n, c in step.items()))
    return rows.select(*(F.col("__row")[c].alias(c) for c in kept), *MEASURES)


def verdicts(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``failed_rules`` (names of broken rules, in table order) and ``kept``: the table as one projection."""
    broken = F.array_compact(F.array(*(F.when(r.broken(), F.lit(r.name)) for r in rules)))
    none = reduce(lambda a, b: a & b, [~r.broken() for r in rules])
    return df.select("*", broken.alias("failed_rules"), none.alias("kept"))


def base_failed(rules: Sequence[Rule] = BASE_RULES) -> Column:
    return reduce(lambda a, b: a | b, [r.broken() for r in rules])

"""Personal data by weak supervision.

Candidate spans come from strict patterns (the base spans, which always stay) and
from looser forms of the same kinds: bracketed e-mail addresses, IPv6 addresses,
card numbers of other lengths or with a wrong check digit, phone numbers without a
country prefix. Five labelers vote on every candidate: the strict check, the loose
form, a gazetteer (top-level domains, issuer prefixes, address ranges, area codes),
the words before it, and its direct neighbours. Each vote is for, against or none.

Expectation-maximisation over the vote patterns of all candidates estimates every
labeler's reliability and each pattern's probability; a logistic span classifier is
trained on these soft labels with the votes, kind and length as features, and
accepts or rejects the candidates that are not base spans. Spark counts the
patterns of the whole corpus; there are a few thousand at most, so fitting works on
a bounded table.

Defined results: a null or empty text has no spans. An added span never overlaps a
base span or an added span before it. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import ship_package, slices, with_fields

KINDS = ("email", "ip", "card", "phone")
#: Least probability at which an added span is accepted.
ACCEPT = 0.8
CONTEXT_CHARS = 40

# Gazetteers and context words: fixed values.
TOP_LEVEL = frozenset("com org net edu gov mil int info biz io de fr es it uk nl eu ch at be se no dk fi pl pt us ca au jp".split())
CONTEXT_FOR = {
    "email": ("email", "e-mail", "mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "address", "login", "client"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "whatsapp"),
}
CONTEXT_AGAINST = ("version", "isbn", "issn", "order", "invoice", "serial", "build", "release", "token", "checksum", "page")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"([0-9]++(?:\.[0-9]++){3})|[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOOSE_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}"
    r"(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?)[A-Za-z0-9-]{1,63})+"
)
_LOOSE_IP = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9A-Za-z])")

Span = tuple[int, int, int]  # kind number, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


# ---------------------------------------------------------------- base spans


def base_emails(text: str) -> Iterator[tuple[int, int]]:
    """Around every @: the run of local characters before it and the domain after it.

    Finds what a leftmost search for the whole pattern finds, in linear time.
    """
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def base_ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if m.group(1) and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group(1).split(".")):
            yield m.span()


def base_cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def base_phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(digits_of(m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[Span]:
    """By kind as listed in ``KINDS``, then by start."""
    out: list[Span] = []
    if "@" in text:
        out += [(0, *s) for s in base_emails(text)]
    if _DIGIT.search(text):
        for kind, find in ((1, base_ips), (2, base_cards), (3, base_phones)):
            out += [(kind, *s) for s in find(text)]
    return out


# ---------------------------------------------------------------- candidates and votes


def loose_spans(text: str, base: list[Span]) -> list[Span]:
    """Candidates that are not base spans and overlap none, by kind and start."""
    found: list[Span] = []
    if "(at)" in text or "[at]" in text or "(AT)" in text or "[AT]" in text:
        found += [(0, *m.span()) for m in _LOOSE_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        found += [(1, *m.span()) for m in _LOOSE_IP.finditer(text)]
        found += [(2, *m.span()) for m in _CARD.finditer(text) if 13 <= len(digits_of(m.group())) <= 19]
        found += [(3, *m.span()) for m in _LOOSE_PHONE.finditer(text)]
    if not found:
        return []
    # base spans by start, with the farthest end of those up to each: one search a candidate
    starts = sorted(s for _, s, _ in base)
    reach = list(itertools.accumulate((e for _, _, e in sorted(base, key=lambda b: b[1])), max))
    out, free = [], 0  # candidates come by start, so the last one taken reaches farthest
    for kind, start, end in sorted(found, key=lambda f: (f[1], f[0])):
        before = bisect_left(starts, end)
        if start >= free and (before == 0 or reach[before - 1] <= start):
            free = end
            out.append((kind, start, end))
    return sorted(out)


def _strict(kind: int, text: str, is_base: bool) -> int:
    if is_base:
        return 1
    return -1 if kind == 2 and not luhn(digits_of(text)) else 0


def _loose(kind: int, text: str, is_base: bool) -> int:
    digits = digits_of(text)
    if kind == 0:
        return 1
    if kind == 1:
        return 1 if is_base or text.count(":") == 7 else 0
    if kind == 2:
        groups = [len(g) for g in re.split("[ -]", text)]
        return 1 if groups in ([len(digits)], [4, 4, 4, 4], [4, 6, 5]) else -1
    return 1 if is_base or len(digits) == 10 else 0


def _gazetteer(kind: int, text: str, is_base: bool) -> int:
    digits = digits_of(text)
    if kind == 0:
        last = re.split(r"[^A-Za-z0-9]+", text.rstrip(")]"))[-1].lower()
        return 1 if last in TOP_LEVEL else -1
    if kind == 1:
        return 1 if not digits.startswith("0") or not is_base else -1
    if kind == 2:
        issuer = digits[0] in "4" or digits[:2] in ("34", "37", "51", "52", "53", "54", "55", "65") or digits[:4] == "6011"
        return 1 if issuer and (len(digits) != 15 or digits[0] == "3") else -1
    if is_base:
        return 1 if digits[0] != "0" else -1
    return 1 if digits[0] in "23456789" and digits[3] in "23456789" else -1


def _context(kind: int, before: str) -> int:
    words = re.findall(r"[a-z][a-z-]*", before.lower())[-4:]
    if any(w in CONTEXT_AGAINST for w in words):
        return -1
    return 1 if any(w in CONTEXT_FOR[KINDS[kind]] for w in words) else 0


def _neighbours(before: str, after: str) -> int:
    if before[-1:].isalnum() or after[:1].isalnum() or after[:2].strip("0123456789") in (".", ":") and len(after) > 1 and after[1].isdigit():
        return -1
    return 1 if (not before or before[-1] in " \n\t|(\"'<") and (not after or after[0] in " \n\t|).,;!?\"'>") else 0


def pattern(text: str, span: Span, is_base: bool) -> str:
    """Kind, whether base, five votes and a length class, as text: what the model knows of a span."""
    kind, start, end = span
    part, before, after = text[start:end], text[max(0, start - CONTEXT_CHARS) : start], text[end : end + 2]
    votes = (
        _strict(kind, part, is_base),
        _loose(kind, part, is_base),
        _gazetteer(kind, part, is_base),
        _context(kind, before),
        _neighbours(before, after),
    )
    size = len(digits_of(part)) if kind else len(part)
    return f"{kind}{'b' if is_base else 'c'}{''.join('-0+'[v + 1] for v in votes)}{min(size // 4, 9)}"


# ---------------------------------------------------------------- fitting


@dataclass
class SpanModel:
    """The span classifier's weights; reliabilities (class x labeler x vote) for inspection."""

    weights: np.ndarray | None
    accept: float
    reliability: np.ndarray

    def probability(self, name: str) -> float:
        if self.weights is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(features(name) @ self.weights, -30, 30))))

    def accepts(self, name: str) -> bool:
        known = self.__dict__.setdefault("_known", {})  # at most one entry per pattern
        if name not in known:
            known[name] = self.probability(name) >= self.accept
        return known[name]


def estimate(counts: dict[str, int], rounds: int = 100) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """EM on vote patterns: (posterior per pattern, P(vote | class) per labeler, patterns)."""
    names = sorted(counts)
    n = np.array([counts[p] for p in names], dtype=float)
    kinds = np.array([int(p[0]) for p in names])
    votes = np.array([["-0+".index(v) for v in p[2:7]] for p in names])
    # start: the vote's majority, base spans for sure
    sums = (votes - 1).sum(axis=1)
    posterior = np.clip(0.5 + 0.15 * sums, 0.05, 0.95)
    table = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        for c, p in enumerate((1 - posterior, posterior)):
            for j in range(votes.shape[1]):
                table[c, j] = np.bincount(votes[:, j], weights=n * p, minlength=3) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        prior = np.array([
            (1.0 + (n * posterior)[kinds == k].sum()) / (2.0 + n[kinds == k].sum()) for k in range(len(KINDS))
        ])
        odds = np.log(prior[kinds]) - np.log1p(-prior[kinds])
        for j in range(votes.shape[1]):
            odds = odds + np.log(table[1, j, votes[:, j]]) - np.log(table[0, j, votes[:, j]])
        after = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(after - posterior).max(initial=0) < 1e-9:
            break
        posterior = after
    return posterior, table, names


def features(name: str) -> np.ndarray:
    out = np.zeros(1 + len(KINDS) + 15 + 10)
    out[0] = 1
    out[1 + int(name[0])] = 1
    for j, v in enumerate(name[2:7]):
        out[1 + len(KINDS) + 3 * j + "-0+".index(v)] = 1
    out[1 + len(KINDS) + 15 + int(name[7])] = 1
    return out


def fit(counts: dict[str, int], accept: float = ACCEPT) -> SpanModel:
    """Reliabilities by EM, then ridge logistic regression on the soft labels (Newton steps)."""
    if not counts:
        return SpanModel(None, accept, np.zeros((2, 5, 3)))
    posterior, table, names = estimate(counts)
    x = np.array([features(p) for p in names])
    n = np.array([counts[p] for p in names], dtype=float)
    n = n / n.sum() * min(n.sum(), 1e4)  # the ridge keeps its weight on large corpora
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (n * np.maximum(p * (1 - p), 1e-6))) @ x + np.eye(len(w)), x.T @ (n * (posterior - p)) - w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return SpanModel(w, accept, table)


def pattern_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(pattern, n) of every candidate in the corpus, counted in each task first."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch):
                for t in part.column(0).to_pylist():
                    if t:
                        base = base_spans(t)
                        for spans, is_base in ((base, True), (loose_spans(t, base), False)):
                            for span in spans:
                                p = pattern(t, span, is_base)
                                found[p] = found.get(p, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["pattern", "n"])

    return df.select(text).mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def train(df: DataFrame, text: str = "text", accept: float = ACCEPT) -> SpanModel:
    """Fit on the pattern counts of the whole corpus (a few thousand rows at most)."""
    return fit({r["pattern"]: r["n"] for r in pattern_counts(df, text).collect()}, accept)


# ---------------------------------------------------------------- applying


def find_spans(text: str, model: SpanModel) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans), both by kind and start."""
    base = base_spans(text)
    return base, [s for s in loose_spans(text, base) if model.accepts(pattern(text, s, False))]


def redact_all(text: str, spans: list[Span]) -> str:
    """Redacts the spans, then what only shows once they are gone (a phone number behind which an address stood)."""
    while spans:
        text = redact(text, spans)
        spans = base_spans(text)  # each round leaves fewer digits and at signs
    return text


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, named by the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def _map(df: DataFrame, model: SpanModel, text: str, fields: list[T.StructField], make: Callable) -> DataFrame:
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = with_fields(df.schema, *fields)
    kept = schema.names[: -len(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column(text).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + make(texts, [find_spans(t or "", shared.value) for t in texts]),
                    names=schema.names,
                )

    return df.mapInArrow(run, schema)


SPAN_TYPE = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def detect(df: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``spans`` (all): arrays of (kind, start, end) by kind, then start. Map-only."""

    def arrays(found: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for k, s, e in f] for f in found], _ARROW_SPANS)

    def make(texts: list, found: list) -> list[pa.Array]:
        return [arrays([b for b, _ in found]), arrays([sorted(b + a) for b, a in found])]

    return _map(df, model, text, [T.StructField("base_spans", SPAN_TYPE), T.StructField("spans", SPAN_TYPE)], make)


def redacted(df: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """The rows with every span of ``text`` replaced by its kind, as in ``[EMAIL]``; no base span is left.

    Null texts stay null. Map-only.
    """
    order = df.columns

    def make(texts: list, found: list) -> list[pa.Array]:
        return [pa.array([None if t is None else redact_all(t, b + a) for t, (b, a) in zip(texts, found, strict=True)], pa.string())]

    return _map(df, model, text, [df.schema[text]], make).select(order)


def span_text(spans: str | Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    col = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: str, kind: str) -> Column:
    """How many of the spans are of the kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

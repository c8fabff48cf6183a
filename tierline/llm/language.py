"""Language identification with a blended-spectrum string kernel.

A text is lower-cased; its letters are symbols, and every run of other characters is
one gap. Its features are the distinct n-grams of 1 to ``MAX_N`` symbols: presence, not counts. The
kernel of two texts is the number of n-grams that both hold, divided by the root
of the product of their numbers. The Nystroem method represents a text by its
kernel values with a bounded set of landmark texts, and one-versus-rest kernel
ridge regression on these gives a score per language.

The landmarks, ``LANDMARKS_PER_LANGUAGE`` labelled texts a language (the least by a hash
of key and text), are the method's basis and the only texts that reach the driver. The
regression learns from every labelled text: its normal equations are sums over all of
them, which the tasks add up, one matrix of landmarks by landmarks each. A score bar is
an exact quantile over all held-out texts. Scoring runs on every whole text, in batches:
presence matrix times landmark matrix gives the kernel values, times the regression
weights the scores.

Defined results: null texts and texts without a letter are ``und`` with score 0;
without any labelled text everything is ``und``; ties between languages go to the
first by name. Keys, labels and sources are never features.
"""

from __future__ import annotations

import math
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import ship_package, slices, staged, with_fields

MAX_N = 3
#: Labelled texts a language that the regression learns from: all, however many there are.
SAMPLE_PER_LANGUAGE = math.inf
#: Basis texts a language.
LANDMARKS_PER_LANGUAGE = 32
#: Bits of a symbol in an n-gram's code, and the symbol of a gap, beyond all code points.
_BITS = 21
_GAP = 0x110000
RIDGE = 1e-2
UNDETERMINED = "und"
#: Score of a text that shares nothing with any landmark, and the least distance that a bar keeps from it.
NO_EVIDENCE = 0.5
LEAST_MARGIN = 0.01
#: Share of rightly identified held-out texts whose scores are left aside when a bar is set.
OUTLIERS = 0.002
_ROWS = 128


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    table[[c for c in range(0x110000) if unicodedata.category(chr(c))[0] == "L"]] = True
    return table


_LETTERS: list[np.ndarray] = []  # made once per process


def distinct_grams(text: str) -> np.ndarray | None:
    """Sorted codes of the distinct n-grams, with one gap before and after the text; None without a letter.

    A code holds the code points of its symbols, ``_BITS`` each, so no two n-grams share
    one, and shorter n-grams have smaller codes. Only the longest n-grams are gathered
    from the whole text; every shorter one is the beginning of a longer one or lies at
    the very end.
    """
    if not _LETTERS:
        _LETTERS.append(_letters())
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbols = np.full(len(points) + 2, _GAP, dtype=np.int64)
    inner = symbols[1:-1]
    np.copyto(inner, points, where=_LETTERS[0][points])
    gap = symbols == _GAP
    gap[1:] &= gap[:-1]
    gap[0] = False
    symbols = symbols[~gap]
    if len(symbols) < 2:
        return None
    n = min(MAX_N, len(symbols))
    code = symbols[: len(symbols) - n + 1]
    for i in range(1, n):
        code = (code << _BITS) | symbols[i : len(symbols) - n + 1 + i]
    found = np.unique(code)
    out = [found]
    for k in range(n - 1, 0, -1):
        last = 0
        for symbol in symbols[len(symbols) - k :].tolist():
            last = (last << _BITS) | symbol
        found = found >> _BITS
        found = found[np.append(True, found[1:] != found[:-1])]
        at = int(np.searchsorted(found, last))
        if at == len(found) or found[at] != last:
            found = np.insert(found, at, last)
        out.append(found)
    return np.concatenate(out[::-1])


@dataclass
class LanguageModel:
    """Landmark n-grams, kernel scale and weights; a few MB at most."""

    languages: list[str]
    grams: np.ndarray  # sorted codes that some landmark holds
    landmarks: np.ndarray  # grams x landmarks, presence over the root of the landmark's n-gram number
    weights: np.ndarray  # landmarks x languages


class Scorer:
    """Kernel values and scores, with the lookup tables of one process."""

    def __init__(self, model: LanguageModel):
        self.model = model

    def kernel(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x landmarks kernel values, which texts have a letter)."""
        rows = np.zeros((len(texts), len(self.model.grams)), dtype=np.float32)
        counts = np.zeros(len(texts))
        for i, text in enumerate(texts):
            codes = distinct_grams(text)
            if codes is not None:
                counts[i] = len(codes)
                at = np.minimum(np.searchsorted(self.model.grams, codes), len(self.model.grams) - 1)
                rows[i, at[self.model.grams[at] == codes]] = 1
        return (rows @ self.model.landmarks) / np.sqrt(np.maximum(counts, 1))[:, None], counts > 0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.model.languages:
            return names, scores
        for lo in range(0, len(texts), _ROWS):
            some = [t or "" for t in texts[lo : lo + _ROWS]]
            values, lettered = self.kernel(some)
            values = values @ self.model.weights
            best = values.argmax(axis=1)
            top = values[np.arange(len(some)), best]
            for i in np.flatnonzero(lettered).tolist():
                names[lo + i] = self.model.languages[best[i]]
                scores[lo + i] = min(1.0, max(0.0, (float(top[i]) + 1) / 2))
        return names, scores


def landmark_texts(texts: list[str], labels: list[str], max_landmarks: int = LANDMARKS_PER_LANGUAGE) -> tuple[list[str], list[str]]:
    """(texts, labels) of the first ``max_landmarks`` texts with a letter of each label, in the given order."""
    taken: Counter[str] = Counter()
    found = []
    for text, label in zip(texts, labels, strict=True):
        if taken[label] < max_landmarks and distinct_grams(text) is not None:
            taken[label] += 1
            found.append((text, label))
    return [t for t, _ in found], [name for _, name in found]


def basis(texts: list[str], labels: list[str]) -> LanguageModel:
    """A model on these landmarks, without weights yet."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros((0, 0)))
    sets = [distinct_grams(t) for t in texts]
    grams = np.unique(np.concatenate(sets))
    landmarks = np.zeros((len(grams), len(sets)), dtype=np.float32)
    for j, held in enumerate(sets):
        landmarks[np.searchsorted(grams, held), j] = 1 / np.sqrt(len(held))
    return LanguageModel(languages, grams, landmarks, np.zeros((len(sets), len(languages))))


class Sums:
    """The normal equations of the texts added: classes weigh alike, however many texts of each there are."""

    def __init__(self, model: LanguageModel, counts: Mapping[str, int]):
        """``counts``: texts with a letter of each label, over all data."""
        m = model.landmarks.shape[1]
        self.scorer, self.n = Scorer(model), 0
        self.of = {name: (i, 1 / counts[name]) for i, name in enumerate(model.languages)}
        self.squares, self.means = np.zeros((m, m)), np.zeros((m, len(model.languages)))

    def add(self, texts: list[str], labels: list[str]) -> None:
        known = [i for i, name in enumerate(labels) if name in self.of]
        for lo in range(0, len(known), _ROWS):
            some = known[lo : lo + _ROWS]
            values, lettered = self.scorer.kernel([texts[i] for i in some])
            values = values[lettered].astype(np.float64)
            at = [self.of[labels[i]] for i, there in zip(some, lettered, strict=True) if there]
            own = np.zeros((len(at), self.means.shape[1]))
            own[np.arange(len(at)), [i for i, _ in at]] = [w for _, w in at]
            self.squares += values.T @ (own.sum(axis=1)[:, None] * values)
            self.means += values.T @ own
            self.n += len(at)


def solved(model: LanguageModel, landmark_texts: list[str], squares: np.ndarray, means: np.ndarray, ridge: float = RIDGE) -> LanguageModel:
    """The model with the weights of kernel ridge regression on its Nystroem features, from the sums over all texts."""
    inner = Scorer(model).kernel(landmark_texts)[0].astype(np.float64)
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])  # K_mm to the power -1/2, without its null space
    gram = root.T @ squares @ root + ridge * np.eye(root.shape[1]) / len(model.languages)
    # targets are 1 for a text's own language and -1 for the others
    aims = 2 * means - means.sum(axis=1, keepdims=True)
    weights = root @ np.linalg.solve(gram, root.T @ aims)
    return LanguageModel(model.languages, model.grams, model.landmarks, weights)


def fit(texts: list[str], labels: list[str], max_landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> LanguageModel:
    """Kernel ridge regression on Nystroem features of texts in memory (landmarks in the given order)."""
    chosen, names = landmark_texts(texts, labels, max_landmarks)
    model = basis(chosen, names)
    if not model.languages:
        return model
    sums = Sums(model, Counter(name for t, name in zip(texts, labels, strict=True) if distinct_grams(t) is not None))
    sums.add(texts, labels)
    return solved(model, chosen, sums.squares, sums.means, ridge)


#: One document in so many is held out from training.
HOLD_OUT = 5


def held_out(key: str = "doc_id") -> Column:
    """Whether the key's hash keeps the document out of training; false for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % HOLD_OUT == 0, F.lit(False))


def training_label(key: str = "doc_id", label: str = "lang") -> Column:
    """The label of documents that may be learned from; null for the others."""
    return F.when(F.col(key).isNotNull() & ~held_out(key), F.col(label))


def _labelled(df: DataFrame, label: Column, key: str, text: str) -> DataFrame:
    """(label, text, hash of key and text) of the rows with a label and a letter."""
    rows = df.select(label.alias("__label"), F.col(text).alias("__text"), F.xxhash64(F.col(key), F.col(text)).alias("__h"))
    return rows.filter(F.col("__label").isNotNull() & F.col("__text").rlike("\\p{L}"))


def _least(rows: DataFrame, *order: str) -> DataFrame:
    w = Window.partitionBy("__label").orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= LANDMARKS_PER_LANGUAGE).drop("__r")


def train(df: DataFrame, label: Column, key: str = "doc_id", text: str = "text") -> LanguageModel:
    """Fit on every row whose ``label`` is not null.

    Labels are counted and landmarks found on a written table without texts; only the
    landmarks' texts are fetched. Then one pass over the labelled texts adds up the normal
    equations: a task gives one row a landmark, and a landmark's rows are summed in the
    tasks' order.
    """
    rows = _labelled(df, label, key, text)
    narrow = staged(rows.select("__label", "__h"), "language-labels")
    counts = {r["__label"]: r["n"] for r in narrow.groupBy("__label").agg(F.count("*").alias("n")).collect()}
    least = _least(narrow, "__h").distinct().select(F.col("__label").alias("__of"), F.col("__h").alias("__at"))
    found = rows.join(F.broadcast(least), (F.col("__label") == F.col("__of")) & (F.col("__h") == F.col("__at"))).drop("__of", "__at")
    found = sorted(_least(found, "__h", "__text").collect(), key=lambda r: (r["__h"], r["__text"]))
    texts, labels = landmark_texts([r["__text"] for r in found], [r["__label"] for r in found])
    model = basis(texts, labels)
    if not model.languages:
        return model
    return solved(model, texts, *_summed(rows.select("__text", "__label"), model, counts))


def _summed(rows: DataFrame, model: LanguageModel, counts: Mapping[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The normal equations of all (text, label) rows."""
    spark = rows.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((model, {name: counts[name] for name in model.languages}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(*shared.value)
        for batch in batches:
            for part in slices(batch, _ROWS):
                sums.add(part.column(0).to_pylist(), part.column(1).to_pylist())
        if sums.n:
            values = np.hstack([sums.squares, sums.means])
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(values)), pa.int32()), pa.array([task] * len(values), pa.int32()), pa.array(list(values), pa.list_(pa.float64()))],
                names=["mark", "task", "sums"],
            )

    def add(part: pa.Table) -> pa.Table:
        total = np.sum([row.as_py() for row in part.sort_by("task").column("sums")], axis=0)
        return pa.table({"mark": part.column("mark").slice(0, 1), "sums": pa.array([total], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "mark int, task int, sums array<double>")
    found = parts.groupBy("mark").applyInArrow(add, "mark int, sums array<double>").collect()  # one row a landmark
    m = model.landmarks.shape[1]
    values = np.zeros((m, m + len(model.languages)))
    for r in found:
        values[r["mark"]] = r["sums"]
    return values[:, :m], values[:, m:]


def train_with_bar(df: DataFrame, key: str = "doc_id", label: str = "lang", text: str = "text") -> tuple[LanguageModel, float]:
    """(model, score bar): learned from all labelled rows that are not held out, calibrated on all that are."""
    model = train(df, training_label(key, label), key, text)
    name = F.when(F.col(key).isNotNull() & held_out(key), F.col(label))
    return model, least_score(model, _labelled(df, name, key, text))


def least_score(model: LanguageModel, rows: DataFrame) -> float:
    """Score below which a text counts as being in no learned language.

    Half-way from no evidence to the low scores of the labelled rows (``__text``,
    ``__label``) that the model has not learned from, and ``LEAST_MARGIN``
    above no evidence at least; that margin where there is no rightly identified row.
    """
    least = NO_EVIDENCE + LEAST_MARGIN
    if not model.languages:
        return least
    found = identify(rows.select("__text", "__label"), model, "__text")
    right = staged(found.filter(F.col("lang_pred") == F.col("__label")).select("score"), "language-scores")
    low = exact_quantile(right, "score", OUTLIERS)
    return least if low is None else max(least, (NO_EVIDENCE + low) / 2)


#: Ranges that the values are counted in by each pass of an exact quantile.
_RANGES = 1000


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """The quantile of all values (between two, in proportion), ``None`` without any.

    Each pass counts the values in so many equal ranges and goes on with the range that holds
    both neighbours of the quantile, until that is one value, or two ranges share them.
    """
    value = F.col(column)
    whole = df.agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).first()
    if not whole["n"]:
        return None
    place = share * (whole["n"] - 1)
    first = math.floor(place)
    second = min(first + 1, whole["n"] - 1)
    low, high, below = whole["low"], whole["high"], 0
    while low < high:
        # the range's values lie between two of them
        spot = F.floor((value - F.lit(low)) / F.lit(high - low) * _RANGES)
        df = df.filter(value.between(low, high))
        bins = df.groupBy(spot.alias("spot")).agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        for r in sorted(bins.collect(), key=lambda r: r["spot"]):
            if first < below:  # a range has ended between the neighbours: the second is the least of the next
                return float(np.quantile([low, r["low"]], place - first))
            end = below + r["n"]
            if first < end:
                low, high = r["low"], r["high"]
                if second < end:
                    break
                low = high
            below = end
    return float(low)


_SCORERS: dict[str, Scorer] = {}


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` (string) and ``score`` (double, 0 to 1). Map-only; other columns stay."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    name = uuid.uuid4().hex
    schema = with_fields(df.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()))
    kept = schema.names[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(shared.value)
        scorer = _SCORERS[name]
        for batch in batches:
            for part in slices(batch, _ROWS):
                names, scores = scorer.predict(part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=schema.names,
                )

    return df.mapInArrow(run, schema)

"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

A token file is a folder of two Parquet tables:

* ``ranks`` (rank, id): ids ordered by falling corpus frequency, so the commonest
  256 ids take one byte. Its size is bounded by the vocabulary.
* ``blocks``: whole documents in ascending key order. Every id's rank is stored
  in 1 to 4 little-endian bytes in ``data``; the lengths are two-bit codes, four
  to a byte, in the separate ``control`` column. ``part`` and ``block`` give the
  order, ``first`` the number of ids before the block within its part.

Decoding looks each control byte up in a 256-row table of lengths and scatters
the data bytes with one mask; no id is handled alone.

Defined results: a null or empty text is only the end id; documents with equal
keys follow one another (ordered by their ids), null keys come first.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import ship_package, slices, staged
from tierline.llm.words import WordMemo, cut_punctuation, encode_words

#: Ids after which a block ends (with the document that reaches it).
BLOCK_IDS = 1 << 16
#: Entries of each of the two generations of a worker's word memo, and its longest word.
MEMO_ENTRIES = 450_000
MEMO_KEY_CHARS = 48
#: Words of letters below this are one pre-token each.
_LATIN_END = "\u0100"
_BYTES = np.arange(4)
#: Lengths of the four values that each control byte describes.
LENGTHS = ((np.arange(256)[:, None] >> (2 * _BYTES)) & 3) + 1


# ---------------------------------------------------------------- coding


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(codes) // 4) * 4, dtype=np.uint8)
    padded[: len(codes)] = codes
    control = (padded.reshape(-1, 4) << (2 * _BYTES).astype(np.uint8)).sum(axis=1).astype(np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[_BYTES <= codes[:, None]]
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ``count`` values of a block, by table lookup of the control bytes."""
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    out = np.zeros((count, 4), dtype=np.uint8)
    out[_BYTES < lengths[:, None]] = np.frombuffer(data, dtype=np.uint8)
    return out.view("<u4").reshape(-1)


# ---------------------------------------------------------------- tokenizing


class WordTokenizer:
    """The tokenizers library behind a memo of words.

    The vocabulary's pre-tokenizer drops white space, never joins across it or
    from a word into the punctuation after it, and lower-cases, so a text's ids are
    those of its lower-cased words and punctuation in order. Texts that may hold a
    special token's string go to the library whole.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if size <= 1 << 16 else "<u4"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = WordMemo(self._learn, MEMO_ENTRIES, MEMO_KEY_CHARS)

    def _library(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only: each is one pre-token, so many are encoded as one text."""
        out: list[bytes] = []
        for lo in range(0, len(words), 1000):
            some = words[lo : lo + 1000]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            word = np.array(found.word_ids)
            if not len(word) or word[-1] != len(some) - 1:  # the library cut a word
                out += self._library(some)
                continue
            raw = np.array(found.ids, dtype=self.dtype)
            ends = (np.searchsorted(word, np.arange(1, len(some) + 1)) * raw.itemsize).tolist()
            raw = raw.tobytes()
            out += [raw[s:e] for s, e in zip([0, *ends], ends, strict=False)]
        return out

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words."""
        plain = [w for w in words if w.isalpha() and (w.isascii() or max(w) < _LATIN_END)]
        other = list(set(words).difference(plain))
        return dict(zip(plain, self._letters(plain), strict=True)) | dict(zip(other, self._library(other), strict=True))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as ``dtype``."""
        whole = {i: self._library([t])[0] for i, t in enumerate(texts) if any(s in t for s in self.special)}
        plain = pa.array(["" if i in whole else t for i, t in enumerate(texts)], pa.large_string())
        plain = pc.ascii_lower(pc.replace_substring(plain, "\n", " "))
        lists = pc.split_pattern(cut_punctuation(plain, " "), " ")
        ids, ends = encode_words(lists, self.memo.encode, self.dtype)
        raw = ids.tobytes()
        ends = (ends * ids.itemsize).tolist()
        out = [raw[s:e] for s, e in zip([0, *ends], ends, strict=False)]
        for i, found in whole.items():
            out[i] = found
        return out


_TOKENIZERS: dict[int, WordTokenizer] = {}


def _tokenizer(definition: str) -> WordTokenizer:
    key = hash(definition)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = WordTokenizer(definition)
    return _TOKENIZERS[key]


def encode_ids(df: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): each text's ids and the end id, little-endian ``u2`` or ``u4``."""
    spark = df.sparkSession
    ship_package(spark)
    with open(vocabulary, encoding="utf-8") as f:  # a vocabulary is a few MB
        definition = spark.sparkContext.broadcast(f.read())
    key_field = next(f for f in df.schema.fields if f.name == key)
    schema = T.StructType([key_field, T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(definition.value)
        end = np.array([end_id], dtype=words.dtype).tobytes()
        for batch in batches:
            for part in slices(batch, 2048):
                ids = words.encode_many([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([i + end for i in ids], pa.binary())], names=schema.names
                )

    return df.select(key, text).mapInArrow(run, schema)


def id_dtype(vocabulary: str) -> str:
    with open(vocabulary, encoding="utf-8") as f:
        return WordTokenizer(f.read()).dtype


# ---------------------------------------------------------------- writing and reading


def id_counts(encoded: DataFrame, dtype: str) -> DataFrame:
    """(id, n) over all documents: counted per task first, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            raw = b"".join(x.as_buffer() for x in batch.column(0))
            some = np.bincount(np.frombuffer(raw, dtype=dtype))
            if len(some) > len(total):
                some, total = total, some
            total[: len(some)] += some
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    return encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_file(encoded: DataFrame, dtype: str, path: str, key: str = "doc_id") -> None:
    """Write (key, ids) as a token file at ``path`` (see the module's text).

    ``encoded`` is read three times (counts, range bounds, rows): pass a written table.
    """
    spark = encoded.sparkSession
    ship_package(spark)
    counts = id_counts(encoded, dtype).toPandas()  # at most the vocabulary
    counts = counts.sort_values(["n", "id"], ascending=[False, True])
    ids = [int(i) for i in counts["id"]]
    spark.createDataFrame(list(enumerate(ids)), "rank int, id int").write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max(ids, default=0) + 1, dtype=np.uint32)
    rank_of[ids] = np.arange(len(ids))
    ranks = spark.sparkContext.broadcast(rank_of)

    key_field = next(f for f in encoded.schema.fields if f.name == key)
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("keys", T.ArrayType(key_field.dataType)),
            T.StructField("counts", T.ArrayType(T.LongType())),
            T.StructField("control", T.BinaryType()),
            T.StructField("data", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first = TaskContext.get().partitionId(), 0, 0
        keys: list = []
        raws: list[bytes] = []
        held = 0
        width = np.dtype(dtype).itemsize

        def flush() -> pa.RecordBatch:
            nonlocal block, first, keys, raws, held
            control, data = encode_values(ranks.value[np.frombuffer(b"".join(raws), dtype=dtype)])
            row = [part, block, first, keys, [len(r) // width for r in raws], control, data]
            block, first, keys, raws, held = block + 1, first + held, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=schema.names)

        types = None
        for batch in batches:
            types = types or [
                pa.int32(), pa.int32(), pa.int64(), pa.list_(batch.schema.field(0).type),
                pa.list_(pa.int64()), pa.binary(), pa.binary(),
            ]
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys.append(k)
                raws.append(raw)
                held += len(raw) // width
                if held >= BLOCK_IDS:
                    yield flush()
        if keys:
            yield flush()

    (
        encoded.select(key, "ids")
        .repartitionByRange(F.col(key).asc_nulls_first(), F.xxhash64("ids"))
        .sortWithinPartitions(F.col(key).asc_nulls_first(), "ids")
        .mapInArrow(run, schema)
        .write.option("compression", "none")
        .parquet(f"{path}/blocks")
    )


def read_token_file(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per document of a token file: key, start, n_tokens, ids_crc32 and, if wanted, ids (binary u4).

    ``start`` counts the ids of all documents before it in the file.
    """
    ship_package(spark)
    blocks = spark.read.parquet(f"{path}/blocks")
    pairs = spark.read.parquet(f"{path}/ranks").toPandas()  # at most the vocabulary
    table = np.zeros(len(pairs), dtype="<u4")
    table[pairs["rank"].to_numpy()] = pairs["id"].to_numpy()
    # one row per written part
    sizes = (
        blocks.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
        .groupBy("part").agg(F.sum("n").alias("n")).collect()
    )
    base, total = {}, 0
    for row in sorted(sizes):
        base[row["part"]] = total
        total += row["n"]
    shared = spark.sparkContext.broadcast((table, base))
    key_type = blocks.schema["keys"].dataType.elementType
    fields = [
        T.StructField(key, key_type),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of, first_of = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                part, first, keys, counts, control, data = (batch.column(c)[i] for c in range(6))
                sizes = counts.values.to_numpy()
                ends = np.cumsum(sizes)
                ids = id_of[decode_values(control.as_py(), data.as_py(), int(ends[-1]))]
                raw = ids.tobytes()
                texts = [raw[4 * (e - s) : 4 * e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
                out = [
                    keys.values,
                    pa.array(first_of[part.as_py()] + first.as_py() + ends - sizes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                ]
                if with_ids:
                    out.append(pa.array(texts, pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return blocks.select("part", "first", "keys", "counts", "control", "data").mapInArrow(run, schema)


def tokenize_to_file(df: DataFrame, vocabulary: str, end_id: int, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Encode every text and write the token file at ``path``."""
    encoded = staged(encode_ids(df, vocabulary, end_id, key, text), "token-ids", compression="zstd")
    write_token_file(encoded, id_dtype(vocabulary), path, key)

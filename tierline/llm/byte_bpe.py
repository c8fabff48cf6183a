"""Byte-level BPE encoding and decoding with a segment tree per piece.

A text is cut by the vocabulary's pattern; each piece that is not itself a token
starts as single bytes. A segment tree over the byte positions holds, at each
live position, the rank of the pair that starts there (infinite where there is
none); inner nodes hold the minimum of their children. The root's leftmost
minimum is the next merge. A merge kills the right neighbour and updates three
leaves, each in logarithmic time, so a piece of n bytes costs O(n log n) however
long it is.

Pieces repeat, so each Python worker keeps a bounded memo of encoded pieces. It
holds results only: emptying it never changes an output.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tierline.llm.common import ship_package, slices, with_fields
from tierline.llm.words import WordMemo, cut_punctuation, encode_words

#: Entries of each of the memo's two generations, and the longest text it holds.
MEMO_ENTRIES = 120_000
MEMO_KEY_CHARS = 48
#: Pieces up to this many bytes are merged many at a time, so many rows at once.
ROW_TREE_BYTES = 64
ROW_TREES = 4096
_NONE = 1 << 60
_TWO_SPACES = regex.compile(r"\s\s")
_MARK = "\x01"


def read_ranks(path: str) -> bytes:
    """The rank file's bytes (read on the driver, then broadcast: a vocabulary is a few MB)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece: repeatedly merge the leftmost pair of least rank."""
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    get = ranks.get
    width = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * width)
    for i in range(n - 1):
        tree[width + i] = get(piece[i : i + 2], _NONE)
    for k in range(width - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left <= right else right
    after = list(range(1, n + 1))  # start of the next live token; n at the end
    before = list(range(-1, n - 1))

    def put(position: int, value: int) -> None:
        k = position + width
        tree[k] = value
        while k > 1:
            k >>= 1
            left, right = tree[2 * k], tree[2 * k + 1]
            least = left if left <= right else right
            if tree[k] == least:
                break
            tree[k] = least

    while tree[1] != _NONE:
        least, k = tree[1], 1
        while k < width:
            k *= 2
            if tree[k] != least:
                k += 1
        here = k - width
        gone = after[here]
        then = after[gone]
        after[here] = then
        if then < n:
            before[then] = here
        put(gone, _NONE)
        put(here, get(piece[here : after[then]], _NONE) if then < n else _NONE)
        previous = before[here]
        if previous >= 0:
            put(previous, get(piece[previous:then], _NONE))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class PairRanks:
    """Rank of the token that two tokens make, looked up for whole arrays.

    Holds every way to cut a token into two tokens, as sorted keys.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values(), default=0) + 1
        pairs = {}
        get = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = get(token[:cut]), get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), _NONE, dtype=np.int64)
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], _NONE)


def merge_pieces(pieces: list[bytes], byte_ids: np.ndarray, pair_rank: PairRanks) -> list[bytes]:
    """:func:`merge_piece` for many pieces of similar length at once, one tree a row.

    Every row makes its own next merge in each step; rows without a mergeable
    pair leave. Returns each piece's ids as little-endian u32.
    """
    sizes = np.array([len(p) for p in pieces])
    rows, width = len(pieces), 1 << int(max(1, sizes.max() - 1)).bit_length()
    levels = width.bit_length() - 1
    flat = byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    alive = np.arange(width) < sizes[:, None]
    ids = np.zeros((rows, width), dtype=np.int64)
    ids[alive] = flat
    tree = np.full((rows, 2 * width), _NONE, dtype=np.int64)
    has_pair = alive[:, 1:]
    tree[:, width : 2 * width - 1][has_pair] = pair_rank(ids[:, :-1][has_pair], ids[:, 1:][has_pair])
    for level in range(levels - 1, -1, -1):
        lo = 1 << level
        tree[:, lo : 2 * lo] = np.minimum(tree[:, 2 * lo : 4 * lo : 2], tree[:, 2 * lo + 1 : 4 * lo : 2])
    after = np.tile(np.arange(1, width + 2), (rows, 1))
    before = np.tile(np.arange(-1, width), (rows, 1))
    row = np.flatnonzero(tree[:, 1] != _NONE)

    def put(r: np.ndarray, position: np.ndarray, value: np.ndarray | int) -> None:
        k = position + width
        tree[r, k] = value
        for _ in range(levels):
            k >>= 1
            tree[r, k] = np.minimum(tree[r, 2 * k], tree[r, 2 * k + 1])

    while row.size:
        least, k = tree[row, 1], np.ones(row.size, dtype=np.int64)
        for _ in range(levels):
            k *= 2
            k += tree[row, k] != least
        here = k - width
        gone = after[row, here]
        then = after[row, gone]
        ids[row, here] = least
        alive[row, gone] = False
        after[row, here] = then
        before[row, then] = here
        put(row, gone, _NONE)
        more = then < sizes[row]
        value = np.full(row.size, _NONE, dtype=np.int64)
        value[more] = pair_rank(least[more], ids[row[more], then[more]])
        put(row, here, value)
        previous = before[row, here]
        more = previous >= 0
        r, at = row[more], previous[more]
        put(r, at, pair_rank(ids[r, at], least[more]))
        row = row[tree[row, 1] != _NONE]
    counts = alive.sum(axis=1) * 4
    ends = np.cumsum(counts).tolist()
    out = ids[alive].astype("<u4").tobytes()
    return [out[end - size : end] for end, size in zip(ends, counts.tolist(), strict=True)]


class ByteBpe:
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, data: bytes, pattern: str):
        self.ranks = parse_ranks(data)
        self.find = regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.byte_ids = np.array([self.ranks.get(bytes([b]), 0) for b in range(256)], dtype=np.int64)
        self.pair_rank = PairRanks(self.ranks)
        self.memo = WordMemo(self._learn, MEMO_ENTRIES, MEMO_KEY_CHARS)

    def _merge_all(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces: whole tokens by lookup, the others by merging."""
        out: dict[str, bytes] = {}
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                out[piece] = rank.to_bytes(4, "little")
            elif len(raw) > ROW_TREE_BYTES:
                out[piece] = np.array(merge_piece(raw, self.ranks), dtype="<u4").tobytes()
            else:
                by_width.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for group in by_width.values():
            for lo in range(0, len(group), ROW_TREES):
                some = group[lo : lo + ROW_TREES]
                merged = merge_pieces([raw for _, raw in some], self.byte_ids, self.pair_rank)
                out.update(zip((piece for piece, _ in some), merged, strict=True))
        return out

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of new parts: their pieces' ids in a row, each distinct piece merged once."""
        cut = [self.find(part) for part in parts]
        ids = {piece: self.memo.get(piece) for pieces in cut for piece in pieces}
        fresh = self._merge_all([piece for piece, found in ids.items() if found is None])
        ids |= fresh
        self.memo.put(fresh)
        return {part: b"".join([ids[piece] for piece in pieces]) for part, pieces in zip(parts, cut, strict=True)}

    def _parts(self, texts: list[str]) -> pa.ListArray:
        """Each text as words with the space before them, or as the pattern's pieces.

        The pattern always cuts between a character that is not white space and a
        single space before another such character, so a text without two white
        space characters in a row can be looked up word by word: a mark before
        every space, and before a word's punctuation, is where it is cut.
        """
        cut_by_pattern = {i: self.find(t) for i, t in enumerate(texts) if _TWO_SPACES.search(t) or _MARK in t}
        plain = pa.array(["" if i in cut_by_pattern else t for i, t in enumerate(texts)], pa.large_string())
        lists = pc.split_pattern(cut_punctuation(pc.replace_substring(plain, " ", _MARK + " "), _MARK), _MARK)
        if not cut_by_pattern:
            return lists
        rows = lists.to_pylist()
        for i, pieces in cut_by_pattern.items():
            rows[i] = pieces
        return pa.array(rows, pa.list_(pa.large_string()))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, ends = encode_words(self._parts(texts), self.memo.encode, "<u4")
        raw = ids.tobytes()
        ends = (ends * 4).tolist()
        return [raw[s:e] for s, e in zip([0, *ends], ends, strict=False)]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join(map(tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_CODERS: dict[tuple[int, str], ByteBpe] = {}


def coder(data: bytes, pattern: str) -> ByteBpe:
    """One coder per worker process and vocabulary."""
    key = (hash(data), pattern)
    if key not in _CODERS:
        _CODERS[key] = ByteBpe(data, pattern)
    return _CODERS[key]


def check_pattern_context(pattern: str) -> None:
    """The word-by-word lookup holds for patterns that cut before a single space."""
    if " ?\\p{L}+" not in pattern:
        raise ValueError("the pattern must attach one leading space to the following letters")


def encode_documents(df: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (binary, little-endian u32), ``n_tokens`` and ``decoded`` (binary).

    A null or empty text has no ids and decodes to no bytes. Every other column
    is kept; columns that already have one of the three names are replaced.
    Repeated rows stay rows. Map-only: nothing is shuffled.
    """
    check_pattern_context(pattern)
    spark = df.sparkSession
    ship_package(spark)
    vocab = spark.sparkContext.broadcast(read_ranks(vocabulary))
    schema = with_fields(
        df.schema,
        T.StructField("ids", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("decoded", T.BinaryType()),
    )
    kept = [f.name for f in schema.fields[:-3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocab.value, pattern)
        for batch in batches:
            for part in slices(batch, 1024):
                ids = bpe.encode_many([t or "" for t in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [
                        pa.array(ids, pa.binary()),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([bpe.decode(i) for i in ids], pa.binary()),
                    ],
                    names=kept + ["ids", "n_tokens", "decoded"],
                )

    return df.mapInArrow(run, schema)


def document_digests(
    df: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Key, token count, and digests of the ids and of the bytes decoded from them.

    The digests are taken in the task that encodes, so neither ids nor decoded
    bytes leave the worker, but for the ids (binary, little-endian u32) if they are
    asked for. Same defined results as :func:`encode_documents`.
    """
    check_pattern_context(pattern)
    spark = df.sparkSession
    ship_package(spark)
    vocab = spark.sparkContext.broadcast(read_ranks(vocabulary))
    key_field = next(f for f in df.schema.fields if f.name == key)
    schema = T.StructType(
        [
            key_field,
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
            *([T.StructField("ids", T.BinaryType())] if with_ids else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocab.value, pattern)
        for batch in batches:
            for part in slices(batch, 1024):
                counts, digests, back = [], [], []
                encoded = bpe.encode_many([t or "" for t in part.column(1).to_pylist()])
                for ids in encoded:
                    counts.append(len(ids) // 4)
                    digests.append(hashlib.sha256(ids).hexdigest())
                    back.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())]
                    + ([pa.array(encoded, pa.binary())] if with_ids else []),
                    names=schema.names,
                )

    return df.select(key, text).mapInArrow(run, schema)

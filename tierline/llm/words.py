"""Texts as indexed words: each distinct word of a batch is looked up once, in arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


#: A letter (up to U+00FF) or digit and the ASCII punctuation after it (but for the
#: apostrophe) that ends a word: both vocabularies' patterns cut between the two.
_WORD_END = r"([0-9A-Za-z\x{00C0}-\x{00D6}\x{00D8}-\x{00F6}\x{00F8}-\x{00FF}])([!-&(-/:-@\[-`{-~]+)(%s|$)"


def cut_punctuation(texts: pa.Array, mark: str) -> pa.Array:
    """Put ``mark``, which stands between words, also between a word and the punctuation that ends it."""
    return pc.replace_substring_regex(texts, _WORD_END % mark, rf"\1{mark}\2\3")


class WordMemo:
    """Bounded memo of encoded words, in two generations; it never changes a result.

    ``learn`` encodes the words that the memo lacks.
    """

    def __init__(self, learn: Callable[[list[str]], dict[str, bytes]], entries: int, key_chars: int):
        self.learn, self.entries, self.key_chars = learn, entries, key_chars
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, word: str) -> bytes | None:
        found = self.new.get(word)
        return self.old.get(word) if found is None else found

    def put(self, found: dict[str, bytes]) -> None:
        self.new.update((k, v) for k, v in found.items() if len(k) <= self.key_chars)
        if len(self.new) > self.entries:
            self.old, self.new = self.new, {}

    def encode(self, words: list[str]) -> list[bytes]:
        out = list(map(self.new.get, words))
        missing = [i for i, found in enumerate(out) if found is None]
        older = {}
        for i in missing:
            found = self.old.get(words[i])
            if found is not None:
                older[words[i]] = out[i] = found
        missing = [i for i in missing if out[i] is None]
        fresh = self.learn([words[i] for i in missing]) if missing else {}
        for i in missing:
            out[i] = fresh[words[i]]
        self.put(older)
        self.put(fresh)
        return out


def encode_words(lists: pa.ListArray, encode: Callable[[list[str]], list[bytes]], dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all lists in order, end of each list in ids): every distinct word is encoded once."""
    words = lists.flatten()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    found = encode(coded.dictionary.to_pylist())
    width = np.dtype(dtype).itemsize
    counts = np.array([len(f) // width for f in found], dtype=np.int64)
    flat = np.frombuffer(b"".join(found), dtype=dtype)
    starts = np.cumsum(counts) - counts
    each = counts[index]
    ends = np.concatenate([[0], np.cumsum(each)])
    ids = flat[np.repeat(starts[index] - ends[:-1], each) + np.arange(ends[-1])]
    return ids, ends[np.cumsum(sizes)]

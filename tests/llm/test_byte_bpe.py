from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tierline.llm import byte_bpe, queries

VOCAB = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(byte_bpe.read_ranks(VOCAB), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(bpe):
    made = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    return lambda t: np.array(made.encode_ordinary(t), dtype="<u4").tobytes()


def test_random_texts(bpe, reference):
    rng = random.Random(7)
    parts = ["foo.", "bar, ", "A!!", "é,", "'s", "  ", "\n", " ", "\x1c", "\x85", "\xa0", "漢", "́", "1", "٣", "!", "|", "😀",
             "　", "\x00", "\x01", "T", "don't", "I'LL", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    assert bpe.encode_many(texts) == [reference(t) for t in texts]
    assert [bpe.decode(i) for i in bpe.encode_many(texts)] == [t.encode() for t in texts]


def test_row_trees_equal_single_tree(bpe):
    rng = random.Random(3)
    pieces = [bytes(rng.choice(b"abcdeth ") for _ in range(rng.randint(9, 16))) for _ in range(500)]
    found = byte_bpe.merge_pieces(pieces, bpe.byte_ids, bpe.pair_rank)
    assert found == [np.array(byte_bpe.merge_piece(p, bpe.ranks), dtype="<u4").tobytes() for p in pieces]


def test_long_piece(bpe, reference):
    text = "xy" * 20000 + "  " + "z" * 5000
    assert bpe.encode(text) == reference(text)


def test_memo_turnover_changes_nothing(bpe, reference, monkeypatch):
    monkeypatch.setattr(bpe.memo, "entries", 3)
    texts = [f"word{i % 7} other{i % 5}, and {i}" for i in range(60)]
    for lo in range(0, 60, 6):
        assert bpe.encode_many(texts[lo : lo + 6]) == [reference(t) for t in texts[lo : lo + 6]]


def test_query(spark, sf, documents, reference):
    got = {r.doc_id: r for r in queries.QUERIES["op9_byte_bpe"](spark, sf).collect()}
    for row in documents.collect():
        ids = reference(row.text)
        found = got.pop(row.doc_id)
        assert (found.n_tokens, found.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert found.decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()
    assert not got


def test_odd_rows(make_docs, odd_rows, reference):
    found = byte_bpe.encode_documents(make_docs(odd_rows), VOCAB, public_tokenizers.PATTERN).collect()
    assert len(found) == len(odd_rows)
    for row in found:
        assert bytes(row.ids) == reference(row.text or "") and bytes(row.decoded) == (row.text or "").encode()
        assert row.n_tokens == len(row.ids) // 4 and row.spans == "z"
    assert byte_bpe.document_digests(make_docs([]), VOCAB, public_tokenizers.PATTERN).count() == 0

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierline.llm import queries, token_file
from tierline.session import scratch_path

VOCAB = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCAB)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")


def test_coding_round_trip():
    rng = np.random.default_rng(1)
    for size in (0, 1, 3, 4, 5, 1000):
        values = rng.integers(0, 1 << rng.integers(1, 33, size), size, dtype=np.uint64).astype("<u4")
        control, data = token_file.encode_values(values)
        assert len(control) == -(-size // 4)
        assert (token_file.decode_values(control, data, size) == values).all()
    edges = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], dtype="<u4")
    control, data = token_file.encode_values(edges)
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4
    assert (token_file.decode_values(control, data, len(edges)) == edges).all()


def test_words_equal_whole_texts(tokenizer):
    import random

    rng = random.Random(5)
    words = token_file.WordTokenizer(open(VOCAB, encoding="utf-8").read())
    parts = ["foo.", "Bar, ", "A!!", "é,", "'s", "'ll", " ", "\n", "\t", "\x85", "漢", "́", "1", "!", "İ", "Σ,", "ΑΣ", "<|endoftext|>", "é", "1st", "ª."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    assert words.encode_many(texts) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u2").tobytes() for t in texts]


def test_query(spark, sf, documents, tokenizer):
    got = {r.doc_id: r for r in queries.QUERIES["op3_token_file"](spark, sf).collect()}
    start = 0
    for row in sorted(documents.collect(), key=lambda r: r.doc_id):
        ids = ids_of(tokenizer, row.text)
        found = got.pop(row.doc_id)
        assert (found.start, found.n_tokens, found.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_odd_rows(spark, make_docs, odd_rows, tokenizer, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK_IDS", 10)
    path = scratch_path(spark, "token-test")
    token_file.tokenize_to_file(make_docs(odd_rows), VOCAB, 1, path)
    found = sorted(token_file.read_token_file(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((r[0] for r in odd_rows), key=lambda i: (i is not None, i))
    want = sorted((d, ids_of(tokenizer, t).tobytes()) for d, t in odd_rows if d is not None)
    assert sorted((r.doc_id, bytes(r.ids)) for r in found if r.doc_id is not None) == want
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    counts = {}
    for _, raw in want + [(None, ids_of(tokenizer, "no id here at all").tobytes())]:
        for i in np.frombuffer(raw, dtype="<u4").tolist():
            counts[i] = counts.get(i, 0) + 1
    assert [r.id for r in ranks] == sorted(counts, key=lambda i: (-counts[i], i))


def test_empty(spark, make_docs):
    path = scratch_path(spark, "token-empty")
    token_file.tokenize_to_file(make_docs([]), VOCAB, 1, path)
    assert token_file.read_token_file(spark, path).count() == 0

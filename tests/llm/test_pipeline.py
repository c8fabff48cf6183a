from __future__ import annotations

import hashlib

import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tierline.llm import byte_bpe, decontam, language, pii, simhash


def test_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_against_their_parts(spark, sf, documents):
    """Each stage's rows follow from the operator's definition applied to all its predecessor kept."""
    docs, rows = documents, {r.doc_id: r for r in documents.collect()}
    coder = byte_bpe.ByteBpe(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    kept = {}
    for (name, stage), operator in zip(corpus_pipeline.STAGES, (language, simhash, decontam, pii, byte_bpe), strict=True):
        out = corpus_pipeline.staged(stage(spark, docs, sf), "pipeline-test")
        kept[operator.__name__.rpartition(".")[2]] = found = {r.doc_id: r for r in out.collect()}
        assert len(found) == out.count(), name
        if operator is not byte_bpe:
            assert out.columns == documents.columns
            docs = out
    assert set(kept["language"]) == {k for k, r in rows.items() if any(c.isalpha() for c in r.text or "")}
    prints = sorted((k, simhash.fingerprint(r.text)) for k, r in kept["language"].items())
    label = dict(prints_to_least(prints))
    assert set(kept["simhash"]) == {k for k, least in label.items() if k == least}
    leaks = {r.doc_id for r in decontam.overlaps(documents, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert set(kept["decontam"]) == set(kept["simhash"]) - leaks and leaks & set(kept["simhash"])
    for k, r in kept["pii"].items():
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text) and (r.lang, r.source) == (rows[k].lang, rows[k].source)
    for k, r in kept["byte_bpe"].items():
        text = kept["pii"][k].text
        ids = coder.encode(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest()) and bytes(r.ids) == ids
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert set(kept["byte_bpe"]) == set(kept["decontam"])


def prints_to_least(prints):
    from tests.llm.test_simhash import classes

    keys = [k for k, _ in prints]
    return zip(keys, classes([p for _, p in prints], keys), strict=True)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_tables(spark, tmp_path, make_docs, odd_rows, empty):
    path = f"file://{tmp_path}"
    rows = [] if empty else [(k, t, "en" if k != 6 else None) for k, t in odd_rows]
    make_docs(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([] if empty else [(1, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, path).collect()
    if empty:
        assert found == []
    else:
        # without a letter: 1 to 4; 7 and one row of 6 are copies of 6
        assert sorted((r.doc_id is None, r.doc_id) for r in found) == sorted((k is None, k) for k in (5, 6, 8, 9, 10, 11, None))


def test_language_stage_drops_what_no_learned_language_explains(spark, sf, documents):
    foreign = [
        "Привет, как дела? Это русский текст про кошек и собак.", "漢字仮名交じり文は日本語の文章です", "asdkj qwlkej zxmcn qpwoei lkjqwe",
        "Ez egy magyar mondat amely nem tartozik a tanult nyelvekhez", "Καλημέρα σε όλο τον κόσμο", "zxq wvk jjq xkcd bvnm qwrt",
    ]
    extra = spark.createDataFrame([(-1 - i, t, None, "test", len(t)) for i, t in enumerate(foreign)], documents.schema)
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, documents.unionByName(extra), sf).collect()}
    assert kept == {r.doc_id for r in documents.collect() if any(c.isalpha() for c in r.text or "")}

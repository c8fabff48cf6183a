from __future__ import annotations

import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from tierline.llm import queries, sketch


def chained(*values):
    seed = 42
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", v), seed)
    return seed


def shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").lower()) if w]
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    if not h:
        return set()
    return {chained(*(h[i + j] if i + j < len(h) else None for j in range(5))) for i in range(max(1, len(h) - 4))}


def plain(text, k=sketch.K):
    return sorted(shingles(text))[:k]


def near(a, b, k=sketch.K):
    union = sorted(set(a) | set(b))[:k]
    return len(set(union) & set(a) & set(b)) / len(union) if union else 1.0


def check(rows, got):
    """rows: (key, text) in descending order; got: results by key."""
    for n, (key, text) in enumerate(rows):
        text, after = text or "", rows[(n + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c, row = plain(text), plain(edited), plain(after), got[key]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert row.fingerprint == "".join(f"{v:016x}" for v in a)
        assert row.edited_fingerprint == "".join(f"{v:016x}" for v in b)
        assert row.near_edited == pytest.approx(near(a, b)) and row.near_next == pytest.approx(near(a, c))


@pytest.mark.parametrize("rows_per_group", [2000, 7])
def test_query(spark, sf, documents, monkeypatch, rows_per_group):
    monkeypatch.setattr(sketch, "GROUP_ROWS", rows_per_group)
    got = {r.doc_id: r for r in queries.QUERIES["op8_bottom_k"](spark, sf).collect()}
    check(sorted(((r.doc_id, r.text) for r in documents.collect()), reverse=True), got)


def test_no_python_in_the_plan(spark, sf):
    plan = queries.QUERIES["op8_bottom_k"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_odd_rows(spark, tmp_path, make_docs, odd_rows):
    rows = [(k, t) for k, t in odd_rows if k is not None and (k, t) != odd_rows[5]] + [(odd_rows[5])]
    rows = sorted(set(rows), key=lambda r: -r[0])
    path = f"file://{tmp_path}"
    make_docs(rows).write.parquet(f"{path}/documents.parquet")
    check(rows, {r.doc_id: r for r in queries.QUERIES["op8_bottom_k"](spark, path).collect()})
    assert sketch.with_next_sketch(make_docs(odd_rows)).count() == len(odd_rows)
    assert sketch.with_next_sketch(make_docs([])).count() == 0
    alone = sketch.with_next_sketch(make_docs([(1, "just one")])).first()
    assert alone.next_text == "just one"


def test_estimates_and_merging(spark):
    words = [f"w{i}" for i in range(3000)]
    texts = [(1, " ".join(words[:2000])), (2, " ".join(words[1000:3000])), (3, " ".join(words))]
    df = spark.createDataFrame(texts, "k long, text string").select("k", sketch.sketch("text").alias("s"))
    pairs = df.alias("a").join(df.alias("b"), F.lit(True)).select(
        F.col("a.k").alias("a"), F.col("b.k").alias("b"), sketch.resemblance("a.s", "b.s").alias("r"),
        sketch.containment("a.s", "b.s").alias("c"), sketch.distinct_shingles("a.s").alias("n"),
    )
    found = {(r.a, r.b): r for r in pairs.collect()}
    assert found[1, 2].r == pytest.approx(996 / 2996, abs=0.15) and found[1, 3].c == pytest.approx(1, abs=0.25)
    assert found[1, 1].n == pytest.approx(1996, rel=0.3)
    parts = spark.createDataFrame([("x", " ".join(words[i : i + 404])) for i in range(0, 2600, 400)], "g string, text string")
    merged = sketch.merge_parts(parts.select("g", sketch.sketch("text").alias("sketch")), ["g"]).first()
    whole = sorted(set().union(*(shingles(" ".join(words[i : i + 404])) for i in range(0, 2600, 400))))[: sketch.K]
    assert [(v ^ (1 << 63)) & ((1 << 64) - 1) if v >= 0 else v + (1 << 63) for v in merged.sketch] == whole


def followers(rows):
    """(key, text) -> texts that may follow, brute force over the whole order (null keys last, equal keys by hash)."""
    flip = lambda t: int.from_bytes(xxhash.xxh64(t.encode(), 42).digest(), "big", signed=True)
    order = sorted(((k is not None, k or type(k)() if k is not None else 0, flip(t or ""), t or "", k) for k, t in rows), key=lambda r: r[:3], reverse=True)
    return sorted((r[4] is None, r[4], r[3], order[(i + 1) % len(order)][3]) for i, r in enumerate(order))


@pytest.mark.parametrize("kind", ["string", "long", "date"])
@pytest.mark.parametrize("rows_per_group", [2000, 3])
def test_any_key_repeated_and_null(spark, monkeypatch, kind, rows_per_group):
    """A third of the rows without a key, a third with one key: their texts part them; keys of any type."""
    import datetime as dt

    monkeypatch.setattr(sketch, "GROUP_ROWS", rows_per_group)
    make = {"string": lambda i: f"k{i}", "long": lambda i: i - 50, "date": lambda i: dt.date(2024, 1, 1) + dt.timedelta(i)}[kind]
    rows = [(None, f"null {i}") for i in range(40)] + [(make(7), f"same {i}") for i in range(40)] + [(make(i), f"own {i}") for i in range(40)]
    rows += [(make(7), "same 3"), (make(3), None)]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(5)
    got = sketch.with_next_sketch(df)
    found = sorted((r.doc_id is None, r.doc_id, r.text, r.next_text) for r in got.collect() if r.doc_id is not None)
    assert found == [f for f in followers(rows) if not f[0]]
    assert sorted(r.next_text for r in got.filter("doc_id IS NULL").collect()) == sorted(f[3] for f in followers(rows) if f[0])


def test_hot_keys_are_many_groups(spark, monkeypatch):
    monkeypatch.setattr(sketch, "GROUP_ROWS", 10)
    docs = spark.range(400).select(F.when(F.col("id") % 2 == 0, 7).alias("__k"), F.concat(F.lit("t"), "id").alias("__t"))
    placed, groups = sketch._grouped(docs.withColumn("__h", F.xxhash64("__t")))
    sizes = [r["count"] for r in placed.groupBy("__g").count().collect()]
    assert groups == len(sizes) == 40 and max(sizes) == 10 and placed.filter("__last").count() == 40


def test_no_step_sees_all_rows(spark, sf):
    plan = queries.QUERIES["op8_bottom_k"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "windowspecdefinition(" in plan

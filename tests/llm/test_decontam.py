from __future__ import annotations

import itertools
from collections import defaultdict

import pytest
import regex

from tests.oracle_check import compare, duck
from tierline.llm import decontam, queries


def words(text):
    return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())


def best_overlap(doc, item, length):
    """Most equal positions of any alignment in any stretch of ``length`` item words."""
    at = defaultdict(set)
    where = defaultdict(list)
    for p, w in enumerate(item):
        where[w].append(p)
    for i, w in enumerate(doc):
        for p in where[w]:
            at[i - p].add(p)
    return max((sum(p in s for p in range(a, a + length)) for s in at.values() for a in range(len(item) - length + 1)), default=0)


def test_query(spark, sf, documents):
    got = {(r.doc_id, r.item_id): r for r in queries.QUERIES["op4_decontamination"](spark, sf).collect()}
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {}
    for row in documents.collect():
        doc = words(row.text)
        for item, text in items.items():
            length = min(len(text), 13)
            equal = best_overlap(doc, text, length)
            if equal >= 0.8 * length:
                want[row.doc_id, item] = equal
    assert {k: r.n_equal for k, r in got.items()} == want and want


def test_query_matches_oracle(spark, sf):
    name = "op4_decontamination"
    assert compare(spark, duck(sf), name, queries.QUERIES[name], queries.ORACLE[name], sf)[0] == []


def test_substitutions_and_parts(spark, make_docs):
    item = [f"t{i}" for i in range(40)]
    spoiled = [w if i % 6 else "x" for i, w in enumerate(item)]
    too_much = [w if i % 3 else "x" for i, w in enumerate(item)]
    docs = make_docs([
        (1, "before " * 50 + " ".join(item).upper() + " after"), (2, "a b " + ", ".join(spoiled) + "! c"),
        (3, " ".join(too_much)), (4, "lead " + " ".join(item[10:24])), (5, " ".join(item[10:18])), (6, "clean text only"),
        (7, " ".join(item[30:])), (8, "short five word item here now"),
    ])
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item)), (3, "five word item here now"), (4, "too few"), (5, None)], "item_id long, text string")
    found = {r.doc_id: r for r in decontam.overlaps(docs, bench).collect()}
    assert set(found) == {1, 2, 4, 8}
    assert {r.item_id for r in found.values()} == {1, 3}
    assert (found[1].doc_word, found[1].item_word, found[1].n_words, found[1].n_equal) == (50, 0, 13, 13)
    assert (found[4].doc_word - found[4].item_word) == 1 - 10
    assert sorted(r.doc_id for r in decontam.drop_contaminated(docs, bench).collect()) == [3, 5, 6, 7]


def test_odd_rows(spark, make_docs, odd_rows):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one two three four five six seven"), (None, "never seen words are in this item here")], "item_id long, text string")
    found = decontam.overlaps(make_docs(odd_rows), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(6, 3), (7, 3)]
    kept = decontam.drop_contaminated(make_docs(odd_rows + [(None, "one two three four five six seven")]), bench)
    assert kept.columns == make_docs([]).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted((d or 0, t or "") for d, t in odd_rows if d not in (6, 7))
    assert decontam.overlaps(make_docs([]), bench).count() == 0
    assert decontam.overlaps(make_docs(odd_rows), bench.limit(0)).count() == 0


@pytest.mark.parametrize("length", range(1, 14))
def test_masks_leave_no_allowed_substitution_out(length):
    allowed = length - decontam.least_equal(length)
    looks = [{at + p for p in m} for m in decontam.MASKS for at in range(length - m[-1])] + [set(m) for m in decontam.masks_for(length)]
    for wrong in itertools.combinations(range(length), allowed):
        assert any(look.isdisjoint(wrong) for look in looks), wrong


def test_short_items_with_changed_words(spark, make_docs):
    items = {n: [f"i{n}w{j}" for j in range(n)] for n in range(1, 13)}
    docs, want = [], set()
    for n, item in items.items():
        allowed = n - decontam.least_equal(n)
        for wrong in itertools.combinations(range(n), allowed):
            docs.append((len(docs), " ".join("x" if j in wrong else w for j, w in enumerate(item))))
            want.add((docs[-1][0], n))
        docs.append((len(docs), "a b " + " ".join(w if j > allowed else "x" for j, w in enumerate(item)) + " c d"))
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.overlaps(make_docs(docs), bench).collect()} == want


def test_unspaced_scripts(spark, make_docs):
    bench = spark.createDataFrame([(1, "日本語の文章を読む")], "item_id long, text string")
    docs = make_docs([(1, "前の文。日本語の文章を読む人"), (2, "日本語の大章を読む"), (3, "日本の文を読まない"), (4, "これは何")])
    assert {(r.doc_id, r.n_equal) for r in decontam.overlaps(docs, bench).collect()} == {(1, 9), (2, 8)}


@pytest.mark.parametrize("bound", [1_000_000, 40])
def test_passes_of_a_large_benchmark(spark, make_docs, bound):
    """Several broadcasts find what one finds, a very long document included; no join shuffles windows or word hashes."""
    item = [f"t{i}" for i in range(30)]
    other = [f"u{i}" for i in range(30)]
    filler = [f"w{i}" for i in range(20_000)]
    docs = make_docs([
        (1, " ".join(filler[:9000] + item[3:25] + filler[9000:])), (2, " ".join(filler)), (3, " ".join(other)),
        (4, " ".join("x" if i % 6 == 5 else w for i, w in enumerate(item)) + " and " + " ".join(other[:20])), (5, "five short words in here"),
    ])
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other)), (3, "five short words in here")], "item_id long, text string")
    got = decontam.overlaps(docs, bench, broadcast_windows=bound)
    assert {(r.doc_id, r.item_id, r.n_equal) for r in got.collect()} == {(1, 1, 13), (3, 2, 13), (4, 1, 11), (4, 2, 13), (5, 3, 5)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") >= (1 if bound > 40 else 2)
    physical = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__seed" not in physical

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.oracle_check import compare, duck
from tierline.llm import queries, quality_rules
from tierline.llm.quality_rules import Rule

NAME = "op13_quality_rules"


def plain(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) word by word."""
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    again = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 5000 else len(lines) - len(set(lines))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(again)


def test_query(spark, sf, documents):
    got = {r.doc_id: r for r in queries.QUERIES[NAME](spark, sf).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for row in rows:
        n, chars, symbols, dup, again = plain(row.text)
        r = got[row.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, again)
        assert r.base_failed == (n < 50 or 100 * again > 50 * n)
        assert r.kept == (r.failed_rules == "") and not (r.kept and r.base_failed)


def test_query_matches_oracle(spark, sf):
    assert compare(spark, duck(sf), NAME, queries.QUERIES[NAME], queries.ORACLE[NAME], sf)[0] == []


def test_good_documents_stay(spark, sf):
    """Of the documents labelled good, only base rules drop any; junk goes."""
    rows = queries.QUERIES[NAME](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert good and all(r.kept for r in good)
    bad = [r for r in rows if r.quality == 0]
    assert bad and not any(r.kept for r in bad)


def test_plan_is_one_map_only_projection_without_python(spark, sf):
    plan = queries.QUERIES[NAME](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Exchange", "Sort "))


def test_odd_rows(spark, make_docs, odd_rows):
    rows = odd_rows + [(20, "a b c a b c"), (21, "x\nx\n \nx\ny"), (22, "w " * 70000 + "# | \n" * 3), (23, "a a a a")]
    got = quality_rules.verdicts(quality_rules.measured(make_docs(rows)))
    assert set(make_docs([]).columns) < set(got.columns)
    found = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect())
    assert found == sorted((d or 0, *plain(t)) for d, t in rows)
    assert quality_rules.measured(make_docs([])).count() == 0
    clash = make_docs(rows).withColumn("N_WORDS", F.lit("x")).withColumn("__t", F.lit(1)).withColumn("a.b", F.lit(2))
    out = quality_rules.measured(clash)
    assert out.count() == len(rows) and {"__t", "a.b"} <= set(out.columns) and "N_WORDS" not in out.columns


def test_rules(spark, make_docs):
    good = " ".join(f"the word{i} of them" for i in range(30))
    cases = {
        1: (good, []),
        2: (good.replace("word", "#wo##rd"), ["symbols"]),
        3: (" ".join(f"{i}" for i in range(99)) + " the of", ["word_length", "lettered_words"]),
        4: (" ".join(f"zzz{i}" for i in range(60)), ["stop_words"]),
        5: ("\n".join(f"- the point{i} of it" for i in range(20)), ["bullet_lines"]),
        6: ("\n".join(f"the point{i} of it…" for i in range(20)), ["open_lines"]),
        7: ("heading\n" + good + "\nheading", []),
        8: (good + "\n" + "\n".join(["one line that is there and there again"] * 9), ["duplicate_lines"]),
        9: ("the of", ["too_few_words"]),
        10: (None, ["too_few_words", "stop_words"]),
    }
    got = quality_rules.verdicts(quality_rules.measured(make_docs([(k, t) for k, (t, _) in cases.items()])))
    found = {r.doc_id: r.failed_rules for r in got.collect()}
    assert {k: [n for n in v if n != "repeated_windows"] for k, v in found.items()} == {k: w for k, (_, w) in cases.items()}


def test_own_table(spark, make_docs):
    rules = [Rule("long", "n_words", at_least=3), Rule("dense", "word_chars", "n_words", at_most=2500)]
    got = quality_rules.verdicts(quality_rules.measured(make_docs([(1, "aa bb"), (2, "aaa bbb ccc"), (3, "aa bb cc"), (4, "")])), rules)
    assert {r.doc_id: r.failed_rules for r in got.collect()} == {1: ["long"], 2: ["dense"], 3: [], 4: ["long"]}
    with pytest.raises(ValueError, match="no bound"):
        Rule("x", "n_words").broken()

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.oracle_check import compare, duck
from tierline.llm import divergence, queries

NAME = "op12_source_divergence"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, least, top=50):
    """All sums by hand, from (lang, source, text) rows."""
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered(text))
        counts[lang, source].update(found)
        held[lang].update(set(found))
    out = []
    for lang in {r[0] for r in rows}:
        terms = [t for t, n in held[lang].items() if n >= least]
        sources = sorted({s for x, s, _ in rows if x == lang}, key=str.encode)
        v = len(terms)

        def share(count, v=v, terms=terms):
            total = sum(count[t] for t in terms)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * v) for t in terms}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in terms), o) for o in sources if o != s]
            lead = [(p[s][t] - q[t], t) for t in terms if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", lead)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, x, k) for k, (x, i) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def test_query_matches_oracle(spark, sf):
    assert compare(spark, duck(sf), NAME, queries.QUERIES[NAME], queries.ORACLE[NAME], sf)[0] == []


def test_query(spark, sf, documents):
    got = queries.QUERIES[NAME](spark, sf)
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    assert rows_of(got) == plain([(r.lang, r.source, r.text) for r in documents.collect()], 30)


ROWS = [
    ("en", f"s{i % 7}", " ".join(f"{'abcdé'[j % 5]}{'xyz'[(i * j) % 3]}" for j in range(i % 11))) for i in range(60)
] + [
    (None, None, None), ("", "x", "One one ONE"), ("xx", "only", "word 漢字 word"), ("xx", None, ""), ("yy", "a", None),
    ("yy", "b", "..."), ("en", "never", None), ("en", "S0", "a_b1c"), ("en", "é", "Ünï"), ("en", "é", "Ünï"),
]


@pytest.mark.parametrize(("least", "options"), [
    (1, {}), (2, {"block_postings": 1, "shards": 3, "tile": 2, "tiles": 1}), (3, {"block_postings": 5, "shards": 1, "tile": 3, "tiles": 2}),
    (1000, {"block_postings": 20}),
])
def test_odd_rows_and_small_blocks(spark, least, options):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "doc_id long, lang string, source string, text string")
    df = df.withColumn("item", F.lit(1)).withColumn("rank", F.lit("x")).withColumn("n", F.lit(2))
    assert rows_of(divergence.audit(df.repartition(4), least=least, **options)) == plain(ROWS, least)


def test_top_terms_and_empty(spark):
    rows = [("en", s, " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(lo, hi))) for s, lo, hi in (("a", 0, 200), ("b", 100, 300))]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert rows_of(divergence.audit(df, least=1, top=7)) == plain(rows, 1, top=7)
    assert divergence.audit(df.limit(0)).count() == 0


def table_of(total):
    keys = sorted(total)
    term, lang, source = zip(*keys, strict=True)
    columns = [term, lang, source, [total[k] for k in keys], [1] * len(keys)]
    return pa.table([pa.array(c, t) for c, t in zip(columns, divergence._POSTING.types, strict=True)], names=divergence._POSTING.names)


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.lists(st.tuples(st.sampled_from([b"a", b"b", b"c", b"d", b"\xc3\xa9"]), st.sampled_from("xy"), st.integers(1, 3)), max_size=9), max_size=6),
    st.sampled_from([1, 4, 1000]), st.sampled_from([1, 5, 1000]),
)
def test_merging_runs(runs, cut, open_):
    made, want = [], Counter()
    for postings in runs:
        total = Counter()
        for term, lang, n in postings:
            total[term, lang, "s"] += n
        want.update(total)
        if total:
            made.append(table_of(total))
    found, seen = Counter(), []
    for part in divergence.merged(sorted(made, key=lambda t: t["term"][0].as_py()), cut, open_):
        rows = part.to_pylist()
        found.update({(r["term"], r["lang"], r["source"]): r["n"] for r in rows})
        assert len({tuple(r[c] for c in ("term", "lang", "source")) for r in rows}) == len(rows)
        assert not seen or max(seen) < min(r["term"] for r in rows)  # no term is split
        seen = [r["term"] for r in rows]
    assert found == want


def test_heap_holds_only_runs_that_have_begun():
    opened = []

    def runs():
        for i in range(100):
            opened.append(i)
            yield table_of({(b"%03d" % i, "x", "s"): 1})

    for k, part in enumerate(divergence.merged(runs(), cut_postings=1)):
        assert part["term"][0].as_py() == b"%03d" % k and len(opened) <= k + 3


def test_one_term_in_all_runs_is_added_up():
    found = list(divergence.merged((table_of({(b"t", "x", "s"): 2}) for _ in range(5000)), cut_postings=10, open_postings=100))
    assert [t.to_pylist() for t in found] == [[{"term": b"t", "lang": "x", "source": "s", "n": 10000, "documents": 5000}]]

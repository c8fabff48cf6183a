from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.oracle_check import compare, duck
from tierline.llm import queries, url_reputation


def test_query_matches_oracle(spark, sf):
    name = "op1_url_reputation"
    assert compare(spark, duck(sf), name, queries.QUERIES[name], queries.ORACLE[name], sf)[0] == []


URLS = [
    ("https://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
    ("http://badexample.org/en/17", "badexample.org", "/en/17", "org/", "allow"),
    ("http://x.com/fr/1", "x.com", "/fr/1", "com/fr/", "allow"), ("http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    ("http://x.com/fr", "x.com", "/fr", None, "allow"), ("http://x.org?u=/es/", "x.org", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"), ("x.org/es/", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("", "", "", None, "allow"), ("http://É.org/", "É.org", "/", "org/", "allow"), ("http://org/#", "org", "/", "org/", "allow"),
]


def test_rules_and_cuts(spark):
    pages = spark.createDataFrame([(i, u[0], 1, "c") for i, u in enumerate(URLS)], "page_id long, url string, host int, __host string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = {r.page_id: r for r in url_reputation.judge_urls(pages, none, queries.URL_RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), URLS[i]


def test_shrinkage(spark):
    hosts = [(f"h{i}.good.net", 40, 2) for i in range(10)] + [(f"h{i}.bad.net", 40, 36) for i in range(10)]
    hosts += [("new.bad.net", 0, 0), ("new.good.net", 0, 0), ("once.good.net", 1, 1), ("elsewhere.org", 0, 0)]
    df = spark.createDataFrame(hosts, "host string, n long, bad long")
    found = {r.host: r for r in url_reputation.reputations(df).collect()}
    assert found["h1.bad.net"].bound > 0.5 > found["h1.good.net"].bound
    assert found["new.bad.net"].mean > 0.7 > 0.3 > found["new.good.net"].mean
    assert found["once.good.net"].mean < 0.5 and found["new.bad.net"].bound < found["new.bad.net"].mean
    pages = spark.createDataFrame([(1, "http://h1.bad.net/"), (2, "http://h1.good.net/")], "page_id long, url string")
    outcomes = df.select(F.concat(F.lit("http://"), "host", F.lit("/")).alias("url"), F.explode(F.expr("transform(sequence(1, cast(n as int)), i -> i <= bad)")).alias("bad"))
    judged = {r.page_id: r.verdict for r in url_reputation.judge_urls(pages, outcomes.filter("bad is not null"), {}).collect()}
    assert judged == {1: "block", 2: "allow"}


def test_strength_bounds(spark):
    same = spark.createDataFrame([(f"h{i}.a.net", 100, 10) for i in range(5)], "host string, n long, bad long")
    found = url_reputation.reputations(same).collect()
    assert all(r.mean == pytest.approx(0.1, abs=0.01) for r in found)


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_reputation.judge_urls(pages, spark.createDataFrame([], "url string, bad boolean"), {}).count() == 0


CUTS = [
    ("a.b.bad.co.uk", "bad.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("uk", "uk", "uk"), ("x.uk", "x.uk", "uk"), ("", "", ""),
    ("www.x.blogspot.co.uk", "x.blogspot.co.uk", "blogspot.co.uk"), ("blogspot.co.uk", "blogspot.co.uk", "blogspot.co.uk"),
    ("me.github.io", "me.github.io", "github.io"), ("notco.uk", "notco.uk", "uk"), ("a.example.com", "example.com", "com"),
]


def test_longest_public_suffix(spark):
    host = F.col("host")
    cut = spark.createDataFrame([(c[0],) for c in CUTS], "host string").select(
        host, url_reputation.registered_domain(host, url_reputation.PUBLIC_SUFFIXES), url_reputation.suffix(host, url_reputation.PUBLIC_SUFFIXES)
    )
    assert [tuple(r) for r in cut.collect()] == CUTS


def test_sites_under_a_public_suffix_are_apart(spark):
    hosts = [(f"h{i}.bad.co.uk", 40, 36) for i in range(10)] + [(f"h{i}.good.co.uk", 40, 2) for i in range(10)]
    hosts += [("new.bad.co.uk", 0, 0), ("new.good.co.uk", 0, 0)]
    df = spark.createDataFrame(hosts, "host string, n long, bad long")
    found = {r.host: r.mean for r in url_reputation.reputations(df, url_reputation.PUBLIC_SUFFIXES).collect()}
    assert found["new.bad.co.uk"] > 0.7 > 0.3 > found["new.good.co.uk"]


def test_query_on_public_suffixes_and_odd_pages(spark, tmp_path):
    """Repeated rows, very long urls, clashing names, sites under public suffixes: as the SQL says."""
    path = f"file://{tmp_path}"
    urls = [f"https://h{i % 3}.{'bad' if i % 2 else 'good'}.co.uk/en/{i}" for i in range(60)] + [f"http://x{i}.github.io/fr/{i}" for i in range(60, 70)]
    urls += ["http://long.example.net/" + "a/" * 50000, "http://" + "l." * 500 + "example.com/de/1", None, "", "no scheme", "http://co.uk/en/3"]
    rows = [(i, u, "<p>", "h", "p", "r") for i, u in enumerate(urls)]
    schema = "page_id long, url string, html string, host string, path string, bad string"
    spark.createDataFrame(rows + rows[:30], schema).write.parquet(f"{path}/pages.parquet")
    labels = [(i, 0 if i % 2 else 1, 0) for i in range(70)] + [(1, None, None), (3, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    name = "op1_url_reputation"
    import duckdb

    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert compare(spark, con, name, queries.QUERIES[name], queries.ORACLE[name], path)[0] == []
    got = queries.QUERIES[name](spark, path)
    assert got.count() == len(rows) + 30 and got.columns == ["page_id", "host", "path", "rule", "verdict"]
    verdicts = {r.host: r.verdict for r in got.collect()}
    assert verdicts["h1.bad.co.uk"] == "block" and verdicts["h0.good.co.uk"] == "allow"

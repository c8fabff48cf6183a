"""Config-driven jobs, model review/enrichment jobs, and source helpers."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tierline.operators import enrich, incremental, profile, similar
from tierline.plans import jobs
from tierline.sources.files import load_fixture
from tierline.sources.tables import LoadLog, ensure_log, read_log
from tierline.streaming.bronze import csv_stream, ingest_files, read_bronze
from tests.test_jobs import write_csv


def test_metadata_jobs_bronze_silver_gold(spark, workdir):
    lake = jobs.Lake(f"{workdir}/lake")
    write_csv(f"{workdir}/catalog", "p.csv", ["product_name", "category", "price"],
              [["  Lamp ", "HOME", "1200"], ["Desk", "Office", "700"], ["pen", "office", "3"]])
    bronze_cfg = {"source": {"path": f"{workdir}/catalog", "format": "csv"},
                  "target": {"table": "product_catalog"}, "options": {"header": True, "inferSchema": True}}
    assert jobs.metadata_bronze_job(spark, lake, bronze_cfg) == 3
    silver_cfg = {"source": {"table": "product_catalog"}, "target": {"table": "product_catalog"},
                  "cleaning_rules": [{"column": "product_name", "action": "trim"},
                                     {"column": "category", "action": "lower"},
                                     {"column": "price", "action": "band", "target": "price_category"}]}
    jobs.metadata_silver_job(spark, lake, silver_cfg)
    gold_cfg = {"source": {"table": "product_catalog"}, "target": {"table": "category_sales"},
                "aggregation": {"group_by": ["category"]},
                "metrics": [{"column": "price", "function": "sum", "alias": "total"},
                            {"column": "*", "function": "count", "alias": "n"}]}
    jobs.metadata_gold_job(spark, lake, gold_cfg)
    from tierline.sources.tables import VersionedTable

    silver = VersionedTable(spark, lake.layer("silver", "product_catalog")).read()
    assert sorted((r.product_name, r.category, r.price_category) for r in silver.collect()) == [
        ("Desk", "office", "Standard"), ("Lamp", "home", "Premium"), ("pen", "office", "Budget")
    ]
    gold = VersionedTable(spark, lake.layer("gold", "category_sales")).read()
    assert sorted((r.category, r.total, r.n) for r in gold.collect()) == [("home", 1200, 1), ("office", 703, 2)]
    metrics = spark.read.parquet(lake.system("metrics")).collect()
    assert [(m.job_name, m.status, m.records_processed) for m in metrics] == [("bronze_ingestion", "SUCCESS", 3)]


def test_metadata_bronze_failure_is_logged_then_raised(spark, workdir):
    lake = jobs.Lake(f"{workdir}/lake")
    cfg = {"source": {"path": f"{workdir}/missing", "format": "csv"}, "target": {"table": "t"}, "options": {}}
    with pytest.raises(Exception):
        jobs.metadata_bronze_job(spark, lake, cfg)
    m = spark.read.parquet(lake.system("metrics")).first()
    assert m.status == "FAILED" and m.records_processed == 0 and m.error


def test_review_job_runs_model_on_executors(spark, workdir):
    lake = jobs.Lake(f"{workdir}/lake")
    df = spark.createDataFrame(
        [(i, f"n{i}", "DE" if i % 2 else None, 150000.0 + i) for i in range(250)],
        "employee_id int, first_name string, country string, salary double",
    ).filter(F.col("salary") > 149975)
    for run in range(2):  # counts this run's rows, not those of the runs before; the second run has all answers
        n = jobs.review_job(spark, lake, df, "silver_employee", "salary_anomaly", ["employee_id", "first_name", "country",
                            "salary"], "Employee {first_name} in {country} earns {salary}", enrich.digest_scorer)
        assert (n.reviewed, n.calls) == (250, 0 if run else 250)
    rows = spark.read.parquet(lake.system("ai_results")).collect()
    top = max(rows, key=lambda r: r.input_record)
    assert len(top.ai_result) == 64
    assert any('"country":null' in r.input_record for r in rows)


def test_enrich_csv_job(spark, workdir):
    write_csv(f"{workdir}/vocab", "v.csv", ["German", "English", "Urdu"], [["Haus", "house", "ghar"], ["Baum", "tree", "darakht"]])
    prompt = F.concat(F.lit("Write one B1 sentence with: "), F.col("German"), F.lit("."))
    jobs.enrich_csv_job(spark, f"{workdir}/vocab", f"{workdir}/out", prompt, lambda ps: [p.upper() for p in ps],
                        "B1_example", ["German", "B1_example", "English", "Urdu"])
    out = spark.read.option("header", "true").csv(f"{workdir}/out")
    assert out.columns == ["German", "B1_example", "English", "Urdu"]
    assert sorted(r.B1_example for r in out.collect()) == ["WRITE ONE B1 SENTENCE WITH: BAUM.",
                                                           "WRITE ONE B1 SENTENCE WITH: HAUS."]


def test_rescued_json_rows(spark, workdir):
    src = f"{workdir}/json"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        f.write('{"id": "1", "name": "a"}\n{"id": 2, "name": \n{"id": "3", "name": "c"}\n')
    ingest_files(spark, src, f"{workdir}/b", f"{workdir}/c", "json", schema="id string, name string",
                 rescue_column="_rescued_data")
    got = sorted(((r.id or ""), r._rescued_data is not None) for r in read_bronze(spark, f"{workdir}/b").collect())
    assert got == [("", True), ("1", False), ("3", False)]


def test_csv_stream_persists_names(spark, workdir):
    write_csv(f"{workdir}/crm", "c.csv", ["id", "name"], [["1", "a"]])
    s = csv_stream(spark, f"{workdir}/crm", f"{workdir}/schema")
    assert s.isStreaming and s.columns == ["id", "name"]
    write_csv(f"{workdir}/crm", "d.csv", ["id", "name", "extra"], [["2", "b", "x"]])
    assert csv_stream(spark, f"{workdir}/crm", f"{workdir}/schema").columns == ["id", "name"]


def test_fixture_loader_and_ensure_log(spark, workdir):
    write_csv(workdir, "f.csv", ["a", "b"], [["1", "x"]])
    assert load_fixture(spark, f"{workdir}/f.csv", "a int, b string").first().a == 1
    with pytest.raises(ValueError):
        load_fixture(spark, f"{workdir}/f.txt", "a int")
    ensure_log(spark, f"{workdir}/marks", incremental.MARK_SCHEMA)
    ensure_log(spark, f"{workdir}/marks", incremental.MARK_SCHEMA)
    log = read_log(spark, f"{workdir}/marks")
    assert log.count() == 0 and log.columns == incremental.MARK_SCHEMA.fieldNames()


def test_answers_are_asked_once_and_failures_again(spark, workdir):
    """Equal prompts are one call; a rerun asks only what failed or is new; a failed call's message is that run's answer."""
    answers = LoadLog(spark, f"{workdir}/answers")
    df = spark.createDataFrame([("a",), ("a",), ("bad",), (None,), ("b",)], "p string")

    def failing(prompts):
        if "bad" in prompts:
            raise ValueError("no")
        return [p.upper() for p in prompts]

    out, calls = jobs.ask(spark, answers, df, "p", failing, "r")
    got = sorted(((r.p or ""), r.r) for r in out.collect())
    assert calls == 3 and got == [("", None), ("a", "A"), ("a", "A"), ("b", "B"), ("bad", "AI call failed: no")]
    more = df.unionByName(spark.createDataFrame([("c",)], "p string"))
    out, calls = jobs.ask(spark, answers, more, "p", lambda ps: [p + "!" for p in ps], "r")
    assert calls == 2 and {r.p: r.r for r in out.collect()} == {None: None, "a": "A", "b": "B", "bad": "bad!", "c": "c!"}
    out, calls = jobs.ask(spark, answers, more, "p", failing, "r")
    assert calls == 0 and {r.p: r.r for r in out.collect()} == {None: None, "a": "A", "b": "B", "bad": "bad!", "c": "c!"}
    none, calls = jobs.ask(spark, LoadLog(spark, f"{workdir}/none"), df.limit(0), "p", failing, "r")
    assert calls == 0 and none.columns == ["p", "r"] and none.count() == 0


def test_profiles_merge(spark, workdir):
    rows = spark.createDataFrame(
        [(i, float(i) / 7 if i % 5 else None, f"n{i % 300}", D(i) / 4, dt.date(2024, 1, 1 + i % 28)) for i in range(3000)],
        "a long, b double, c string, d decimal(12,2), e date",
    )
    found = []
    for k in range(3):
        n, some = profile.write_profiled(rows.filter(F.col("a") % 3 == k), f"{workdir}/p{k}", rows.columns)
        profile.append_profile(spark, f"{workdir}/t", k, some)
        found.append(n)
    n, some = profile.write_profiled(rows.limit(0), f"{workdir}/p3", rows.columns)
    profile.append_profile(spark, f"{workdir}/t", 3, some)
    assert found == [1000] * 3 and n == 0
    got = {r["column"]: r for r in profile.merged_profile(spark.read.parquet(f"{workdir}/t/_profiles")).collect()}
    assert {k: (r["rows"], r["nulls"]) for k, r in got.items()} == {c: (3000, 600 if c == "b" else 0) for c in rows.columns}
    assert (got["a"].low_exact, got["a"].high_exact) == (0, 2999) and (got["b"].low_double, got["b"].high_double) == (1 / 7, 2999 / 7)
    assert (got["c"].low_text, got["c"].high_text) == ("n0", "n99") and got["d"].high_exact == D(2999) / 4
    assert (got["e"].low_text, got["e"].high_text) == ("2024-01-01", "2024-01-28")
    for name, exact in (("a", 3000), ("b", 2400), ("c", 300), ("e", 28)):
        assert abs(got[name].distinct_estimate - exact) <= 0.04 * exact
    report = profile.null_report_of(profile.merged_profile(spark.read.parquet(f"{workdir}/t/_profiles")))
    assert {(r["column"], r.status) for r in report.collect()} == {(c, "FAILED" if c == "b" else "PASSED") for c in rows.columns}


def plain_near(names, t, q=3):
    sets = {n: {("\u0001" * (q - 1) + n + "\u0001" * (q - 1))[i : i + q] for i in range(len(n) + q - 1)} for n in names if n}
    return {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9}


@pytest.mark.parametrize("t", [0.3, 0.5, 0.8, 1.0])
def test_near_names_equal_brute_force(spark, t):
    import random

    rng = random.Random(3)
    words = ["small", "smal", "large", "larges", "ring", "rings", "bolt", "bolts", "x", "é", "ab"]
    names = {" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(150)}
    rows = [(i, n.upper() if i % 3 else f"  {n.replace(' ', '   ')} ") for i, n in enumerate([*sorted(names), *sorted(names)])]
    rows += [(1000, None), (1001, ""), (1002, "  ")]
    df = spark.createDataFrame(rows, "k long, name string")
    of = {r.k: r.node for r in similar.members(df, "k", "name").collect()}
    assert of == {i: i % len(names) if i < 1000 else 1001 for i, n in rows if n is not None}
    text = {i: n for i, n in enumerate(sorted(names))}
    got = similar.near_pairs(df, "k", "name", similarity=t).collect()
    assert {tuple(sorted((text[r.node], text[r.other]))) for r in got} == plain_near(names, t) and len(got) == len(plain_near(names, t))
    assert similar.near_pairs(df.limit(0), "k", "name").count() == 0

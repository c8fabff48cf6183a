"""Operator semantics on small hand-made frames (one test per behaviour)."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierline.functions.casting import conform, parse_date
from tierline.functions.hashing import concat_hash, row_hash
from tierline.functions.text import json_field, render_template, xml_field
from tierline.operators import dedup, enrich, incremental, keys, quality, runlog, scd2
from tierline.operators.conform import conform_with_rejects, union_sources
from tierline.operators.metadata import aggregate_metrics, apply_rules


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---------------------------------------------------------------- conform


def test_dates_bad_and_empty_become_null(spark):
    df = spark.createDataFrame([("01/02/2020",), ("31/02/2020",), ("",), (None,), ("2020-01-01",)], "d string")
    got = [r[0] for r in df.select(parse_date("d", "dd/MM/yyyy")).collect()]
    assert got == [dt.date(2020, 2, 1), None, None, None, None]


def test_conform_with_rejects_names_failed_columns(spark):
    df = spark.createDataFrame([("1", " 10 ", "01/01/2020"), ("2", "ten", "01/01/2020"), ("3", "", "bad")],
                               "id string, n string, d string")
    spec = [("id", "id", "int"), ("n", "n", "int"), ("d", "d", "date:dd/MM/yyyy")]
    valid, rejected = conform_with_rejects(df, spec)
    assert rows(valid, "id", "n") == [(1, 10)]
    assert rows(rejected, "id", "reject_reason") == [("2", "Invalid value: n"), ("3", "Invalid value: d")]


def test_json_and_xml_fields(spark):
    df = spark.createDataFrame(
        [('{"First_Name": "Ann"}', "<c><First_Name>Ann\nMarie</First_Name></c>"), ("not json", "<c></c>"), (None, None)],
        "j string, x string",
    )
    got = df.select(json_field("j", "$.First_Name").alias("a"), xml_field("x", "First_Name").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("Ann", "Ann\nMarie"), (None, None), (None, None)]


def test_union_by_name_not_position(spark):
    a = spark.createDataFrame([("1", "x")], "id string, name string")
    b = spark.createDataFrame([("y", "2")], "name string, id string")
    c = spark.createDataFrame([("3",)], "id string")
    out = union_sources({"a": a, "b": b, "c": c})
    assert rows(out, "id", "name", "source") == [("1", "x", "a"), ("2", "y", "b"), ("3", None, "c")]


# ---------------------------------------------------------------- hashing


def test_row_hash_is_null_aware_but_concat_collides(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    h = df.select(row_hash(df, ["x", "y", "z"]).alias("h"), concat_hash(["x", "y", "z"]).alias("c")).collect()
    assert h[0].h != h[1].h
    assert h[0].c == h[1].c


# ---------------------------------------------------------------- dedup / anti-join


def test_anti_join_null_safe_keys(spark):
    loaded = spark.createDataFrame([(1, None), (2, dt.date(2020, 1, 1))], "id int, end_date date")
    incoming = spark.createDataFrame([(1, None), (2, dt.date(2020, 1, 1)), (3, None)], "id int, end_date date")
    safe = dedup.anti_join_new(incoming, loaded, ["id", "end_date"])
    plain = dedup.anti_join_new(incoming, loaded, ["id", "end_date"], null_safe=False)
    assert rows(safe, "id") == [(3,)]
    assert rows(plain, "id") == [(1,), (3,)]  # the NULL key is loaded again


def test_latest_per_key_uses_tie_breakers(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, "a", 1), (1, t, "b", 2), (2, t, "c", 1)], "k int, ts timestamp, v string, seq int")
    out = dedup.latest_per_key(df, ["k"], [F.col("ts").desc(), F.col("seq").desc()])
    assert rows(out, "k", "v") == [(1, "b"), (2, "c")]


# ---------------------------------------------------------------- quality


def test_duplicate_keys_reject_all_rows_of_a_key_with_nulls_grouped(spark):
    df = spark.createDataFrame(
        [(1, 10, None, "a"), (1, 10, None, "b"), (2, 10, None, "c"), (3, 20, dt.date(2020, 1, 1), "d")],
        "employee_id int, department_id int, end_date date, name string",
    )
    valid, rejected = quality.split_duplicate_keys(df, ["employee_id", "department_id", "end_date"])
    assert rows(valid, "name") == [("c",), ("d",)]
    assert rows(rejected, "name", "reject_reason") == [("a", "Duplicate business key"), ("b", "Duplicate business key")]


def test_duplicate_split_with_hot_key_keeps_every_row(spark):
    hot = spark.range(0, 30000).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    cold = spark.range(0, 60000).select((F.col("id") + 100).alias("k"), F.col("id").alias("v"))
    df = hot.unionByName(cold)
    valid, rejected = quality.split_duplicate_keys(df, ["k"])
    assert valid.count() == 60000 and rejected.count() == 30000


def test_reports_single_pass(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0), (None, 0.0)], "id int, amount double")
    nulls = {r["column"]: (r.total_records, r.failed_records, r.status) for r in quality.null_report(df, ["id", "amount"]).collect()}
    pos = {r["column"]: (r.failed_records, r.status) for r in quality.positive_report(df, ["amount"]).collect()}
    assert nulls == {"id": (4, 1, "FAILED"), "amount": (4, 1, "FAILED")}
    assert pos == {"amount": (2, "FAILED")}  # NULL is not a failure


def test_check_columns_and_quarantine(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert quality.check_columns(df, "silver", "t", ["a", "c"]).status == "FAIL"
    assert quality.check_columns(df, "silver", "t", ["a", "b"]).status == "PASS"
    q = quality.quarantine_rows(df.withColumn("reject_reason", F.lit("why")), "silver.t", at="2024-01-01 00:00:00")
    r = q.first()
    assert (r.source, r.reject_reason, r.payload) == ("silver.t", "why", '{"a":1,"b":"x"}')


# ---------------------------------------------------------------- keys


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=-1000, max_value=1000), min_size=0, max_size=60, unique=True), st.integers(0, 50))
def test_assign_keys_dense_ordered(spark, values, start):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    out = keys.assign_keys(df, ["v"], "k", start=start, num_partitions=4).collect()
    got = sorted((r.v, r.k) for r in out)
    assert [k for _, k in got] == list(range(start + 1, start + 1 + len(values)))


# ---------------------------------------------------------------- SCD2


def _dim_batch(spark, data):
    return spark.createDataFrame(data, "id int, name string, city string, seq int")


def test_scd2_versions_and_idempotence(spark):
    b1 = _dim_batch(spark, [(1, "a", "x", 1), (2, "b", "y", 1)])
    first = scd2.scd2_apply(None, b1, ["id"], ["name", "city"], ["name"], [F.col("seq").desc()], "2024-01-01", "key")
    s1 = first.state
    # second batch: 1 changed, 2 only an untracked column changed, 3 new, 1 twice (latest wins)
    b2 = _dim_batch(spark, [(1, "a2", "x", 1), (1, "a3", "x", 2), (2, "b", "z", 1), (3, "c", "w", 1)])
    second = scd2.scd2_apply(s1, b2, ["id"], ["name", "city"], ["name"], [F.col("seq").desc()], "2024-02-01", "key")
    s2 = second.state
    assert rows(second.changes, "id", "change_type", "key") == [(1, "changed", 3), (3, "new", 4)]
    assert rows(s2, "id", "name", "is_current", "key") == [
        (1, "a", False, 1), (1, "a3", True, 3), (2, "b", True, 2), (3, "c", True, 4)
    ]
    expired = [r for r in s2.collect() if not r.is_current][0]
    assert expired.end_date == dt.date(2024, 2, 1)
    # one current row per key
    assert s2.filter("is_current").groupBy("id").count().filter("count > 1").count() == 0
    # same batch again changes nothing
    third = scd2.scd2_apply(s2, b2, ["id"], ["name", "city"], ["name"], [F.col("seq").desc()], "2024-03-01", "key")
    assert third.changes.count() == 0
    assert rows(third.state, "id", "key", "is_current") == rows(s2, "id", "key", "is_current")


# ---------------------------------------------------------------- marks, logs, updates


def test_latest_marks_and_bounds(spark):
    t = dt.datetime
    log = spark.createDataFrame(
        [("p", "s", "d1", t(2024, 1, 1), t(2024, 1, 2), 1), ("p", "s", "d1", t(2024, 1, 5), t(2024, 1, 6), 2),
         ("p", "s", "d2", t(2024, 1, 3), t(2024, 1, 3), None)],
        incremental.MARK_SCHEMA,
    )
    got = rows(incremental.latest_marks(log), "pipeline_destination", "ingestion_time")
    assert got == [("d1", t(2024, 1, 5)), ("d2", t(2024, 1, 3))]
    assert incremental.read_mark(log, "p", "d1") == t(2024, 1, 5)
    assert incremental.read_mark(log, "p", "zz") is None
    ev = spark.createDataFrame([(t(2024, 1, d),) for d in range(1, 8)], "ts timestamp")
    assert incremental.bounded(ev, "ts", t(2024, 1, 2), t(2024, 1, 5)).count() == 3


def test_update_by_key_sets_nulls_and_ignores_unmatched(spark):
    target = spark.createDataFrame([(1, "RUNNING", "e0"), (2, "RUNNING", None)], "run_id int, status string, error string")
    updates = spark.createDataFrame([(1, "SUCCESS", None), (9, "FAILED", "x")], "run_id int, status string, error string")
    out = runlog.update_by_key(target, updates, ["run_id"], ["status", "error"])
    assert rows(out, "run_id", "status", "error") == [(1, "SUCCESS", None), (2, "RUNNING", None)]


def test_latest_state_prefers_end_state_on_time_tie(spark):
    t = dt.datetime(2024, 1, 1)
    log = runlog.run_rows(spark, [("r1", "silver", "job", "RUNNING", t, 0, None), ("r1", None, None, "FAILED", t, 0, "boom")])
    r = runlog.latest_state(log).first()
    assert (r.status, r.error, r.layer, r.job_name) == ("FAILED", "boom", "silver", "job")


# ---------------------------------------------------------------- templates, enrichment, rules


def test_template_renders_null_as_none(spark):
    df = spark.createDataFrame([("Ann", None, 1.5)], "first_name string, country string, salary double")
    got = df.select(render_template("{first_name} in {country}: {salary}").alias("p")).first().p
    assert got == "Ann in None: 1.5"
    with pytest.raises(ValueError):
        render_template("{salary:.2f}")


def _flaky_scorer(prompts):
    if any("bad" in p for p in prompts):
        if len(prompts) == 1:
            raise RuntimeError("model down")
        raise RuntimeError("batch failed")
    return [p.upper() for p in prompts]


def test_enrich_errors_become_text(spark):
    df = spark.createDataFrame([("ok",), ("bad",), (None,), ("fine",)], "p string").repartition(2)
    out = {r.p: r.ai_result for r in enrich.enrich_with_model(df, "p", _flaky_scorer, batch_size=4).collect()}
    assert out == {"ok": "OK", "bad": "AI call failed: model down", None: None, "fine": "FINE"}


def test_rules_and_metrics(spark):
    df = spark.createDataFrame([("  Lamp ", "HOME", " 1200 "), ("desk", "Office", "abc"), ("pen", "office", "3")],
                               "product_name string, category string, price string")
    out = apply_rules(df, [
        {"column": "product_name", "action": "trim"}, {"column": "category", "action": "lower"},
        {"column": "price", "action": "cast_double"}, {"column": "price", "action": "band", "target": "band"},
    ])
    assert rows(out, "product_name", "category", "price", "band") == [
        ("Lamp", "home", 1200.0, "Premium"), ("desk", "office", None, "Budget"), ("pen", "office", 3.0, "Budget")
    ]
    agg = aggregate_metrics(out, {"aggregation": {"group_by": ["category"]},
                                  "metrics": [{"column": "*", "function": "count", "alias": "n"}]})
    assert rows(agg, "category", "n") == [("home", 1), ("office", 2)]
    with pytest.raises(ValueError):
        aggregate_metrics(out, {"metrics": [{"column": "price", "function": "eval"}]})


def test_conform_projection(spark):
    df = spark.createDataFrame([("7", "x")], "Employee_id string, Name string")
    out = conform(df, [("Employee_id", "employee_id", "int"), ("Name", "name", "string")])
    assert out.dtypes == [("employee_id", "int"), ("name", "string")]


def test_expect_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    quality.expect_table(df, "t", ["name"], ["id"])
    with pytest.raises(quality.QualityError, match="missing"):
        quality.expect_table(df, "t", ["file_path"])
    with pytest.raises(quality.QualityError, match="repeated"):
        quality.expect_table(df.unionByName(df), "t", keys=["id"])
    with pytest.raises(quality.QualityError, match="no rows"):
        quality.expect_table(df.limit(0), "t", keys=["id"])


def test_assign_keys_with_coalesced_range_partitions(spark):
    # Many more shuffle partitions than the data needs: AQE coalesces the range partitions.
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.range(0, 200000).select(((F.col("id") * 7919) % 200003).alias("v")).repartition(13)
        out = keys.assign_keys(df, ["v"], "k")
        from pyspark.sql import Window

        ranked = out.withColumn("r", F.row_number().over(Window.orderBy("v")))  # test-only global rank
        assert ranked.filter(F.col("r") != F.col("k")).count() == 0
        assert out.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first() == (1, 200000, 200000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")

"""End to end: employee files (three formats) → bronze → silver → SCD2 dimension → fact, twice."""

from __future__ import annotations

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from tierline.plans import jobs
from tierline.operators import conform, dedup, keybuckets, quality
from tierline.session import ensure_checkpoint_dir
from tierline.sources.files import list_folders, list_names, publish, read_text
from tierline.sources.tables import CommitLog, ConcurrentWriteError, DimensionStore, LoadLog, VersionedTable, append_rows, compact_log, ensure_log, read_log, write_observed
from tierline.streaming.bronze import BronzeTable, commit_log, ingest_files, read_bronze
from tierline.streaming.registry import DatasetRegistry

HEADER = [
    "Employee_id", "First_Name", "Last_Name", "Gender", "Salary", "Date_of_Birth", "Age", "Country",
    "Department_id", "Date_of_Joining", "Manager_id", "Currency", "End_Date",
]
SPEC = [
    ("Employee_id", "employee_id", "int"), ("First_Name", "first_name", "string"),
    ("Last_Name", "last_name", "string"), ("Gender", "gender", "string"), ("Salary", "salary", "double"),
    ("Date_of_Birth", "date_of_birth", "date:dd/MM/yyyy"), ("Age", "age", "int"), ("Country", "country", "string"),
    ("Department_id", "department_id", "int"), ("Date_of_Joining", "date_of_joining", "date:dd/MM/yyyy"),
    ("Manager_id", "manager_id", "int"), ("Currency", "currency", "string"),
    ("End_Date", "end_date", "date:dd/MM/yyyy"),
]
KEYS = ["employee_id", "department_id", "end_date"]
ATTRS = ["first_name", "last_name", "gender", "salary", "date_of_birth", "age", "country", "department_id",
         "manager_id", "currency", "date_of_joining"]
TRACKED = [a for a in ATTRS if a != "age"]


def write_csv(folder, name, header, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(",".join(header) + "\n")
        for line in lines:
            f.write(",".join(line) + "\n")


def emp(i, first, last, salary, dept, end="", age="30", manager="100"):
    return [str(i), first, last, "F", salary, "01/02/1990", age, "DE", str(dept), "15/03/2015", manager, "EUR", end]


def write_json(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def emp_json(i, first, last, salary, dept):
    vals = dict(zip(HEADER, emp(i, first, last, salary, dept)))
    vals.pop("First_Name"), vals.pop("Last_Name")
    return {**vals, "customer": {"First_Name": first, "Last_Name": last}}


def write_xml(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    body = []
    for i, first, last, salary, dept in records:
        vals = dict(zip(HEADER, emp(i, first, last, salary, dept)))
        vals.pop("First_Name"), vals.pop("Last_Name")
        cells = "".join(f"<{k}>{v}</{k}>" for k, v in vals.items())
        body.append(f"<record>{cells}<customer><First_Name>{first}</First_Name>\n<Last_Name>{last}</Last_Name></customer></record>")
    with open(os.path.join(folder, name), "w") as f:
        f.write("<records>\n" + "\n".join(body) + "\n</records>\n")


def run_all_layers(spark, lake, src, as_of):
    for table, fmt, opts in [("emp_a", "csv", None), ("emp_b", "json", None), ("emp_c", "xml", {"rowTag": "record"})]:
        jobs.run_job(spark, lake, "bronze", table,
                     lambda t=table, f=fmt, o=opts: jobs.bronze_job(spark, lake, t, f"{src}/{t}", f, o).rows)
    sources = {
        "a": jobs.SilverSource(lake.layer("bronze", "emp_a")),
        "b": jobs.SilverSource(lake.layer("bronze", "emp_b"), json_fields={
            "First_Name": ("customer", "$.First_Name"), "Last_Name": ("customer", "$.Last_Name")}),
        "c": jobs.SilverSource(lake.layer("bronze", "emp_c"), xml_fields={
            "First_Name": ("customer", "First_Name"), "Last_Name": ("customer", "Last_Name")}),
    }
    silver = jobs.silver_job(spark, lake, "employee", sources, SPEC, KEYS, not_null=["employee_id"], as_of=as_of)
    jobs.dimension_job(spark, lake, "dim_employee", "employee", ["employee_id"], ATTRS, TRACKED,
                       [F.col("silver_ingestion_time").desc(), F.col("bronze_ingestion_time").desc(),
                        F.col("file_path").desc()], "employee_key", as_of=as_of)
    n_fact = jobs.fact_job(spark, lake, "fact_employee", "employee", "dim_employee", ["employee_id"], "employee_key",
                           ["employee_id", "salary", "currency", "department_id", "date_of_joining",
                            "silver_ingestion_time"], as_of=as_of)
    return silver, n_fact


def test_layers_end_to_end(spark, workdir):
    src, lake = f"{workdir}/src", jobs.Lake(f"{workdir}/lake")
    write_csv(f"{src}/emp_a", "a1.csv", HEADER, [
        emp(1, "Ann", "Lee", "50000", 10),
        emp(2, "Bob", "Ray", "60000", 20),
        emp(3, "Cid", "Kay", "abc", 10),  # text in a number column → quarantine
        emp(4, "Dee", "Fox", "70000", 10, end="31/12/2020"),
        emp(4, "Dee", "Fox", "71000", 10, end="31/12/2020"),  # same key twice in a batch → both rejected
    ])
    write_json(f"{src}/emp_b", "b1.json", [emp_json(5, "Eve", "Sun", "55000", 30), emp_json(2, "Bob", "Ray", "60000", 20)])
    write_xml(f"{src}/emp_c", "c1.xml", [(6, "Fay", "Ng", "65000", 40)])
    silver1, fact1 = run_all_layers(spark, lake, src, dt.datetime(2024, 1, 1))

    s = LoadLog(spark, lake.layer("silver", "employee")).read()
    assert sorted(r.employee_id for r in s.collect()) == [1, 5, 6]
    assert {r.employee_id: r.first_name for r in s.collect()} == {1: "Ann", 5: "Eve", 6: "Fay"}
    assert silver1.rejected == 5  # 2 (two sources) + 3 (bad salary) + 4 ×2
    assert fact1 == 3

    # Second delivery (a file with reordered columns): Ann moves to department 20 with a new
    # salary, Gil is new, and Eve's salary-only change keeps her business key, so silver skips it.
    reordered = list(reversed(HEADER))
    write_csv(f"{src}/emp_a", "a2.csv", reordered, [list(reversed(emp(1, "Ann", "Lee", "52000", 20))),
                                                    list(reversed(emp(7, "Gil", "Orr", "40000", 10))),
                                                    list(reversed(emp(5, "Eve", "Sun", "99999", 30)))])
    silver2, fact2 = run_all_layers(spark, lake, src, dt.datetime(2024, 2, 1))
    assert silver2.loaded == 2 and fact2 == 2

    dim = DimensionStore(spark, lake.layer("gold", "dim_employee")).read()
    got = sorted((r.employee_id, r.salary, r.department_id, r.is_current, r.employee_key) for r in dim.collect())
    assert got == [(1, 50000.0, 10, False, 1), (1, 52000.0, 20, True, 4), (5, 55000.0, 30, True, 2),
                   (6, 65000.0, 40, True, 3), (7, 40000.0, 10, True, 5)]

    # Third run with no new files: nothing loads, marks and anti-join hold, and the
    # dimension gets no new version.
    store = DimensionStore(spark, lake.layer("gold", "dim_employee"))
    version_before = store.latest_version()
    silver3, fact3 = run_all_layers(spark, lake, src, dt.datetime(2024, 3, 1))
    assert silver3.loaded == 0 and fact3 == 0
    assert LoadLog(spark, lake.layer("silver", "employee")).last()["number"] == 2
    assert store.latest_version() == version_before
    assert store.current().count() == 4

    # Marks never move backwards: every source's mark rows increase with each load.
    marks = sorted(jobs.marks(spark, lake).collect(), key=lambda r: r.updated_at)
    last = {}
    for m in marks:
        key = (m.pipeline_name, m.pipeline_destination)
        assert key not in last or m.ingestion_time > last[key]
        last[key] = m.ingestion_time

    runs = jobs.run_states(spark, lake)
    assert {r.status for r in runs.collect()} == {"SUCCESS"}
    assert runs.count() == 9
    audit = spark.read.parquet(lake.system("audit"))
    assert audit.filter("event = 'START'").count() == 9 and audit.filter("event = 'END'").count() == 9


def test_failed_job_is_logged_and_raised(spark, workdir):
    lake = jobs.Lake(f"{workdir}/lake")

    def boom():
        raise RuntimeError("source missing")

    try:
        jobs.run_job(spark, lake, "silver", "x", boom)
        raise AssertionError("expected failure")
    except RuntimeError:
        pass
    state = jobs.run_states(spark, lake).first()
    assert state.status == "FAILED" and "source missing" in state.error


def test_stream_rerun_and_new_file_only(spark, workdir):
    src, bronze, ckpt = f"{workdir}/src", f"{workdir}/bronze", f"{workdir}/ckpt"
    write_csv(src, "f1.csv", ["id", "name"], [["1", "a"], ["2", "b"]])
    assert ingest_files(spark, src, bronze, ckpt, "csv").rows == 2
    assert ingest_files(spark, src, bronze, ckpt, "csv").rows == 0
    write_csv(src, "f2.csv", ["name", "id", "extra"], [["c", "3", "x"]])
    assert ingest_files(spark, src, bronze, ckpt, "csv").rows == 1
    got = sorted((r.id, r.name, r.extra) for r in read_bronze(spark, bronze).collect())
    assert got == [("1", "a", None), ("2", "b", None), ("3", "c", "x")]


def test_stream_counts_every_batch(spark, workdir):
    src = f"{workdir}/src"
    spark.range(0, 1000).repartition(6).write.parquet(src)
    res = ingest_files(spark, src, f"{workdir}/b", f"{workdir}/c", "parquet", max_files_per_trigger=2,
                       path_glob="*.parquet")
    assert res.rows == 1000 and res.batches >= 3


def test_registry_runs_declared_datasets(spark, workdir):
    write_csv(f"{workdir}/crm", "c.csv", ["id", "name"], [["1", "a"]])
    write_csv(f"{workdir}/erp", "e.csv", ["sku"], [["x"], ["y"]])
    reg = DatasetRegistry()

    @reg.table("bronze_crm")
    def crm(s):
        return s.readStream.schema("id string, name string").option("header", "true").csv(f"{workdir}/crm")

    @reg.table("bronze_erp")
    def erp(s):
        return s.readStream.schema("sku string").option("header", "true").csv(f"{workdir}/erp")

    assert reg.run(spark, f"{workdir}/lake") == {"bronze_crm": 1, "bronze_erp": 2}
    erp_rows = read_bronze(spark, reg.path(f"{workdir}/lake", "bronze_erp"))
    assert erp_rows.columns == ["sku", "file_path", "ingestion_time", "batch_id"] and erp_rows.count() == 2
    assert reg.run(spark, f"{workdir}/lake") == {"bronze_crm": 0, "bronze_erp": 0}


def test_versioned_table_ignores_uncommitted(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t")
    assert t.write(spark.range(3)) == 1
    spark.range(10).write.parquet(t.path(2))  # a crashed writer: data but no commit
    assert t.read().count() == 3
    assert t.write(spark.range(5)) == 2  # the rerun rewrites v=2
    assert t.read().count() == 5


def test_current_filter_prunes_history(spark, workdir):
    store = DimensionStore(spark, f"{workdir}/dim", ["id"], buckets=1)
    rows = spark.createDataFrame([(1, True), (0, False)], "id int, is_current boolean")
    store.write_load(rows, [0])
    plan = store.read().filter("is_current")._jdf.queryExecution().optimizedPlan().toString()
    assert "expired" not in plan
    assert store.read().count() == 2


def test_bronze_reads_only_logged_batches(spark, workdir):
    src, bronze, ckpt = f"{workdir}/src", f"{workdir}/bronze", f"{workdir}/ckpt"
    write_csv(src, "f1.csv", ["id", "name"], [["1", "a"]])
    ingest_files(spark, src, bronze, ckpt, "csv")
    # A batch whose files exist but which never logged completion (crashed or still committing).
    lost = commit_log(spark, bronze).claim(commit_log(spark, bronze).last())
    spark.createDataFrame([("9", "z", None, None)], "id string, name string, file_path string, ingestion_time timestamp") \
        .write.parquet(f"{bronze}/batch_id={lost}")
    assert [r.id for r in read_bronze(spark, bronze).collect()] == ["1"]
    write_csv(src, "f2.csv", ["id", "name"], [["2", "b"]])
    ingest_files(spark, src, bronze, ckpt, "csv")
    assert sorted(r.id for r in read_bronze(spark, bronze).collect()) == ["1", "2"]


def test_silver_and_fact_loads_are_exactly_once_across_crashes(spark, workdir, monkeypatch):
    src, lake = f"{workdir}/src", jobs.Lake(f"{workdir}/lake")
    write_csv(f"{src}/emp_a", "a1.csv", HEADER, [emp(1, "Ann", "Lee", "50000", 10), emp(2, "Bob", "Ray", "60000", 20)])
    jobs.bronze_job(spark, lake, "emp_a", f"{src}/emp_a", "csv")
    sources = {"a": jobs.SilverSource(lake.layer("bronze", "emp_a"))}

    def silver(as_of):
        return jobs.silver_job(spark, lake, "employee", sources, SPEC, KEYS, as_of=as_of)

    # 1. The job dies after its data and log row, before the marks.
    real_marks = jobs._append_marks

    def boom(*a, **k):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(jobs, "_append_marks", boom)
    try:
        silver(dt.datetime(2024, 1, 1))
        raise AssertionError("expected the simulated crash")
    except RuntimeError:
        pass
    monkeypatch.setattr(jobs, "_append_marks", real_marks)
    assert jobs.marks(spark, lake).count() == 0
    assert silver(dt.datetime(2024, 1, 2)).loaded == 0  # the load is committed: completes the marks, rewrites nothing
    assert [(m.pipeline_destination, m.position) for m in jobs.marks(spark, lake).collect()] == [("a", 1)]
    rows = LoadLog(spark, lake.layer("silver", "employee")).read().collect()
    assert sorted(r.employee_id for r in rows) == [1, 2]
    assert {str(r.silver_ingestion_time) for r in rows} == {"2024-01-01 00:00:00"}  # first attempt's rows kept
    assert silver(dt.datetime(2024, 1, 3)).loaded == 0

    assert jobs.marks(spark, lake).count() == 1

    # 2. A fact load dies before its log row: its folder stays invisible and the rerun replaces it.
    jobs.dimension_job(spark, lake, "dim_employee", "employee", ["employee_id"], ATTRS, TRACKED,
                       [F.col("silver_ingestion_time").desc()], "employee_key", as_of=dt.datetime(2024, 1, 4))
    real_commit = LoadLog.commit

    def commit_boom(self, *a, **k):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(LoadLog, "commit", commit_boom)
    cols = ["employee_id", "salary"]
    try:
        jobs.fact_job(spark, lake, "fact_employee", "employee", "dim_employee", ["employee_id"], "employee_key", cols)
        raise AssertionError("expected the simulated crash")
    except RuntimeError:
        pass
    assert LoadLog(spark, lake.layer("gold", "fact_employee")).read() is None
    monkeypatch.setattr(LoadLog, "commit", real_commit)
    assert jobs.fact_job(spark, lake, "fact_employee", "employee", "dim_employee", ["employee_id"], "employee_key",
                         cols) == 2
    assert LoadLog(spark, lake.layer("gold", "fact_employee")).read().count() == 2
    assert jobs.fact_job(spark, lake, "fact_employee", "employee", "dim_employee", ["employee_id"], "employee_key",
                         cols) == 0


def test_late_source_with_older_times_is_not_skipped(spark, workdir):
    """One mark per source: a source that commits late with older ingestion times still loads."""
    src, lake = f"{workdir}/src", jobs.Lake(f"{workdir}/lake")
    sources = {"a": jobs.SilverSource(lake.layer("bronze", "emp_a")),
               "b": jobs.SilverSource(lake.layer("bronze", "emp_b"))}
    write_csv(f"{src}/emp_a", "a1.csv", HEADER, [emp(1, "Ann", "Lee", "50000", 10)])
    jobs.bronze_job(spark, lake, "emp_a", f"{src}/emp_a", "csv")
    # Source b has delivered nothing yet: it takes no part in the first load.
    assert jobs.silver_job(spark, lake, "employee", sources, SPEC, KEYS, as_of=dt.datetime(2024, 1, 1)).loaded == 1
    # Source b now lands a batch stamped before source a's mark.
    late = spark.createDataFrame([dict(zip(HEADER, emp(2, "Bob", "Ray", "60000", 20)))])
    late = late.select(*HEADER, F.lit("late.csv").alias("file_path"),
                       F.lit(dt.datetime(2000, 1, 1)).cast("timestamp").alias("ingestion_time"))
    table_of(spark, lake.layer("bronze", "emp_b"), f"{workdir}/late").write(late, 0)
    assert jobs.silver_job(spark, lake, "employee", sources, SPEC, KEYS, as_of=dt.datetime(2024, 1, 2)).loaded == 1


def test_csv_quotes_and_multiline_fallback(spark, workdir):
    src = f"{workdir}/src"
    os.makedirs(src)
    with open(f"{src}/q.csv", "w") as f:
        f.write('id,name,note\n1,"Lee, Ann",plain\n\n2,Bob,"say ""hi"""\n')
    # Same options, same answers as Spark's CSV reader (RFC 4180 doubled quotes need escape='"').
    ingest_files(spark, src, f"{workdir}/b", f"{workdir}/c", "csv", options={"escape": '"'})
    got = sorted((r.id, r.name, r.note) for r in read_bronze(spark, f"{workdir}/b").collect())
    assert got == [("1", "Lee, Ann", "plain"), ("2", "Bob", 'say "hi"')]

    src2 = f"{workdir}/src2"
    os.makedirs(src2)
    with open(f"{src2}/m.csv", "w") as f:
        f.write('id,note\n1,"two\nlines"\n2,one\n')
    ingest_files(spark, src2, f"{workdir}/b2", f"{workdir}/c2", "csv", options={"multiLine": "true"})
    got2 = sorted((r.id, r.note) for r in read_bronze(spark, f"{workdir}/b2").collect())
    assert got2 == [("1", "two\nlines"), ("2", "one")]


def employee_sources(spark, lake, src):
    jobs.bronze_job(spark, lake, "emp_a", f"{src}/emp_a", "csv")
    return {"a": jobs.SilverSource(lake.layer("bronze", "emp_a"))}


def load(spark, lake, src, as_of):
    silver = jobs.silver_job(spark, lake, "employee", employee_sources(spark, lake, src), SPEC, KEYS, as_of=as_of)
    jobs.dimension_job(spark, lake, "dim_employee", "employee", ["employee_id"], ATTRS, TRACKED,
                       [F.col("silver_ingestion_time").desc()], "employee_key", as_of=as_of)
    fact = jobs.fact_job(spark, lake, "fact_employee", "employee", "dim_employee", ["employee_id"], "employee_key",
                         ["employee_id", "salary"], as_of=as_of)
    return silver.loaded, fact


def test_idle_runs_and_crashes_lose_nothing(spark, workdir, monkeypatch):
    """Load, idle run, crash between data and commit, idle run, delivery: every row arrives once."""
    src, lake, day = f"{workdir}/src", jobs.Lake(f"{workdir}/lake"), dt.datetime(2024, 1, 1)
    write_csv(f"{src}/emp_a", "a1.csv", HEADER, [emp(1, "Ann", "Lee", "50000", 10)])
    assert load(spark, lake, src, day) == (1, 1)
    assert load(spark, lake, src, day) == (0, 0)
    write_csv(f"{src}/emp_a", "a2.csv", HEADER, [emp(2, "Bob", "Ray", "60000", 20)])
    real = LoadLog.commit

    def crash(self, *a, **k):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(LoadLog, "commit", crash)
    with pytest.raises(RuntimeError, match="driver lost"):
        load(spark, lake, src, day)
    monkeypatch.setattr(LoadLog, "commit", real)
    assert load(spark, lake, src, dt.datetime(2023, 1, 1)) == (1, 1)  # an earlier time than the first load's
    assert load(spark, lake, src, day) == (0, 0)
    write_csv(f"{src}/emp_a", "a3.csv", HEADER, [emp(3, "Cid", "Kay", "70000", 30)])
    assert load(spark, lake, src, day) == (1, 1)
    facts = LoadLog(spark, lake.layer("gold", "fact_employee")).read()
    assert sorted(r.employee_id for r in facts.collect()) == [1, 2, 3]


def test_gates_log_then_raise(spark, workdir):
    src, lake = f"{workdir}/src", jobs.Lake(f"{workdir}/lake")
    write_csv(f"{src}/emp_a", "a1.csv", [h for h in HEADER if h != "Department_id"], [["1"] * 12])
    sources = employee_sources(spark, lake, src)
    with pytest.raises(quality.QualityError, match="Department_id"):
        jobs.silver_job(spark, lake, "employee", sources, SPEC, KEYS)
    rows = jobs.quality_log(spark, lake).collect()
    assert {(r.table_name, r.check_name, r.status) for r in rows} == {
        ("employee.a", "schema_check", "FAIL"), ("employee", "schema_check", "FAIL")
    }
    assert LoadLog(spark, lake.layer("silver", "employee")).last() is None

    src2, lake2 = f"{workdir}/src2", jobs.Lake(f"{workdir}/lake2")
    write_csv(f"{src2}/emp_a", "a1.csv", HEADER, [emp(1, "", "Lee", "50000", 10), emp(2, "Bob", "Ray", "1", 10)])
    with pytest.raises(quality.QualityError, match="First_Name_null_check"):
        jobs.silver_job(spark, lake2, "employee", employee_sources(spark, lake2, src2), SPEC, KEYS, null_gates=["First_Name"])
    failed = jobs.quality_log(spark, lake2).filter("status = 'FAIL'").collect()
    assert [(r.check_name, r.failed_records) for r in failed] == [("First_Name_null_check", 1)]


def test_malformed_records_keep_their_text_in_quarantine(spark, workdir):
    src, lake = f"{workdir}/src", jobs.Lake(f"{workdir}/lake")
    os.makedirs(f"{src}/emp_b")
    with open(f"{src}/emp_b/b.json", "w") as f:
        f.write(json.dumps(emp_json(5, "Eve", "Sun", "55000", 30)) + '\n{"Employee_id": "6", "Salary": \n')
    jobs.bronze_job(spark, lake, "emp_b", f"{src}/emp_b", "json")
    sources = {"b": jobs.SilverSource(lake.layer("bronze", "emp_b"), json_fields={
        "First_Name": ("customer", "$.First_Name"), "Last_Name": ("customer", "$.Last_Name")})}
    result = jobs.silver_job(spark, lake, "employee", sources, SPEC, KEYS, not_null=["employee_id"])
    assert (result.loaded, result.rejected) == (1, 1)
    row = jobs.read_rejects(spark, lake, "employee").first()
    assert row.reject_reason == "Malformed record"
    assert json.loads(row.payload)["_rescued_data"].startswith('{"Employee_id": "6"')
    assert "_rescued_data" not in LoadLog(spark, lake.layer("silver", "employee")).read().columns


def table_of(spark, target, checkpoint, stream="s1"):
    """A bronze table as a stream of that id writes it."""
    os.makedirs(checkpoint, exist_ok=True)
    with open(f"{checkpoint}/metadata", "w") as f:
        f.write(json.dumps({"id": stream}))
    return BronzeTable(spark, target, checkpoint)


def test_replayed_batch_is_left_alone(spark, workdir):
    """A batch whose stream died before it noted the batch comes again: its commit says so."""
    rows = spark.createDataFrame([("1",)], "id string").withColumn("ingestion_time", F.current_timestamp())
    first = table_of(spark, f"{workdir}/b", f"{workdir}/c")
    assert not first.is_replay(0) and first.write(rows, 0, ["f"]) == 1
    assert table_of(spark, f"{workdir}/b", f"{workdir}/c").is_replay(0)
    other = table_of(spark, f"{workdir}/b", f"{workdir}/c2", stream="s2")
    assert not other.is_replay(0) and other.known(["f", "g"]) == {"f"}
    assert read_bronze(spark, f"{workdir}/b").count() == 1


def test_increments_are_partition_filters(spark, workdir):
    src, lake, day = f"{workdir}/src", jobs.Lake(f"{workdir}/lake"), dt.datetime(2024, 1, 1)
    for i in (1, 2):
        write_csv(f"{src}/emp_a", f"a{i}.csv", HEADER, [emp(i, "Ann", "Lee", "50000", 10)])
        load(spark, lake, src, day)
    plan = LoadLog(spark, lake.layer("silver", "employee")).read(after=1)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*load#\d+L > 1", plan) and "Join" not in plan
    from tierline.streaming.bronze import last_batches, read_batches

    bronze = lake.layer("bronze", "emp_a")
    newest = last_batches(spark, {"a": bronze})["a"]
    plan = read_batches(spark, bronze, newest, after=0)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*batch_id#\d+L > 0", plan)


def test_second_of_two_writers_is_refused_and_replaces_nothing(spark, workdir):
    """Two writers begin from the same state; the one that commits later raises, and the first one's rows stay."""
    mine, theirs = VersionedTable(spark, f"{workdir}/t"), VersionedTable(spark, f"{workdir}/t")
    mine.write(spark.range(1))
    base = theirs.log.last()
    slow = theirs.log.claim(base)
    assert mine.write(spark.range(3)) == 3
    spark.range(5).write.parquet(theirs.path(slow))
    with pytest.raises(ConcurrentWriteError):
        theirs.log.commit(base, slow, {})
    assert mine.read().count() == 3 and theirs.write(spark.range(7)) == 4 and mine.read().count() == 7

    loads = LoadLog(spark, f"{workdir}/l")
    a, b = loads.begin(), loads.begin()
    assert a.folder != b.folder
    for load, n in ((b, 2), (a, 3)):
        spark.range(n).write.parquet(load.folder)
    loads.commit(b, 2, {"x": 1}, spark.range(1).schema)
    with pytest.raises(ConcurrentWriteError):
        loads.commit(a, 3, {"x": 2}, spark.range(1).schema)
    assert loads.positions() == {"x": 1} and loads.read().count() == 2 and loads.last()["dropped"] == [1]
    late = loads.begin()
    spark.range(4).write.parquet(late.folder)
    loads.commit(late, 4, {"x": 3}, spark.range(1).schema)
    assert loads.read().count() == 6 and loads.read(after=b.number).count() == 4

    rows = spark.createDataFrame([(i, True) for i in range(20)], "id int, is_current boolean")
    one, two = (DimensionStore(spark, f"{workdir}/d", ["id"], buckets=4) for _ in range(2))
    one.write_load(rows, range(4), max_key=20)
    with pytest.raises(ConcurrentWriteError):
        two.write_load(rows.limit(5), range(4), max_key=5)
    after = DimensionStore(spark, f"{workdir}/d")
    assert after.current().count() == 20 and after.committed_max_key() == 20 and after.history() is None


def test_publish_never_overwrites(spark, workdir):
    assert publish(spark, f"{workdir}/x/a.json", "{}") and not publish(spark, f"{workdir}/x/a.json", "[]")
    assert read_text(spark, f"{workdir}/x/a.json") == "{}" and list_names(spark, f"{workdir}/x") == ["a.json"]


def test_dimension_rewrites_touched_buckets_only(spark, workdir):
    store = DimensionStore(spark, f"{workdir}/d", ["id"], buckets=16)
    rows = spark.range(1000).select(F.col("id"), F.lit(0).alias("x"), F.lit(True).alias("is_current"))
    store.write_load(rows, range(16), max_key=1000)
    before = dict(store.last["versions"])
    assert len(before) == 16
    touched = keybuckets.touched(spark.range(7, 8), ["id"], 16)[1]
    current = store.current(touched)
    assert len(touched) == 1 and 0 < current.count() < 200
    assert len(current.inputFiles()) == 1  # other buckets' folders are not even listed
    expired = current.withColumn("is_current", F.col("id") != 7)
    new = spark.createDataFrame([(7, 1, True)], current.select("id", "x", "is_current").schema)
    store.write_load(expired.unionByName(new), touched, max_key=1001)
    after = store.last["versions"]
    assert {b for b in before if before[b] != after[b]} == {str(touched[0])}
    assert store.current().count() == 1000 and store.current().filter("id = 7").first().x == 1
    assert [(r.id, r.x) for r in store.history().collect()] == [(7, 0)] and store.read().count() == 1001
    again = DimensionStore(spark, f"{workdir}/d", ["other"], buckets=99)
    assert (again.keys, again.buckets, again.read().count()) == (["id"], 16, 1001)


def test_look_up_opens_only_folders_that_can_hold_the_keys(spark, workdir):
    keys = ["a", "b"]
    loads = LoadLog(spark, f"{workdir}/l")
    layouts = []
    for lo, buckets in ((0, 64), (1000, 1), (2000, 8)):
        part = spark.range(lo, lo + 1000).select("id", F.col("id").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("b"))
        load = loads.begin()
        layouts.append(buckets)
        n = write_observed(keybuckets.with_layout(part, keys, buckets), load.folder, keybuckets.LAYOUT)["rows"]
        loads.commit(load, n, {}, part.schema, keybuckets.LAYOUT, {"layouts": layouts})
    wanted = spark.createDataFrame([(3, None), (1004, 1004), (2001, None), (9999, 1)], "a long, b long")
    n, buckets = keybuckets.touched(wanted, keys)
    assert n == 4 and 0 < len(buckets) <= 4
    existing = jobs.loaded_keys(loads, loads.last(), keys, buckets)
    plan = existing._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*key_buckets#", plan)
    assert 1000 < existing.count() < 2000 and loads.read().count() == 3000 and loads.read().columns == ["id", "a", "b", "load"]
    new = jobs.dedup.anti_join_new(wanted, existing, keys).collect()
    assert sorted((r.a, r.b) for r in new) == [(9999, 1)]
    assert keybuckets.can_hold([4, 1], range(1024)) is None and keybuckets.buckets_for(1) == 1
    assert keybuckets.buckets_for(2_500_000) == 4 and keybuckets.buckets_for(10**12) == keybuckets.FINEST


def test_any_checkpoint_brings_each_file_once(spark, workdir):
    """A new checkpoint, a copied one and none of the old files' loss: files are known to the table."""
    src, bronze = f"{workdir}/src", f"{workdir}/b"
    for fmt, opts in (("csv", {}), ("json", {}), ("json", {"multiLine": "true"}), ("xml", {"rowTag": "r"}), ("parquet", {})):
        at, target = f"{src}_{fmt}{len(opts)}", f"{bronze}_{fmt}{len(opts)}"
        os.makedirs(at)

        def deliver(i, at=at, fmt=fmt):
            if fmt == "parquet":
                return spark.createDataFrame([(str(i),)], "id string").coalesce(1).write.mode("append").parquet(at)
            with open(f"{at}/f{i}.{fmt}", "w") as f:
                f.write({"csv": f"id\n{i}\n", "json": json.dumps({"id": str(i)}) + "\n", "xml": f"<rs><r><id>{i}</id></r></rs>"}[fmt])

        def run(name, at=at, target=target, fmt=fmt, opts=opts):
            glob = "*.parquet" if fmt == "parquet" else None
            return ingest_files(spark, at, target, f"{target}_{name}", fmt, options=opts, path_glob=glob).rows

        deliver(1)
        assert run("c1") == 1
        deliver(2)
        assert run("c2") == 1
        deliver(3)
        assert (run("c1"), run("c2"), run("c1")) == (1, 0, 0)
        assert sorted(r.id for r in read_bronze(spark, target).collect()) == ["1", "2", "3"]


def test_column_names_of_any_spelling(spark, workdir):
    """The case changes, two spellings stand in one record, names are the table's own: nothing stops, no value is lost."""
    src, bronze, ckpt = f"{workdir}/src", f"{workdir}/b", f"{workdir}/c"
    own = ["file_path", "batch_id", "ingestion_time", "_rescued_data", "_tl_mid"]
    write_json(src, "a.json", [{"id": "1", "name": "a"}])
    assert ingest_files(spark, src, bronze, ckpt, "json", schema_location=f"{workdir}/s").rows == 1
    write_json(src, "b.json", [{"ID": "2", "Name": "b"}, {"Id": "3", "id": "4", "name": "c"}, {"Id": "5", "ID": "6", "id": "7"}])
    write_json(src, "c.json", [{"id": "8", **{n: f"own {n}" for n in own}, "source_batch_id": "theirs"}])
    assert ingest_files(spark, src, bronze, ckpt, "json", schema_location=f"{workdir}/s").rows == 4
    rows = read_bronze(spark, bronze).collect()
    assert sorted(tuple(r[c] or "" for c in ("id", "id_2", "id_3", "name")) for r in rows) == sorted([
        ("1", "", "", "a"), ("2", "", "", "b"), ("4", "3", "", "c"), ("7", "6", "5", ""), ("8", "", "", ""),
    ])
    last = next(r for r in rows if r.id == "8")
    columns = ["source_file_path", "source_batch_id", "source_ingestion_time", "source__rescued_data", "source__tl_mid"]
    assert [last[c] for c in columns] == [f"own {n}" for n in own] and last["source_source_batch_id"] == "theirs"
    assert last.file_path.endswith("c.json") and last._rescued_data is None

    write_csv(f"{src}2", "a.csv", ["id", "Name"], [["1", "a"]])
    write_csv(f"{src}2", "b.csv", ["ID", "name", "batch_id"], [["2", "b", "x"]])
    write_csv(f"{src}2", "c.csv", ["Id", "id"], [["3", "4"]])
    for _ in range(2):
        ingest_files(spark, f"{src}2", f"{bronze}2", f"{ckpt}2", "csv", max_files_per_trigger=1)
    got = read_bronze(spark, f"{bronze}2")
    assert sorted(tuple(r[c] or "" for c in ("id", "id_2", "Name", "source_batch_id")) for r in got.collect()) == [
        ("1", "", "a", ""), ("2", "", "b", "x"), ("4", "3", "", "")
    ]


def test_whole_files_with_names_that_differ_in_case(spark, workdir):
    os.makedirs(f"{workdir}/j")
    with open(f"{workdir}/j/a.json", "w") as f:
        f.write('[{"id": 1,\n "Id": 2, "file_path": "x"},\n {"Id": 3}]')
    ingest_files(spark, f"{workdir}/j", f"{workdir}/bj", f"{workdir}/cj", "json", options={"multiLine": "true"})
    with open(f"{workdir}/j/b.json", "w") as f:
        f.write('[{"ID": 4,\n "FILE_PATH": "y"}]')
    ingest_files(spark, f"{workdir}/j", f"{workdir}/bj", f"{workdir}/cj", "json", options={"multiLine": "true"})
    rows = read_bronze(spark, f"{workdir}/bj").collect()
    assert sorted(sorted(v for v in (r["Id"], r["Id_2"]) if v) for r in rows) == [["1", "2"], ["3"], ["4"]]
    assert sorted(r.source_file_path or "" for r in rows) == ["", "x", "y"] and all("/j/" in r.file_path for r in rows)


def test_header_after_blank_lines_and_over_several(spark, workdir):
    os.makedirs(f"{workdir}/s")
    with open(f"{workdir}/s/a.csv", "w") as f:
        f.write("\n  \nid,name\n1,a\n\n2,b\n")
    ingest_files(spark, f"{workdir}/s", f"{workdir}/b", f"{workdir}/c", "csv")
    got = read_bronze(spark, f"{workdir}/b")
    assert sorted((r.id, r.name, r._rescued_data) for r in got.collect()) == [("1", "a", None), ("2", "b", None)]
    os.makedirs(f"{workdir}/m")
    with open(f"{workdir}/m/a.csv", "w") as f:
        f.write('id,"full\nname",last\n1,"x\ny",z\n')
    ingest_files(spark, f"{workdir}/m", f"{workdir}/bm", f"{workdir}/cm", "csv", options={"multiLine": "true"})
    row = read_bronze(spark, f"{workdir}/bm").first()
    assert (row["id"], row["full\nname"], row["last"], row["_rescued_data"]) == ("1", "x\ny", "z", None)


def test_check_results_survive_a_death_around_the_commit(spark, workdir, monkeypatch):
    src, lake = f"{workdir}/src", jobs.Lake(f"{workdir}/lake")
    lake.create_logs(spark)
    write_csv(f"{src}/emp_a", "a1.csv", HEADER, [emp(1, "Ann", "Lee", "50000", 10), emp(2, "Bob", "Ray", "x", 20)])
    sources = employee_sources(spark, lake, src)

    def silver():
        return jobs.silver_job(spark, lake, "employee", sources, SPEC, KEYS, as_of=dt.datetime(2024, 1, 1))

    def die(*a, **k):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(LoadLog, "commit", die)  # before the commit: the load did not happen, nor did its results
        with pytest.raises(RuntimeError):
            silver()
    assert jobs.quality_log(spark, lake).count() == 0
    with monkeypatch.context() as m:
        m.setattr(jobs, "_append_marks", die)  # after it: the results are there
        with pytest.raises(RuntimeError):
            silver()
    assert silver().loaded == 0
    failed = jobs.quality_log(spark, lake).filter("status = 'FAIL'").collect()
    assert [(r.check_name, r.failed_records) for r in failed] == [("cast_check", 1)]
    assert jobs.read_rejects(spark, lake, "employee").count() == 1


def test_xml_and_multiline_json_are_never_one_value(spark, workdir, monkeypatch):
    """Only paths are streamed: no text source with whole files takes part."""
    from tierline.streaming import bronze

    monkeypatch.setattr(bronze, "_text_lines", lambda *a, **k: (_ for _ in ()).throw(AssertionError("read as text")))
    write_xml(f"{workdir}/x", "c1.xml", [(6, "Fay", "Ng", "65000", 40)])
    assert ingest_files(spark, f"{workdir}/x", f"{workdir}/bx", f"{workdir}/cx", "xml", options={"rowTag": "record"}).rows == 1
    os.makedirs(f"{workdir}/j")
    with open(f"{workdir}/j/a b.json", "w") as f:
        f.write('[\n{"id": 1,\n "o": {"k": [1, 2]}},\n{"id": "2"}\n]')
    with open(f"{workdir}/j/bad.json", "w") as f:
        f.write('{"id": 3,\n ')
    assert ingest_files(spark, f"{workdir}/j", f"{workdir}/bj", f"{workdir}/cj", "json", options={"multiLine": "true"}).rows == 3
    got = sorted((r.id or "", r.o or "", r._rescued_data is not None) for r in read_bronze(spark, f"{workdir}/bj").collect())
    assert got == [("", "", True), ("1", '{"k": [1, 2]}', False), ("2", "", False)]


def test_csv_headers_and_rescue(spark, workdir):
    src = f"{workdir}/src"
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as f:
        f.write('"Name, full",id,,last\n"Doe, J",7,x,l\n"Roe",8,y,m,more\nshort\n')
    with open(f"{src}/b.csv", "w") as f:
        f.write('id,id,other\n9,10,z\n')
    ingest_files(spark, src, f"{workdir}/b", f"{workdir}/c", "csv")
    columns = ["Name, full", "id", "_c2", "last", "id_1", "other", "_rescued_data"]
    got = sorted(tuple(r[c] or "" for c in columns) for r in read_bronze(spark, f"{workdir}/b").collect())
    assert got == [("", "9", "", "", "10", "z", ""), ("Doe, J", "7", "x", "l", "", "", ""),
                   ("Roe", "8", "y", "m", "", "", '"Roe",8,y,m,more'), ("short", "", "", "", "", "", "")]


def test_run_errors_are_kept_whole(spark, workdir):
    lake = jobs.Lake(f"{workdir}/lake")
    lake.create_logs(spark)

    def boom():
        raise RuntimeError("x" * 5000)

    with pytest.raises(RuntimeError):
        jobs.run_job(spark, lake, "silver", "x", boom)
    assert len(jobs.run_states(spark, lake).first().error) > 5000
    append_rows(jobs.runlog.metric_row(spark, "j", "SUCCESS", 1), lake.system("metrics"))
    assert read_log(spark, lake.system("metrics")).count() == 1


def test_late_dimension_rows_fill_open_facts_only(spark, workdir):
    lake = jobs.Lake(f"{workdir}/lake")
    cust, sold = LoadLog(spark, lake.layer("silver", "c")), LoadLog(spark, lake.layer("silver", "o"))

    def put(loads, rows, schema):
        df = spark.createDataFrame(rows, schema)
        load = loads.begin()
        loads.commit(load, write_observed(df, load.folder)["rows"], {}, df.schema)

    def run(day):
        jobs.dimension_job(spark, lake, "d", "c", ["k"], ["x"], ["x"], [F.col("x")], "key", as_of=dt.datetime(2024, 1, day))
        return jobs.fact_job(spark, lake, "f", "o", "d", ["k"], "key", ["id", "k"], as_of=dt.datetime(2024, 1, day))

    facts = LoadLog(spark, lake.layer("gold", "f"))
    put(cust, [(1, "a")], "k int, x string")
    put(sold, [(10, 1), (11, 2), (12, 3), (13, None)], "id int, k int")
    assert run(1) == 4
    assert sorted((r.id, r.key) for r in facts.read().filter("key IS NOT NULL").collect()) == [(10, 1)]
    assert run(2) == 0 and facts.last()["number"] == 1  # the dimension is as it was: nothing to look up
    put(cust, [(2, "b")], "k int, x string")
    put(sold, [(14, 2)], "id int, k int")
    assert run(3) == 1
    rows = facts.read().collect()
    assert sorted((r.id, r.key) for r in rows if r.key) == [(10, 1), (11, 2), (14, 2)] and len(rows) == 5
    assert {r.id: r.created_at.day for r in rows} == {10: 1, 11: 1, 12: 1, 13: 1, 14: 3}
    assert {r.id: r.load for r in rows} == {10: 1, 11: 2, 12: 2, 13: 2, 14: 2}
    put(cust, [(3, "c"), (None, "n")], "k int, x string")
    assert run(4) == 0  # late keys only
    rows = facts.read().collect()
    assert len(rows) == 5 and all(r.key for r in rows) and facts.last()["state"]["open"] == {}
    put(cust, [(3, "d")], "k int, x string")
    assert run(5) == 0 and facts.last()["number"] == 3


def test_replay_of_quarantine(spark, workdir):
    src, lake = f"{workdir}/src", jobs.Lake(f"{workdir}/lake")
    lake.create_logs(spark)
    write_csv(f"{src}/emp_a", "a1.csv", HEADER, [
        emp(1, "Ann", "Lee", "50000", 10), emp(2, "Bob", "Ray", "6o000", 20), emp(3, "Cid", "Kay", "7x", 30),
        emp(4, "Dee", "Fox", "1", 10), emp(4, "Dee", "Fox", "2", 10), emp("", "Eve", "Sun", "3", 10),
    ])
    sources = employee_sources(spark, lake, src)
    first = jobs.silver_job(spark, lake, "employee", sources, SPEC, KEYS, not_null=["employee_id"], as_of=dt.datetime(2024, 1, 1))
    assert (first.loaded, first.rejected) == (1, 5)
    # nothing is corrected: everything fails again, under the new load's number
    again = jobs.replay_job(spark, lake, "employee", SPEC, KEYS, not_null=["employee_id"], as_of=dt.datetime(2024, 1, 2))
    assert (again.loaded, again.rejected) == (0, 5)
    rejects = jobs.read_rejects(spark, lake, "employee").collect()
    assert len(rejects) == 5 and {r.load for r in rejects} == {2}

    def fix(rows):  # of two rows with a key the higher salary counts; a missing id is known now
        rows = rows.withColumn("employee_id", F.coalesce("employee_id", F.lit(5)))
        return jobs.dedup.latest_per_key(rows, ["employee_id"], [F.col("salary").desc()])

    lenient = [(s, t, "decimal(3,0)" if t == "salary" else k) for s, t, k in SPEC]
    done = jobs.replay_job(spark, lake, "employee", lenient, KEYS, not_null=["employee_id"], as_of=dt.datetime(2024, 1, 3), fix=fix)
    assert (done.loaded, done.rejected) == (2, 2)  # the two salaries still do not convert
    # a corrected delivery brings one of the two: its quarantined row is settled by the next replay
    write_csv(f"{src}/emp_a", "a2.csv", HEADER, [emp(2, "Bob", "Ray", "60000", 20)])
    jobs.silver_job(spark, lake, "employee", employee_sources(spark, lake, src), SPEC, KEYS, not_null=["employee_id"])
    by_age = [("Age" if t == "salary" else s, t, k) for s, t, k in SPEC]  # another raw column stands in for the bad one
    last = jobs.replay_job(spark, lake, "employee", by_age, KEYS, not_null=["employee_id"], as_of=dt.datetime(2024, 1, 4))
    assert (last.loaded, last.rejected) == (1, 0) and jobs.read_rejects(spark, lake, "employee").count() == 0
    silver = LoadLog(spark, lake.layer("silver", "employee")).read().collect()
    assert {r.employee_id: r.load for r in silver} == {1: 1, 4: 3, 5: 3, 2: 4, 3: 5}
    assert {r.employee_id: r.salary for r in silver}[4] == 2.0
    assert jobs.replay_job(spark, lake, "employee", SPEC, KEYS).loaded == 0
    report = {r["column"]: r for r in jobs.table_profile(spark, lake, "employee").collect()}
    assert report["employee_id"]["rows"] == 5 and report["end_date"]["nulls"] == 5 and report["employee_id"]["distinct_estimate"] == 5


def test_log_compaction_loses_and_repeats_nothing(spark, workdir, monkeypatch):
    path = f"{workdir}/log"

    def add(*values):
        append_rows(spark.createDataFrame([(v,) for v in values], "x long").coalesce(1), path)

    def rows():
        return sorted(r.x for r in read_log(spark, path).collect())

    assert compact_log(spark, path) == 0  # no log yet
    ensure_log(spark, path, spark.range(0).selectExpr("id AS x").schema)
    add(1), add(2, 2), add(3)
    assert compact_log(spark, path) == 4 and rows() == [1, 2, 2, 3]
    assert compact_log(spark, path) == 0
    add(4)
    assert rows() == [1, 2, 2, 3, 4]
    # a compaction that dies before its commit has changed nothing
    with monkeypatch.context() as m:
        m.setattr("tierline.sources.tables.CommitLog.commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact_log(spark, path)
    assert rows() == [1, 2, 2, 3, 4]
    # one that dies after it, before the old files go: they stay covered
    add(5)
    with monkeypatch.context() as m:
        m.setattr("tierline.sources.tables.remove", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact_log(spark, path)
    assert rows() == [1, 2, 2, 3, 4, 5]
    add(6)
    early = read_log(spark, path)  # a reader that began before the next compaction
    assert compact_log(spark, path) == 1 and rows() == [1, 2, 2, 3, 4, 5, 6]
    assert early.count() == 7
    assert len([n for n in list_names(spark, path) if n.endswith(".parquet")]) == 1
    # a row appended while a compaction runs is in no compacted folder, and is read
    commit = CommitLog.commit
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lambda *a: (add(8), commit(*a))[1])
        add(7)
        assert compact_log(spark, path) == 1
    assert rows() == [1, 2, 2, 3, 4, 5, 6, 7, 8]


def test_second_of_two_compactions_is_refused(spark, workdir, monkeypatch):
    path = f"{workdir}/log"
    append_rows(spark.range(5).coalesce(1), path)
    commit = CommitLog.commit
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lambda *a: (m.undo(), compact_log(spark, path), commit(*a)))
        with pytest.raises(ConcurrentWriteError):
            compact_log(spark, path)
    assert read_log(spark, path).count() == 5


def test_vacuum_keeps_what_is_read(spark, workdir):
    versions = VersionedTable(spark, f"{workdir}/v")
    assert versions.vacuum() == []
    for n in (1, 2, 3):
        versions.write(spark.range(n))
    versions.log.claim(versions.log.last())  # a writer that is still at work on version 4
    spark.range(9).write.parquet(versions.path(4))
    assert versions.vacuum(keep=2) == [1] and versions.read(2).count() == 2
    assert versions.vacuum() == [2] and versions.read().count() == 3
    assert os.path.isdir(versions.path(4))

    store = DimensionStore(spark, f"{workdir}/d", ["id"], buckets=4)
    assert store.vacuum() == 0
    rows = spark.range(100).select(F.col("id"), F.lit(0).alias("x"), F.lit(True).alias("is_current"))
    store.write_load(rows, range(4), max_key=100)
    touched = keybuckets.touched(spark.range(7, 8), ["id"], 4)[1]
    before = store.current()
    for n in (1, 2):  # the first touches a bucket, the second the same one
        old = store.current(touched)
        new = old.filter("id = 7").withColumn("x", F.lit(n))
        store.write_load(old.withColumn("is_current", F.col("id") != 7).unionByName(new), touched, max_key=100)
    assert store.vacuum(keep=3) == 0 and before.count() == 100
    assert store.vacuum() == 2 and store.vacuum() == 0
    assert store.read().count() == 102 and store.current().filter("id = 7").first().x == 2


def test_dimension_load_removes_its_change_set(spark, workdir):
    left = list_folders(spark, f"{ensure_checkpoint_dir(spark)}/tierline-scratch")
    lake = jobs.Lake(f"{workdir}/lake")
    write_csv(f"{workdir}/src", "a.csv", ["id", "name"], [["2", "b"], ["1", "a"]])
    jobs.bronze_job(spark, lake, "t", f"{workdir}/src", "csv")
    jobs.silver_job(spark, lake, "t", {"t": jobs.SilverSource(lake.layer("bronze", "t"))}, [("id", "id", "int"), ("name", "name", "string")], ["id"])
    jobs.dimension_job(spark, lake, "d", "t", ["id"], ["name"], ["name"], [F.col("silver_ingestion_time").desc()], "k")
    got = DimensionStore(spark, lake.layer("gold", "d")).read().select("id", "k").collect()
    assert sorted((r.id, r.k) for r in got) == [(1, 1), (2, 2)]
    assert [f for f in list_folders(spark, f"{ensure_checkpoint_dir(spark)}/tierline-scratch") if f not in left and f.startswith("d-changes")] == []


@pytest.mark.parametrize("prefilter", [False, True])
def test_barred_keys_against_plain_counts(spark, prefilter):
    """One aggregate finds the keys that repeat or are loaded, NULL parts included."""
    rows = [(1, "a"), (1, "a"), (2, None), (2, None), (3, None), (4, "d"), (None, None), (5, "e"), (6, "f"), (6, "f")]
    there = [(3, None), (4, "x"), (5, "e"), (5, "e"), (6, "f"), (7, "g"), (7, "g")]
    incoming, existing = (spark.createDataFrame(some, "k int, p string") for some in (rows, there))
    for known, frame in ((there, existing), ([], None)):
        found = {(r.k, r.p): (r["_tl_n"], r["_tl_loaded"]) for r in dedup.barred_keys(incoming, frame, ["k", "p"], prefilter).collect()}
        assert found == {key: (rows.count(key), key in known) for key in set(rows) if rows.count(key) > 1 or key in known}


@pytest.mark.parametrize("bound", [0, 10**6])
def test_large_increments_load_like_small_ones(spark, workdir, monkeypatch, bound):
    """Bounds on broadcast keys and small increments choose joins, never rows; only touched keys must be unique."""
    monkeypatch.setattr(jobs, "SMALL_INCREMENT", bound)
    monkeypatch.setattr(jobs, "BROADCAST_KEYS", bound)
    src, lake = f"{workdir}/src", jobs.Lake(f"{workdir}/lake")

    def load(name, rows):
        write_csv(f"{src}/o", name, ["id", "k", "day"], [r.split(",") for r in rows])
        jobs.bronze_job(spark, lake, "o", f"{src}/o", "csv")
        spec = [("id", "id", "bigint"), ("k", "k", "bigint"), ("day", "day", "date:dd/MM/yyyy")]
        return jobs.silver_job(spark, lake, "o", {"o": jobs.SilverSource(lake.layer("bronze", "o"))}, spec, ["id"], not_null=["id"],
                               as_of=dt.datetime(2024, 1, 1), rows_per_bucket=2)

    def dimension(rows):
        frame = spark.createDataFrame(rows, "k long, key long").withColumn("is_current", F.lit(True))
        DimensionStore(spark, lake.layer("gold", "d"), ["k"], 1).write_load(frame, [0])

    def fact():
        return jobs.fact_job(spark, lake, "f", "o", "d", ["k"], "key", ["id", "k"], as_of=dt.datetime(2024, 1, 1))

    first = load("1.csv", ["1,1,01/02/2024", "2,2,02/02/2024", "3,1,2024-02-02", "4,1,01/02/2024", "4,2,01/02/2024", ",1,01/02/2024"])
    assert (first.loaded, first.rejected) == (2, 4)
    gold = LoadLog(spark, lake.layer("gold", "f"))
    dimension([(1, 10), (2, 20)])
    assert fact() == 2
    dimension([(1, 10), (2, 20), (3, 30), (3, 31)])
    second = load("2.csv", ["2,2,02/02/2024", "3,1,03/02/2024", "5,9,03/02/2024"])
    assert (second.loaded, second.rejected) == (2, 0)
    assert fact() == 2
    assert sorted((r.id, r.key) for r in gold.read().collect()) == [(1, 10), (2, 20), (3, 10), (5, None)]
    load("3.csv", ["6,3,03/02/2024"])
    with pytest.raises(quality.QualityError):
        fact()


def test_conformed_rows_keep_raw_values_only_where_they_failed(spark):
    spec = [("n", "n", "int"), ("d", "d", "date:dd/MM/yyyy"), ("n", "again", "double")]
    df = spark.createDataFrame([("1", "01/02/2024", "a"), ("x", "01/02/2024", "b"), (" ", None, "c"), ("2", "2024-02-01", "d")], "n string, d string, s string")
    flagged = conform.conform_flagged(df, spec, ["s"])
    assert {r.s: (r["_tl_raw_n"], r["_tl_raw_d"], list(r["_tl_failed"])) for r in flagged.collect()} == {
        "a": (None, None, []), "b": ("x", "01/02/2024", ["n", "again"]), "c": (None, None, []), "d": ("2", "2024-02-01", ["d"])
    }
    valid, rejected = conform.split_flagged(flagged, spec, ["s"])
    assert sorted(r.s for r in valid.collect()) == ["a", "c"]
    assert sorted((r.s, r.n, r.reject_reason) for r in rejected.collect()) == [("b", "x", "Invalid value: n, again"), ("d", "2", "Invalid value: d")]

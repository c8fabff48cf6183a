"""Composite layered jobs over a lake folder: bronze → silver → gold.

Layout under ``root``: ``bronze/<table>``, ``silver/<table>``, ``gold/<table>``
and ``system/{marks,runs,audit,quality,rejects,metrics,ai_results}``. All
system tables are append-only.

Incremental contract of every silver/gold job:

1. how far earlier loads have read each source comes from the target's own log,
   as a batch or load number, so times given by a caller or a clock never decide
   what is read;
2. the end of each source is fixed from the source's log *before* writing;
3. no source has anything beyond: the job returns without writing a load;
4. the increment is read by a filter on the source's partition column;
5. output goes to a folder whose number no other writer can have, and one commit makes
   the data and the new read positions visible together. A job that died before it
   leaves a folder that nobody reads; one that died after it has nothing to repeat;
6. new marks (position and time) are appended; a rerun completes missing ones.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import functools
import json
import logging
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.casting import ConformSpec
from tierline.functions.text import render_template, row_text
from tierline.operators import conform as conform_ops
from tierline.operators import dedup, enrich, facts, incremental, keybuckets, metadata, profile, quality, runlog, scd2
from tierline.session import scratch_path
from tierline.sources.files import remove
from tierline.sources.tables import (
    DIMENSION_BUCKETS,
    DimensionStore,
    LoadLog,
    VersionedTable,
    append_rows,
    compact_log,
    ensure_log,
    read_log,
    visible,
    write_observed,
)
from tierline.streaming.bronze import RESCUE_COLUMN, IngestResult, ingest_files, last_batches, read_batches


log = logging.getLogger("tierline.jobs")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@contextlib.contextmanager
def _step(name: str):
    """Log how long a step of a job took (DEBUG level)."""
    t0 = time.perf_counter()
    yield
    log.debug("%s: %.2fs", name, time.perf_counter() - t0)


@dataclass
class Lake:
    root: str

    def layer(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def system(self, name: str) -> str:
        return self.layer("system", name)

    def create_logs(self, spark: SparkSession) -> None:
        """Create the system tables that do not exist yet, empty, so they can be read from the start."""
        for name, schema in SYSTEM_LOGS.items():
            ensure_log(spark, self.system(name), schema)

    def compact_logs(self, spark: SparkSession) -> dict[str, int]:
        """Put each system table's small files together, also while jobs run; the files taken in, by table."""
        return {name: compact_log(spark, self.system(name)) for name in SYSTEM_LOGS}


#: Check results with the number of the load that they belong to (none where a gate stopped the job).
QUALITY_SCHEMA = T.StructType([*quality.RESULT_SCHEMA.fields, T.StructField("load", T.LongType())])

SYSTEM_LOGS = {
    "marks": incremental.MARK_SCHEMA,
    "runs": runlog.RUN_SCHEMA,
    "audit": runlog.AUDIT_SCHEMA,
    "metrics": runlog.METRIC_SCHEMA,
    "quality": QUALITY_SCHEMA,
}


# ------------------------------------------------------------------ run logging


def run_job(spark: SparkSession, lake: Lake, layer: str, job: str, fn: Callable[[], int | None]) -> int:
    """Run ``fn`` between a RUNNING and a SUCCESS/FAILED row (+ audit START/END/ERROR).

    A failure is logged and re-raised. The end row needs no prior row, so a
    failure that happens while logging the start still leaves a FAILED row.
    """
    run_id = runlog.new_run_id()
    try:
        append_rows(runlog.start_row(spark, run_id, layer, job), lake.system("runs"))
        append_rows(runlog.audit_row(spark, run_id, runlog.START, f"{layer}.{job} started"), lake.system("audit"))
        records = int(fn() or 0)
    except Exception as e:
        msg = f"{type(e).__name__}: {e}"
        append_rows(runlog.end_row(spark, run_id, runlog.FAILED, 0, msg, layer, job), lake.system("runs"))
        append_rows(runlog.audit_row(spark, run_id, runlog.ERROR, msg), lake.system("audit"))
        raise
    append_rows(runlog.end_row(spark, run_id, runlog.SUCCESS, records, None, layer, job), lake.system("runs"))
    append_rows(runlog.audit_row(spark, run_id, runlog.END, f"{records} records"), lake.system("audit"))
    return records


def run_states(spark: SparkSession, lake: Lake) -> DataFrame:
    return runlog.latest_state(read_log(spark, lake.system("runs"), runlog.RUN_SCHEMA))


# ------------------------------------------------------------------ marks


def marks(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_log(spark, lake.system("marks"), incremental.MARK_SCHEMA)


def _append_marks(
    spark: SparkSession, lake: Lake, pipeline: str, src: str, positions: Mapping[str, int], times: Mapping[str, object]
) -> None:
    """One mark row per source that moved (one append)."""
    rows, now = None, _now()
    for name, position in positions.items():
        r = incremental.mark_rows(spark, pipeline, src, name, times.get(name), now, position)
        rows = r if rows is None else rows.unionByName(r)
    if rows is not None:
        append_rows(rows.coalesce(1), lake.system("marks"))


def _complete_marks(
    spark: SparkSession, lake: Lake, pipeline: str, src: str, positions: Mapping[str, int], times: Mapping[str, object]
) -> None:
    """Append the marks that a job which died after its commit has left out."""
    log = marks(spark, lake).filter(F.col("pipeline_name") == pipeline)
    marked = {
        r["pipeline_destination"]: r["position"]
        for r in log.groupBy("pipeline_destination").agg(F.max("position").alias("position")).collect()
    }
    behind = {name: p for name, p in positions.items() if marked.get(name) is None or marked[name] < p}
    _append_marks(spark, lake, pipeline, src, behind, times)


# ------------------------------------------------------------------ bronze


def bronze_job(
    spark: SparkSession, lake: Lake, table: str, source_dir: str, fmt: str, options: Mapping[str, str] | None = None,
    max_files_per_trigger: int = 1000, rescue_column: str | None = RESCUE_COLUMN,
) -> IngestResult:
    base = lake.layer("bronze", table)
    return ingest_files(
        spark, source_dir, base, f"{base}_checkpoint", fmt, options=options, schema_location=f"{base}_schema",
        max_files_per_trigger=max_files_per_trigger, rescue_column=rescue_column,
    )


def bronze_jobs(
    spark: SparkSession, lake: Lake, sources: Mapping[str, tuple[str, str, Mapping[str, str] | None]]
) -> dict[str, IngestResult]:
    """Independent bronze loads ``{table: (source_dir, format, options)}``, run side by side.

    Each stream has its own folder and checkpoint; a failure of one is raised after the others have ended.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(sources))) as pool:
        started = {t: pool.submit(bronze_job, spark, lake, t, *source) for t, source in sources.items()}
    return {t: run.result() for t, run in started.items()}


# ------------------------------------------------------------------ silver


@dataclass
class SilverSource:
    """One bronze input: its folder and how to flatten it to the common raw columns."""

    bronze_path: str
    json_fields: Mapping[str, tuple[str, str]] = field(default_factory=dict)  # target -> (column, '$.path')
    xml_fields: Mapping[str, tuple[str, str]] = field(default_factory=dict)  # target -> (column, tag)
    drop: Sequence[str] = ()


@dataclass
class SilverResult:
    loaded: int
    rejected: int
    checks: list[quality.CheckResult]


def _flatten(df: DataFrame, src: SilverSource) -> DataFrame:
    for flatten, fields in ((conform_ops.flatten_json, src.json_fields), (conform_ops.flatten_xml, src.xml_fields)):
        for column in dict.fromkeys(c for c, _ in fields.values()):
            df = flatten(df, column, {target: path for target, (c, path) in fields.items() if c == column})
    return df.drop(*src.drop)


def _gate(
    spark: SparkSession, lake: Lake, table: str, parts: Mapping[str, DataFrame], spec: ConformSpec,
    required: Sequence[str], null_gates: Sequence[str], at: dt.datetime,
) -> list[quality.CheckResult]:
    """Check the raw sources; on failure write every result, then raise ``QualityError``.

    Each source must have the ``required`` columns, some source each of the spec's
    columns, and the ``null_gates`` columns no NULL in any source (one aggregate).
    """
    checks = [quality.check_columns(df, "silver", f"{table}.{name}", required) for name, df in parts.items()]
    everywhere = {c for df in parts.values() for c in df.columns}
    missing = [source for source, _, _ in spec if source not in everywhere]
    checks.append(quality.schema_result("silver", table, missing))
    if null_gates and not any(c.status == "FAIL" for c in checks):
        union = conform_ops.union_sources({n: df.select(*null_gates) for n, df in parts.items()}, None)
        checks += quality.check_nulls(union, "silver", table, null_gates)
    if any(c.status == "FAIL" for c in checks):
        _log_checks(spark, lake, table, None, checks, at)
        quality.raise_on_failure(checks)
    return checks


def silver_job(
    spark: SparkSession,
    lake: Lake,
    table: str,
    sources: Mapping[str, SilverSource],
    spec: ConformSpec,
    keys: Sequence[str],
    not_null: Sequence[str] = (),
    as_of: dt.datetime | None = None,
    required: Sequence[str] | None = None,
    null_gates: Sequence[str] = (),
    rows_per_bucket: int = keybuckets.ROWS_PER_BUCKET,
) -> SilverResult:
    """Bronze sources → typed, de-duplicated silver rows (C2/C3).

    A load's rows lie in buckets of their key, of about ``rows_per_bucket`` rows, so
    the next load's look-up of loaded keys opens only what can hold one of its keys.

    ``required`` raw columns (default: those behind the keys) must be in every source, and
    ``null_gates`` raw columns without NULL, or the job logs the result and fails. Rows with
    values that do not convert, NULL in ``not_null`` or a repeated key go to quarantine.
    """
    as_of = as_of or _now()
    pipeline = f"silver.{table}"
    # A source that has delivered nothing yet has no batch log: it simply takes no part.
    with _step(f"{pipeline}: positions"):
        newest = last_batches(spark, {name: s.bronze_path for name, s in sources.items()})
        loads = LoadLog(spark, lake.layer("silver", table))
        last = loads.last()
        done = loads.positions(last) if last is not None else {}
    times = {name: row["ingestion_time"] for name, row in newest.items()}
    pending = {name: row["number"] for name, row in newest.items() if row["number"] > done.get(name, 0)}
    if not pending:
        _complete_marks(spark, lake, pipeline, "bronze", done, times)
        return SilverResult(0, 0, [])
    parts = {}
    for name in sources:
        if name in pending:
            rows = read_batches(spark, sources[name].bronze_path, newest[name], after=done.get(name)).drop("batch_id")
            parts[name] = _flatten(rows, sources[name])
    if required is None:
        raw_of = {target: source for source, target, _ in spec}
        required = list(dict.fromkeys(raw_of[k] for k in [*keys, *not_null] if k in raw_of))
    checks = _gate(spark, lake, table, parts, spec, required, null_gates, as_of)
    union = conform_ops.union_sources(parts, source_col="source")
    if RESCUE_COLUMN not in union.columns:
        union = union.withColumn(RESCUE_COLUMN, F.lit(None).cast("string"))
    # The increment feeds two writes (silver and quarantine) and the look-up of its keys: keep it
    # typed for the job's duration. A lost executor recomputes its part from the bounded bronze read.
    union = union.withColumnRenamed("ingestion_time", "bronze_ingestion_time")
    flagged = conform_ops.conform_flagged(union, spec, keep=KEPT).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        load = loads.begin(last)
        valid, bad_casts = conform_ops.split_flagged(flagged, spec, keep=KEPT)
        result, schema, state = _judged(spark, lake, table, valid, bad_casts, loads, load, keys, not_null, as_of, rows_per_bucket)
    finally:
        flagged.unpersist()
    with _step(f"{pipeline}: logs and marks"):
        result.checks[:0] = checks
        # The results stand before the commit, under the load's number: a job that dies in
        # between repeats its load under another one, and only committed loads' results count.
        _log_checks(spark, lake, table, load.number, result.checks, as_of)
        loads.commit(load, result.loaded, pending, schema, keybuckets.LAYOUT, state)
        _append_marks(spark, lake, pipeline, "bronze", pending, times)
    return result


def _log_checks(
    spark: SparkSession, lake: Lake, table: str, load: int | None, checks: Sequence[quality.CheckResult], at: dt.datetime
) -> None:
    rows = quality.result_rows(spark, checks, at).withColumn("load", F.lit(load).cast("long"))
    append_rows(rows, lake.system("quality"))


def quality_log(spark: SparkSession, lake: Lake) -> DataFrame:
    """Check results, of loads that were refused by a gate (no load number) or committed; not of loads that died."""
    log = read_log(spark, lake.system("quality"), QUALITY_SCHEMA)
    tables = [r["table_name"] for r in log.filter(F.col("load").isNotNull()).select("table_name").distinct().collect()]
    lost = F.lit(False)
    for name in tables:  # one small file a table
        last = LoadLog(spark, lake.layer("silver", name.partition(".")[0])).last()
        gone = F.lit(True) if last is None else ~visible("load", last)
        lost = lost | ((F.col("table_name") == name) & F.col("load").isNotNull() & gone)
    return log.filter(~lost)


#: Lineage that silver rows carry beside their typed columns.
KEPT = ["file_path", "bronze_ingestion_time", "source", RESCUE_COLUMN]


def loaded_keys(loads: LoadLog, last: Mapping | None, keys: Sequence[str], wanted: Sequence[int]) -> DataFrame | None:
    """Loaded rows' keys, from the folders that can hold keys of the ``wanted`` buckets; ``None`` before the first load."""
    if last is None:
        return None
    rows = loads.read(last=last, where=keybuckets.can_hold(last["state"]["layouts"], wanted))
    return rows.select(*[F.col(f"`{k}`") for k in keys])


#: Most keys that a job broadcasts to mark rows by, and most rows of an increment that others' keys are cut by.
BROADCAST_KEYS = 500_000
SMALL_INCREMENT = 1_000_000


def _judged(spark, lake, table, valid, bad_casts, loads, load, keys, not_null, as_of, rows_per_bucket):
    """Gates on typed rows (persisted ones): new ones to the load's folder, all others to quarantine under its number."""
    pipeline, number = f"silver.{table}", load.number
    valid = valid.withColumn("silver_ingestion_time", F.lit(as_of).cast("timestamp"))
    key_nulls = None
    valid_nn = valid
    if not_null:
        any_null = functools.reduce(lambda a, b: a | b, [F.col(c).isNull() for c in not_null])
        key_nulls, valid_nn = valid.filter(any_null), valid.filter(~any_null)
    with _step(f"{pipeline}: key buckets"):
        n, wanted = keybuckets.touched(valid_nn, keys)
    layouts = [] if load.base is None else load.base["state"]["layouts"]
    existing = loaded_keys(loads, load.base, keys, wanted)
    # Read by both writes. Mostly few: then they are broadcast, and no whole row is shuffled for its key.
    barred = dedup.barred_keys(valid_nn, existing, keys, prefilter=n <= SMALL_INCREMENT).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with _step(f"{pipeline}: repeated and loaded keys"):
            few = barred.count() <= BROADCAST_KEYS
        return _written(
            spark, lake, table, valid, valid_nn, key_nulls, bad_casts, barred, few, loads, load, keys, as_of, n, layouts, rows_per_bucket
        )
    finally:
        barred.unpersist()


def _written(
    spark, lake, table, valid, valid_nn, key_nulls, bad_casts, barred, few, loads, load, keys, as_of, n, layouts, rows_per_bucket
):
    """The two writes of a load: its rows without a barred key, and its quarantine."""
    pipeline, number = f"silver.{table}", load.number

    def of(some: DataFrame) -> DataFrame:
        marked = some.select(*dedup.prefixed_keys(keys))
        return F.broadcast(marked) if few else marked

    new_rows = valid_nn.join(of(barred), dedup.same_keys(keys), "left_anti").drop(RESCUE_COLUMN)
    dups = valid_nn.join(of(barred.filter(F.col("_tl_n") > 1)), dedup.same_keys(keys), "left_semi")
    dups = dups.withColumn("reject_reason", F.lit("Duplicate business key"))
    buckets = keybuckets.buckets_for(n, rows_per_bucket)
    with _step(f"{pipeline}: write silver"):
        laid_out = keybuckets.with_layout(new_rows, keys, buckets)
        profiled = [c for c in new_rows.columns if c not in ("file_path", "bronze_ingestion_time", "silver_ingestion_time")]
        loaded, found = profile.write_profiled(laid_out, load.folder, profiled, keybuckets.LAYOUT)
        profile.append_profile(spark, loads.base, number, found)

    rejects = quality.quarantine_rows(dups, f"silver.{table}", at=as_of)
    rejects = rejects.unionByName(quality.quarantine_rows(bad_casts, f"silver.{table}", at=as_of))
    if key_nulls is not None:
        # a malformed record has only its rescued text, so its key is NULL
        why = F.when(F.col(RESCUE_COLUMN).isNotNull(), "Malformed record").otherwise("NULL key")
        rejects = rejects.unionByName(
            quality.quarantine_rows(key_nulls.withColumn("reject_reason", why), f"silver.{table}", at=as_of)
        )
    reason = F.col("reject_reason")
    with _step(f"{pipeline}: write rejects"):
        seen = write_observed(
            rejects, f"{lake.system('rejects')}/table={table}/load={number}",
            business_key_check=F.count_if(reason == "Duplicate business key"),
            cast_check=F.count_if(reason.startswith("Invalid value")),
            key_null_check=F.count_if(reason == "NULL key"),
            record_check=F.count_if(reason == "Malformed record"),
        )
    checks = [
        quality.CheckResult("silver", table, name, "PASS" if n == 0 else "FAIL", n, f"{n} rows quarantined")
        for name, n in seen.items()
        if name != "rows"
    ]
    state = {
        "layouts": sorted({*layouts, buckets}), "keys": list(keys),
        "reject_schemas": {"typed": valid.schema.json(), "raw": bad_casts.drop("reject_reason").schema.json()},
    }
    return SilverResult(loaded, seen["rows"], checks), new_rows.schema, state


def table_profile(spark: SparkSession, lake: Lake, table: str) -> DataFrame | None:
    """The silver table's profile, merged from its committed loads' (no data is read); ``None`` before the first load."""
    loads = LoadLog(spark, lake.layer("silver", table))
    last = loads.last()
    if last is None:
        return None
    profiles = spark.read.schema(profile.PROFILE_SCHEMA).parquet(f"{loads.base}/_profiles")
    return profile.merged_profile(profiles.filter(visible("load", last)))


def replay_job(
    spark: SparkSession,
    lake: Lake,
    table: str,
    spec: ConformSpec,
    keys: Sequence[str],
    not_null: Sequence[str] = (),
    as_of: dt.datetime | None = None,
    fix: Callable[[DataFrame], DataFrame] | None = None,
    rows_per_bucket: int = keybuckets.ROWS_PER_BUCKET,
) -> SilverResult:
    """Judge the table's quarantine again, and re-admit what passes as a load of its own (a way back for rejected rows).

    Payloads are read back by the schemas that the loads have stored. Values that did not
    convert are conformed again by ``spec`` (a corrected one), rows that a gate rejected are
    taken as they are; ``fix`` may correct or drop typed rows before the gates. A row whose
    key has been loaded meanwhile (a corrected delivery) is settled. What fails again is
    quarantined under the new load's number. Records that could not be read stay.
    """
    as_of = as_of or _now()
    loads = LoadLog(spark, lake.layer("silver", table))
    last = loads.last()
    rejects = read_rejects(spark, lake, table)
    if last is None or rejects is None or rejects.isEmpty():
        return SilverResult(0, 0, [])
    schemas = {k: T.StructType.fromJson(json.loads(v)) for k, v in last["state"]["reject_schemas"].items()}

    def rows_of(which: Column, kind: str) -> DataFrame:
        return rejects.filter(which).select(F.from_json("payload", schemas[kind]).alias("r")).select("r.*")

    reason = F.col("reject_reason")
    unread, uncast = reason == "Malformed record", reason.startswith("Invalid value")
    flagged = conform_ops.conform_flagged(rows_of(uncast, "raw"), spec, keep=KEPT).persist(StorageLevel.MEMORY_AND_DISK)
    valid, bad_casts = conform_ops.split_flagged(flagged, spec, keep=KEPT)
    typed = rows_of(~uncast & ~unread, "typed").drop("silver_ingestion_time").unionByName(valid)
    if fix is not None:
        typed = fix(typed)
    typed = typed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        load = loads.begin(last)
        result, schema, state = _judged(spark, lake, table, typed, bad_casts, loads, load, keys, not_null, as_of, rows_per_bucket)
    finally:
        typed.unpersist()
        flagged.unpersist()
    numbers = [r["load"] for r in rejects.filter(~unread).select("load").distinct().collect()]  # load numbers
    state["replayed"] = sorted({*last["state"].get("replayed", ()), *numbers})
    state["replays"] = {**last["state"].get("replays", {}), str(load.number): sorted(numbers)}
    _log_checks(spark, lake, table, load.number, result.checks, as_of)
    loads.commit(load, result.loaded, {}, schema, keybuckets.LAYOUT, state)
    return result


def read_rejects(spark: SparkSession, lake: Lake, table: str) -> DataFrame | None:
    """The table's quarantine: of committed loads only (a partition filter), without what a replay has judged again."""
    last = LoadLog(spark, lake.layer("silver", table)).last()
    if last is None:
        return None
    rejects = spark.read.schema(REJECT_SCHEMA).parquet(f"{lake.system('rejects')}/table={table}")
    rejects = rejects.filter(visible("load", last))
    settled = last["state"].get("replayed", [])
    return rejects.filter(~F.col("load").isin(settled) | (F.col("reject_reason") == "Malformed record")) if settled else rejects


#: Stable shape of quarantined rows, with the number of the load that rejected them.
REJECT_SCHEMA = "source STRING, reject_reason STRING, payload STRING, rejected_at TIMESTAMP, load BIGINT"


# ------------------------------------------------------------------ gold


@dataclass
class DimensionResult:
    changes: int  # new and changed keys
    rewritten: int  # buckets
    buckets: int  # of the dimension


def dimension_job(
    spark: SparkSession,
    lake: Lake,
    dim: str,
    silver_table: str,
    keys: Sequence[str],
    attrs: Sequence[str],
    tracked: Sequence[str],
    order: Sequence[Column],
    key_col: str,
    as_of: dt.datetime | None = None,
    buckets: int = DIMENSION_BUCKETS,
) -> DimensionResult | None:
    """Silver → SCD2 dimension (C4/C5); the mark advances even when nothing changed.

    ``buckets``: of a new dimension's current rows. A load compares with the buckets that
    its keys are in and rewrites those that a change is in.
    Returns ``None`` when silver holds no load beyond the last one applied.
    """
    as_of = as_of or _now()
    pipeline = f"gold.{dim}"
    silver = LoadLog(spark, lake.layer("silver", silver_table))
    last = silver.last()
    if last is None:
        return None
    end, times = int(last["number"]), {silver_table: last["committed_at"]}
    store = DimensionStore(spark, lake.layer("gold", dim), keys, buckets)
    done = store.committed_position()
    if done is not None and end <= done:
        _complete_marks(spark, lake, pipeline, f"silver.{silver_table}", {silver_table: done}, times)
        return None
    if store.keys != list(keys):
        raise ValueError(f"{dim}: its keys are {store.keys}")
    staging = scratch_path(spark, f"{dim}-changes")
    try:
        with _step(f"{pipeline}: changes"):
            incoming = silver.read(after=done, last=last)
            start = store.committed_max_key() or 0
            current = store.current(keybuckets.touched(incoming, keys, store.buckets)[1]) if store.exists() else None
            changes = scd2.scd2_changes(current, incoming, keys, attrs, tracked, order, key_col, start_key=start, staging=staging)
            # the change set is a written table, so this reads only its key columns
            seen = changes.agg(
                F.count(F.lit(1)).alias("n"), F.max(key_col).alias("top"), F.collect_set(store.bucket()).alias("touched")
            ).first()
        with _step(f"{pipeline}: write"):
            if current is None or seen["n"]:
                some = None if current is None else store.current(seen["touched"])
                rows = scd2.scd2_rows(some, changes, keys, attrs, as_of, key_col)
                store.write_load(rows, seen["touched"], max_key=seen["top"] or start, position=end)
            else:  # no new or changed key: nothing to rewrite
                store.advance(end)
    finally:
        remove(spark, staging)
    with _step(f"{pipeline}: marks"):
        _append_marks(spark, lake, pipeline, f"silver.{silver_table}", {silver_table: end}, times)
    return DimensionResult(seen["n"], len(seen["touched"]), store.buckets)


#: Partition column of fact loads: 1 for rows whose dimension key is not known yet.
KEY_OPEN = "key_open"


def fact_job(
    spark: SparkSession,
    lake: Lake,
    fact: str,
    silver_table: str,
    dim: str,
    keys: Sequence[str],
    key_col: str,
    columns: Sequence[str],
    as_of: dt.datetime | None = None,
) -> int:
    """Silver rows → fact rows keyed to the current dimension version (C6); returns the silver rows loaded.

    Rows without a dimension row get a NULL key and lie apart in their load. Once the
    dimension has changed, the next run looks them up again: they are written anew, with
    their keys where these have arrived, and replace their old copies; other rows are
    not touched. That needs the business keys among ``columns``.
    """
    as_of = as_of or _now()
    pipeline = f"gold.{fact}"
    silver = LoadLog(spark, lake.layer("silver", silver_table))
    last = silver.last()
    if last is None:
        return 0
    end, times = int(last["number"]), {silver_table: last["committed_at"]}
    loads = LoadLog(spark, lake.layer("gold", fact))
    before = loads.last()
    state = {"open": {}, "dimension": 0} if before is None else before["state"]
    done = loads.positions(before).get(silver_table) if before is not None else None
    store = DimensionStore(spark, lake.layer("gold", dim))
    version = store.latest_version() or 0
    late = bool(state["open"]) and version > state["dimension"] and set(keys) <= set(columns)
    if done is not None and end <= done and not late:
        _complete_marks(spark, lake, pipeline, f"silver.{silver_table}", {silver_table: done}, times)
        return 0
    # read by its keys and by the join: of the load's immutable folders, the needed columns only
    incoming = silver.read(after=done, last=last).select(*dict.fromkeys([*keys, *columns]))
    waiting = loads.read(last=before, where=F.col(KEY_OPEN) == 1).drop("load") if late else None
    asked = incoming.select(*keys) if waiting is None else incoming.select(*keys).unionByName(waiting.select(*keys))
    n, wanted = keybuckets.touched(asked, keys, store.buckets)
    dimension = store.current(wanted if store.keys == list(keys) else None)
    # A small increment cuts the dimension to its keys; a large one touches most of it, so that would only add work.
    small = done is not None and n <= SMALL_INCREMENT
    distinct = asked.select(*dedup.prefixed_keys(keys)).distinct()
    touched = dimension.join(distinct, dedup.same_keys(keys), "left_semi") if small else dimension
    # Several current rows for one key would multiply fact rows: check the keys this load touches.
    twice = quality.unique_current_keys(touched, keys)
    clash = not twice.isEmpty()
    if clash and done is not None and not small:
        clash = not twice.join(distinct, dedup.same_keys(keys), "left_semi").isEmpty()
    if clash:
        raise quality.QualityError(f"{dim}: business keys with more than one current row")
    rows = facts.fact_rows(incoming, dimension, keys, key_col, columns, created_at=as_of, prefilter=small)
    if waiting is not None:
        again = waiting.drop(key_col).withColumnRenamed("created_at", "_tl_created_at")
        again = facts.fact_rows(again, dimension, keys, key_col, [*columns, "_tl_created_at"], created_at=as_of, prefilter=n <= SMALL_INCREMENT)
        rows = rows.unionByName(again.withColumn("created_at", F.col("_tl_created_at")).select(*rows.columns))
    load = loads.begin(before)
    missing = F.col(key_col).isNull()
    placed = rows.withColumn(KEY_OPEN, missing.cast("int"))
    seen = write_observed(placed, load.folder, [KEY_OPEN], open=F.count_if(missing))
    still = {} if late else dict(state["open"])
    loads.commit(
        load, seen["rows"], {silver_table: end}, rows.schema, [KEY_OPEN],
        {"open": {**still, **({str(load.number): seen["open"]} if seen["open"] else {})}, "dimension": version},
        replaced={KEY_OPEN: map(int, state["open"])} if late else None,
    )
    _append_marks(spark, lake, pipeline, f"silver.{silver_table}", {silver_table: end}, times)
    return seen["rows"] - (sum(state["open"].values()) if late else 0)


# ------------------------------------------------------------------ metadata-driven (C7–C9)


def metadata_bronze_job(spark: SparkSession, lake: Lake, config: Mapping) -> int:
    """Config-driven batch load to a snapshot table + one metric row (failure logged, then raised)."""
    target = VersionedTable(spark, lake.layer("bronze", config["target"]["table"]))
    try:
        _, n = target.write_counted(metadata.read_source(spark, config))
    except Exception as e:
        append_rows(runlog.metric_row(spark, "bronze_ingestion", runlog.FAILED, 0, str(e)), lake.system("metrics"))
        raise
    append_rows(runlog.metric_row(spark, "bronze_ingestion", runlog.SUCCESS, n), lake.system("metrics"))
    return n


def metadata_silver_job(spark: SparkSession, lake: Lake, config: Mapping) -> int:
    source = VersionedTable(spark, lake.layer("bronze", config["source"]["table"])).read()
    target = VersionedTable(spark, lake.layer("silver", config["target"]["table"]))
    return target.write(metadata.apply_rules(source, config["cleaning_rules"]))


def metadata_gold_job(spark: SparkSession, lake: Lake, config: Mapping, source: DataFrame | None = None) -> int:
    src = source if source is not None else VersionedTable(spark, lake.layer("silver", config["source"]["table"])).read()
    target = VersionedTable(spark, lake.layer("gold", config["target"]["table"]))
    return target.write(metadata.aggregate_metrics(src, config))


# ------------------------------------------------------------------ model review / enrichment (C10, C11)


@dataclass
class ReviewResult:
    reviewed: int
    calls: int  # prompts that the model was asked


def ask(
    spark: SparkSession, answers: LoadLog, prompts: DataFrame, prompt_col: str, scorer: enrich.Scorer, out_col: str
) -> tuple[DataFrame, int]:
    """(``prompts`` with an answer each, how many the model was asked).

    Answers are a table of their own, by the prompt's hash: each distinct prompt is asked
    once, and only if no run before has got an answer to it. A failed call's message is the
    answer of this run; the next run asks again.
    """
    hashed = prompts.withColumn("_tl_hash", F.sha2(F.col(f"`{prompt_col}`"), 256))
    last = answers.last()
    todo = hashed.filter(F.col("_tl_hash").isNotNull()).groupBy("_tl_hash").agg(F.first(prompt_col).alias("_tl_ask"))
    if last is not None:
        got = answers.read(last=last).filter("ok").select("_tl_hash")
        todo = todo.join(got, "_tl_hash", "left_anti")
    found = enrich.enrich_with_model(todo, "_tl_ask", scorer, out_col="answer").select(
        "_tl_hash", "answer", (~F.col("answer").startswith(enrich.ERROR_PREFIX)).alias("ok")
    )
    load = answers.begin(last)
    calls = write_observed(found, load.folder)["rows"]
    if calls:
        answers.commit(load, calls, {}, found.schema)
    known = answers.read()
    if known is None:
        return prompts.withColumn(out_col, F.lit(None).cast("string")), calls
    known = known.filter(F.col("ok") | (F.col("load") == load.number)).select("_tl_hash", F.col("answer").alias(out_col))
    return hashed.join(known, "_tl_hash", "left").drop("_tl_hash"), calls


def review_job(
    spark: SparkSession,
    lake: Lake,
    df: DataFrame,
    table_name: str,
    check_name: str,
    columns: Sequence[str],
    template: str,
    scorer: enrich.Scorer,
) -> ReviewResult:
    """Rows to review → prompt per row → answer per row → results log; the model is asked once a distinct prompt.

    Every row of ``df`` is reviewed (filter it for candidates). Answers of earlier runs are used again.
    """
    prompts = df.select(row_text(columns).alias("input_record"), render_template(template).alias("_tl_prompt"))
    answers = LoadLog(spark, lake.system("ai_answers"))
    answered, calls = ask(spark, answers, prompts, "_tl_prompt", scorer, "ai_result")
    out = answered.select(
        F.lit(table_name).alias("table_name"), F.lit(check_name).alias("check_name"), "input_record", "ai_result",
        F.current_timestamp().alias("created_time"),
    )
    return ReviewResult(write_observed(out, f"{lake.system('ai_results')}/run={uuid.uuid4().hex}")["rows"], calls)


def enrich_csv_job(
    spark: SparkSession,
    source_csv: str,
    target_csv: str,
    prompt: Column,
    scorer: enrich.Scorer,
    out_col: str,
    keep: Sequence[str],
    answers: str | None = None,
) -> int:
    """CSV (header, all text) → prompt column → an answer per row → CSV with header (C11); returns the model's calls.

    ``answers``: folder of the answers that runs share; without it every row is asked.
    """
    df = spark.read.option("header", "true").csv(source_csv).withColumn("query", prompt)
    if answers is None:
        out, calls = enrich.enrich_with_model(df, "query", scorer, out_col=out_col), df.count()
    else:
        out, calls = ask(spark, LoadLog(spark, answers), df, "query", scorer, out_col)
    out.select(*keep).write.mode("overwrite").option("header", "true").csv(target_csv)
    return calls

"""Run, audit and job-metric logs, and keyed updates without MERGE.

Logs are append-only: a run writes a RUNNING row when it starts and a
SUCCESS/FAILED row when it ends; the state of a run is its latest row. This
needs no row update on files, a failed start needs no prior row, and run ids
are UUIDs (no two runs in the same second collide).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.rows import literal_rows
from tierline.operators.dedup import latest_per_key

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("layer", T.StringType(), True),
        T.StructField("job_name", T.StringType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("records", T.LongType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("audit_id", T.StringType(), False),
        T.StructField("run_id", T.StringType(), True),
        T.StructField("event", T.StringType(), False),
        T.StructField("message", T.StringType(), True),
        T.StructField("timestamp", T.TimestampType(), False),
    ]
)
METRIC_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType(), False),
        T.StructField("run_time", T.TimestampType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("records_processed", T.LongType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)

# Run states and audit events.
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
START, END, ERROR = "START", "END", "ERROR"
_STATE_RANK = {RUNNING: 0, SUCCESS: 1, FAILED: 1}


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def new_run_id() -> str:
    return str(uuid.uuid4())


def run_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Rows ``(run_id, layer, job_name, status, event_time, records, error)``."""
    return literal_rows(spark, rows, RUN_SCHEMA)


def start_row(spark: SparkSession, run_id: str, layer: str, job: str, at=None) -> DataFrame:
    return run_rows(spark, [(run_id, layer, job, RUNNING, at or _now(), 0, None)])


def end_row(spark: SparkSession, run_id: str, status: str, records=0, error=None, layer=None, job=None, at=None):
    return run_rows(spark, [(run_id, layer, job, status, at or _now(), int(records or 0), error)])


def audit_row(spark: SparkSession, run_id: str, event: str, message: str | None, at=None) -> DataFrame:
    return literal_rows(spark, [(str(uuid.uuid4()), run_id, event, message, at or _now())], AUDIT_SCHEMA)


def metric_row(spark: SparkSession, job: str, status: str, records, error=None, at=None) -> DataFrame:
    return literal_rows(spark, [(job, at or _now(), status, None if records is None else int(records), error)], METRIC_SCHEMA)


def state_rank(status: Column) -> Column:
    """Terminal states sort after RUNNING when two rows share a timestamp."""
    expr = None
    for state, rank in _STATE_RANK.items():
        expr = F.when(status == state, rank) if expr is None else expr.when(status == state, rank)
    return expr.otherwise(0)


def latest_state(log: DataFrame, key: str = "run_id", time_col: str = "event_time") -> DataFrame:
    """Latest row per run (top-1 cut in each map task; ties resolved in favour of an end state).

    Where the latest row names no layer or job, the run's earliest row that does gives them.
    """
    latest = latest_per_key(log, [key], [F.col(time_col).desc(), state_rank(F.col("status")).desc()])
    names = [c for c in ("layer", "job_name") if c in log.columns]
    if not names:
        return latest
    named = log.filter(F.coalesce(*[F.col(c) for c in names]).isNotNull())
    first = latest_per_key(named, [key], [F.col(time_col).asc(), state_rank(F.col("status")).asc()])
    first = first.select(F.col(key).alias("_tl_key"), *[F.col(c).alias(f"_tl_{c}") for c in names])
    joined = latest.join(first, F.col(key) == F.col("_tl_key"), "left")
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"_tl_{c}")).alias(c) if c in names else F.col(c) for c in log.columns]
    )


def update_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str], set_cols: Sequence[str]) -> DataFrame:
    """``MERGE … WHEN MATCHED THEN UPDATE SET`` as a new version of ``target``.

    Matched rows take the update's values (NULL included); unmatched target
    rows pass; update rows without a target row are ignored (no insert
    branch). ``updates`` must hold one row per key.
    """
    u = updates.select(*keys, *[F.col(c).alias(f"_tl_u_{c}") for c in set_cols], F.lit(True).alias("_tl_hit"))
    joined = target.join(u, list(keys), "left")
    hit = F.col("_tl_hit").isNotNull()
    cols = [
        F.when(hit, F.col(f"_tl_u_{c}")).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c)
        for c in target.columns
    ]
    return joined.select(*cols)


def audit_events(runs: DataFrame) -> DataFrame:
    """Audit rows for run states: START for every run, then END (SUCCESS) or ERROR (FAILED).

    ``runs`` carries ``run_id, job_name, status, event_time, records, error``.
    One generator over the rows; ids are ``uuid()`` on executors.
    """
    start = F.struct(F.lit(START).alias("event"), F.concat(F.lit("start "), F.col("job_name")).alias("message"))
    end = F.when(
        F.col("status") == SUCCESS,
        F.struct(F.lit(END).alias("event"), F.concat(F.lit("records "), F.col("records").cast("string")).alias("message")),
    ).when(F.col("status") == FAILED, F.struct(F.lit(ERROR).alias("event"), F.col("error").alias("message")))
    events = F.filter(F.array(start, end), lambda e: e.isNotNull())
    return runs.select(
        F.expr("uuid()").alias("audit_id"), "run_id", F.explode(events).alias("_tl_e"), "event_time"
    ).select("audit_id", "run_id", "_tl_e.event", "_tl_e.message", F.col("event_time").alias("timestamp"))


def job_metrics(frames: dict[str, DataFrame], run_time=None, status: str = SUCCESS) -> DataFrame:
    """One metric row per job with the row count of its output (one aggregate each, one job)."""
    when = F.current_timestamp() if run_time is None else run_time
    parts = [
        df.agg(F.count(F.lit(1)).alias("records_processed")).select(
            F.lit(job).alias("job_name"), when.alias("run_time"), F.lit(status).alias("status"),
            "records_processed", F.lit(None).cast("string").alias("error"),
        )
        for job, df in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

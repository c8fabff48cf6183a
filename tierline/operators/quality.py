"""Data quality: schema checks, null/positive reports, duplicate business keys
with quarantine, result rows and table expectations.

All counts of one check set come from a single aggregate over the data (one
scan), never one ``count()`` job per rule.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.rows import literal_rows
from tierline.operators.dedup import prefixed_keys, same_keys

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("layer", T.StringType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("check_name", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("failed_records", T.LongType(), True),
        T.StructField("message", T.StringType(), True),
        T.StructField("created_time", T.TimestampType(), True),
    ]
)


class QualityError(Exception):
    """A gate check failed; the result row is written before this is raised."""


@dataclass(frozen=True)
class CheckResult:
    layer: str
    table_name: str
    check_name: str
    status: str
    failed_records: int = 0
    message: str | None = None


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns absent from the frame (case-sensitive; schema only, no job)."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def check_columns(df: DataFrame, layer: str, table_name: str, required: Iterable[str]) -> CheckResult:
    return schema_result(layer, table_name, missing_columns(df, required))


def schema_result(layer: str, table_name: str, missing: Sequence[str]) -> CheckResult:
    if missing:
        return CheckResult(layer, table_name, "schema_check", "FAIL", len(missing), str(missing))
    return CheckResult(layer, table_name, "schema_check", "PASS")


def _report(df: DataFrame, columns: Sequence[str], failed: Mapping[str, Column], with_total: bool) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(cond).alias(f"_f{i}") for i, cond in enumerate(failed.values())]
    one = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.col("_total").alias("total_records"),
            F.col(f"_f{i}").alias("failed_records"),
        )
        for i, name in enumerate(columns)
    ]
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    out = out.withColumn(
        "status", F.when(F.col("failed_records") > 0, "FAILED").otherwise("PASSED")
    )
    return out if with_total else out.drop("total_records")


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, total_records, failed_records, status)`` per column, one scan."""
    return _report(df, columns, {c: F.col(f"`{c}`").isNull() for c in columns}, True)


def positive_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with ``value <= 0`` fail; NULL is not a failure. One scan."""
    return _report(df, columns, {c: F.col(f"`{c}`") <= 0 for c in columns}, True)


def check_nulls(df: DataFrame, layer: str, table_name: str, columns: Sequence[str]) -> list[CheckResult]:
    """Gates: the NULLs of each column, all counted by one aggregate."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return [
        CheckResult(layer, table_name, f"{c}_null_check", "PASS" if n == 0 else "FAIL", int(n), f"{n} NULL values")
        for c, n in zip(columns, counts, strict=True)
    ]


def raise_on_failure(results: Iterable[CheckResult]) -> None:
    failed = [r for r in results if r.status == "FAIL"]
    if failed:
        raise QualityError("; ".join(f"{r.table_name}.{r.check_name}: {r.message or r.failed_records}" for r in failed))


def split_duplicate_keys(
    df: DataFrame,
    keys: Sequence[str],
    reason: str = "Duplicate business key",
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: rows whose key occurs once, and *all* rows of repeated keys.

    NULL key parts group together (as in a window partition). Instead of a
    ``count(*) OVER (PARTITION BY key)``, which sorts every row of a hot key in
    one task, the keys alone are counted by a hash aggregate (map-side first).
    Valid and rejected rows then come from a null-safe anti- and semi-join with
    the repeated keys, whose hot partitions AQE splits.
    """
    counted = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_tl_n"))
    repeated = counted.filter(F.col("_tl_n") > 1).select(*prefixed_keys(keys))
    valid = df.join(repeated, same_keys(keys), "left_anti")
    rejected = df.join(repeated, same_keys(keys), "left_semi").withColumn("reject_reason", F.lit(reason))
    return valid, rejected


def quarantine_rows(rejected: DataFrame, source: str, reason_col: str = "reject_reason", at=None) -> DataFrame:
    """Stable quarantine shape ``(source, reject_reason, payload, rejected_at)``.

    The payload is the rejected row as JSON text (NULLs kept), so frames of any
    schema can share one quarantine table.
    """
    payload_cols = [c for c in rejected.columns if c != reason_col]
    when = F.lit(at).cast("timestamp") if at is not None else F.current_timestamp()
    return rejected.select(
        F.lit(source).alias("source"),
        F.col(reason_col).cast("string").alias("reject_reason"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in payload_cols]), {"ignoreNullFields": "false"}).alias(
            "payload"
        ),
        when.alias("rejected_at"),
    )


def result_rows(spark: SparkSession, results: Sequence[CheckResult], created=None) -> DataFrame:
    """All results of a run as one frame (one append, not one per check)."""
    now = created or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    data = [
        (r.layer, r.table_name, r.check_name, r.status, int(r.failed_records), r.message, now) for r in results
    ]
    return literal_rows(spark, data, RESULT_SCHEMA)


def expectations_report(tables: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Per table: row count, required columns present, number of repeated keys.

    ``tables`` maps a name to ``(frame, required_columns, key_columns)``. One
    aggregate per table, all branches unioned into one job.
    """
    parts = []
    for name, (df, required, keys) in tables.items():
        missing = missing_columns(df, required)
        dup_groups = (
            df.groupBy(*[F.col(f"`{k}`") for k in keys])
            .agg(F.count(F.lit(1)).alias("_n"))
            .agg(
                F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("row_count"),
                F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
            )
        )
        parts.append(
            dup_groups.select(
                F.lit(name).alias("table_name"),
                "row_count",
                (F.col("row_count") > 0).alias("has_rows"),
                F.lit(not missing).alias("has_required_columns"),
                "duplicate_keys",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unique_current_keys(dim: DataFrame, keys: Sequence[str], current_col: str = "is_current") -> DataFrame:
    """Business keys with more than one current row (must be empty before a fact join)."""
    return (
        dim.filter(F.col(current_col))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("current_rows"))
        .filter(F.col("current_rows") > 1)
    )


def expect_table(df: DataFrame, name: str, required: Sequence[str] = (), keys: Sequence[str] = ()) -> None:
    """Raise ``QualityError`` unless the table has rows, the required columns and unique ``keys``.

    Rows and repeated keys come from one aggregate over the table.
    """
    missing = missing_columns(df, [*required, *keys])
    if missing:
        raise QualityError(f"{name}: missing columns {missing}")
    if keys:
        row = (
            df.groupBy(*[F.col(f"`{k}`") for k in keys])
            .agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(F.col("_n") > 1).alias("dups"))
            .first()
        )
        rows, dups = int(row["rows"]), int(row["dups"])
    else:
        rows, dups = (0 if df.isEmpty() else 1), 0
    if rows == 0:
        raise QualityError(f"{name}: no rows")
    if dups:
        raise QualityError(f"{name}: {dups} repeated keys {list(keys)}")

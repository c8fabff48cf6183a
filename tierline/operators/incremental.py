"""High-water marks and bounded incremental reads.

A mark log is an append-only table ``(pipeline_name, pipeline_src,
pipeline_destination, ingestion_time, updated_at, position)``. The current mark of a
``(name, destination)`` pair is the ``ingestion_time`` of its latest row (a top-1
per key, cut in each map task before the shuffle). Rows are never
updated: a new mark is a new row, which is what a plain parquet table allows
and what makes a replay harmless.

Loads read ``lo < t <= hi`` with ``hi`` fixed *before* any write, so rows that
land while a load runs are left for the next one instead of being marked
processed without being loaded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.casting import literal_like
from tierline.functions.rows import literal_rows
from tierline.operators.dedup import latest_per_key

MARK_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType(), False),
        T.StructField("pipeline_src", T.StringType(), True),
        T.StructField("pipeline_destination", T.StringType(), False),
        T.StructField("ingestion_time", T.TimestampType(), True),
        T.StructField("updated_at", T.TimestampType(), False),
        T.StructField("position", T.LongType(), True),
    ]
)


def bounded(df: DataFrame, ts_col: str, lo=None, hi=None) -> DataFrame:
    """Rows with ``lo < ts <= hi`` (either bound may be None). Pushed to the scan."""
    dtype = df.schema[ts_col].dataType
    cond: Column | None = None
    if lo is not None:
        cond = F.col(ts_col) > literal_like(lo, dtype)
    if hi is not None:
        upper = F.col(ts_col) <= literal_like(hi, dtype)
        cond = upper if cond is None else cond & upper
    return df if cond is None else df.filter(cond)


def new_marks(df: DataFrame, ts_col: str, by: Sequence[str] = ()) -> DataFrame:
    """New mark (and row count) per source in one aggregate; NULL times are ignored."""
    aggs = [F.max(ts_col).alias("new_mark"), F.count(F.lit(1)).alias("n_rows")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def latest_marks(
    log: DataFrame,
    keys: Sequence[str] = ("pipeline_name", "pipeline_destination"),
    order_col: str = "updated_at",
    value_cols: Sequence[str] = ("ingestion_time",),
) -> DataFrame:
    """Latest row per key of an append-only log (top-1 by ``order_col``).

    ``row_number() = 1`` keeps one row per key in each map task (window group
    limit) before the shuffle, so a key holding most of the log moves little.
    Rows that share the latest time are ordered by their values.
    """
    order = [F.col(order_col).desc(), *[F.col(c).desc_nulls_last() for c in value_cols]]
    return latest_per_key(log.select(*keys, *value_cols, order_col), keys, order)


def read_mark(log: DataFrame, name: str, destination: str):
    """Scalar mark for one pair (one small job; None if there is none)."""
    rows = (
        log.filter((F.col("pipeline_name") == name) & (F.col("pipeline_destination") == destination))
        .orderBy(F.col("updated_at").desc())
        .limit(1)
        .collect()
    )
    return rows[0]["ingestion_time"] if rows else None


def mark_rows(
    spark: SparkSession,
    name: str,
    src: str,
    destination: str,
    mark,
    updated_at: dt.datetime | None = None,
    position: int | None = None,
) -> DataFrame:
    """One new mark row (append it to the log); ``position`` is the batch or load number behind the mark."""
    now = updated_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return literal_rows(spark, [(name, src, destination, mark, now, position)], MARK_SCHEMA)

"""Mergeable table profiles: per load and column row count, NULLs, bounds and a distinct sketch.

A load's profile comes from the write itself (an ``Observation``): no second pass. It is
a few rows, appended to the table's ``_profiles`` folder with the load's number. A table's
profile merges those of its committed loads, so reports on it read no data: counts
add up, bounds take the extremes, HLL sketches unite. Counts and bounds are exact;
the number of distinct values is an estimate with a relative standard error of about
``1.04 / sqrt(2 ** LOG2_K)``, 0.8 %.

Bounds are kept by kind: whole numbers and decimals exactly, floating point as doubles,
everything else (text, dates, times) as text in its own order.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.rows import literal_rows

#: Size of a distinct sketch.
LOG2_K = 14
PROFILE_SCHEMA = (
    "load long, column string, rows long, nulls long, low_exact decimal(38,10), high_exact decimal(38,10), "
    "low_double double, high_double double, low_text string, high_text string, sketch binary"
)
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
_HASHED = (*_EXACT, T.StringType, T.BinaryType)


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, _EXACT):
        return "exact"
    return "double" if isinstance(dtype, (T.FloatType, T.DoubleType)) else "text"


def _sketched(column: Column, dtype: T.DataType) -> Column:
    """A value that the sketch can hash; equal values stay equal."""
    if isinstance(dtype, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return column
    return column.cast("string")


def profile_aggregates(schema: T.StructType, columns: Sequence[str]) -> list[Column]:
    out = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        dtype, value = schema[name].dataType, F.col(f"`{name}`")
        shown = {"exact": value.cast("decimal(38,10)"), "double": value.cast("double"), "text": value.cast("string")}[_kind(dtype)]
        out += [
            F.count_if(value.isNull()).alias(f"nulls_{i}"), F.min(shown).alias(f"low_{i}"), F.max(shown).alias(f"high_{i}"),
            F.hll_sketch_agg(_sketched(value, dtype), F.lit(LOG2_K)).alias(f"sketch_{i}"),
        ]
    return out


def write_profiled(
    df: DataFrame, path: str, columns: Sequence[str], partition_by: Sequence[str] = ()
) -> tuple[int, list[tuple]]:
    """Overwrite ``path`` with ``df``; (rows, a profile row a column), observed by the write."""
    seen = Observation(f"profile_{uuid.uuid4().hex}")
    df.observe(seen, *profile_aggregates(df.schema, columns)).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    found = seen.get
    rows = int(found["rows"] or 0)
    out = []
    for i, name in enumerate(columns):
        bounds: dict[str, object] = {}
        kind = _kind(df.schema[name].dataType)
        bounds[f"low_{kind}"], bounds[f"high_{kind}"] = found[f"low_{i}"], found[f"high_{i}"]
        ordered = [bounds.get(f"{side}_{k}") for k in ("exact", "double", "text") for side in ("low", "high")]
        sketch = found[f"sketch_{i}"]
        out.append((name, rows, int(found[f"nulls_{i}"] or 0), *ordered, None if sketch is None else bytearray(sketch)))
    return rows, out


def append_profile(spark: SparkSession, base: str, load: int, rows: Sequence[tuple]) -> None:
    """Keep a load's profile; it counts once the load is committed."""
    frame = literal_rows(spark, [(load, *r) for r in rows], T.StructType.fromDDL(PROFILE_SCHEMA))
    frame.write.mode("append").parquet(f"{base}/_profiles")


def merged_profile(profiles: DataFrame) -> DataFrame:
    """(column, rows, nulls, bounds by kind, distinct estimate) of several loads' profiles."""
    lows = [F.min(c).alias(c) for c in ("low_exact", "low_double", "low_text")]
    highs = [F.max(c).alias(c) for c in ("high_exact", "high_double", "high_text")]
    found = profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), *lows, *highs, F.hll_union_agg("sketch").alias("sketch")
    )
    return found.withColumn("distinct_estimate", F.hll_sketch_estimate("sketch")).drop("sketch")


def null_report_of(profile: DataFrame) -> DataFrame:
    """``(column, total_records, failed_records, status)`` as of a null report, without reading the table."""
    status = F.when(F.col("nulls") > 0, "FAILED").otherwise("PASSED")
    return profile.select("column", F.col("rows").alias("total_records"), F.col("nulls").alias("failed_records"), status.alias("status"))

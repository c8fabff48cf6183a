"""A few rows of known values as a DataFrame of literals (no Python worker, no job to make them)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """Rows of a log entry or two; for more than some dozens use ``createDataFrame``."""
    structs = [
        F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True))) for row in rows
    ]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))

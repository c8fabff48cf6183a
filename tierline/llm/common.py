"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this library (once per Spark context).

    The library's source files go out as a zip through Spark's own file server,
    so executors need no installed copy and keep per-process caches (vocabularies,
    word memos) between tasks, which functions shipped by value would lose.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tierline_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tierline-ship-"), "tierline-src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._tierline_shipped = True


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts the lineage with replicated storage, so a lost executor costs a reread.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Most key rows (some 30 bytes each) that are broadcast; beyond it the join shuffles.
BROADCAST_KEYS = 2_000_000


def checked_broadcast(keys: DataFrame) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if its row count is under the bound."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """``schema`` with fields added, or replaced where a name is taken."""
    names = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + list(fields))


def slices(batch, rows: int = 256):
    """An Arrow batch in pieces, so few Python strings live at a time; freed Arrow memory goes back after it."""
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)
    pa.default_memory_pool().release_unused()

"""Declared streaming datasets: ``{name: builder}`` started together, each to completion.

A builder is ``(spark) -> streaming DataFrame``; the registry gives each one
its own bronze folder and checkpoint under a base folder, starts them all with
``availableNow`` and waits for all of them. Rows are counted by the writes
themselves, and the folders are read with ``read_bronze`` like any bronze table.
This is the plain-Spark form of a declarative bronze pipeline definition (no
pipeline server involved).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.sources.files import with_lineage
from tierline.streaming.bronze import BronzeTable, _rows_of_files

Builder = Callable[[SparkSession], DataFrame]


class DatasetRegistry:
    def __init__(self) -> None:
        self._builders: dict[str, Builder] = {}

    def table(self, name: str | None = None, lineage: bool = True):
        """Decorator registering a streaming dataset under ``name`` (default: function name)."""

        def register(fn: Builder) -> Builder:
            key = name or fn.__name__
            if key in self._builders:
                raise ValueError(f"dataset {key!r} is already declared")
            self._builders[key] = (lambda s, f=fn: with_lineage(f(s))) if lineage else fn
            return fn

        return register

    @property
    def names(self) -> list[str]:
        return list(self._builders)

    def run(self, spark: SparkSession, base: str) -> dict[str, int]:
        """Start every dataset (``availableNow``), wait for all; rows written per dataset."""
        rows, queries = {}, []
        for name, build in self._builders.items():
            rows[name] = 0
            queries.append(self._start(spark, name, build, base.rstrip("/"), rows))
        for q in queries:
            q.awaitTermination()
        return rows

    def _start(self, spark: SparkSession, name: str, build: Builder, base: str, rows: dict[str, int]):
        checkpoint = f"{base}/_checkpoints/{name}"
        bronze = BronzeTable(spark, f"{base}/{name}", checkpoint, rescue_column=None)

        def write(batch: DataFrame, batch_id: int) -> None:
            if bronze.is_replay(batch_id):
                return
            if "ingestion_time" not in batch.columns:
                batch = batch.withColumn("ingestion_time", F.current_timestamp())
            # with a file column, files that another checkpoint has brought are left out
            data, files = _rows_of_files(batch, bronze) if "file_path" in batch.columns else (batch, ())
            if data is not None:
                rows[name] += bronze.write(data, batch_id, files)

        return (
            build(spark)
            .writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def path(self, base: str, name: str) -> str:
        if name not in self._builders:
            raise KeyError(name)
        return f"{base.rstrip('/')}/{name}"

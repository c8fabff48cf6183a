"""Session helpers: building a session for tests and benchmarks, and the shared
folder used for checkpoints and scratch tables.

Library functions never create a session themselves; they take one. The shared
folder is read from the session (``spark.checkpoint.dir`` or the context's
checkpoint directory). Only a local-mode session without one gets a fresh
folder under the system temp directory; a cluster session without one is an
error, since machine-local folders are not visible to other executors.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "tierline",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the benchmark (the library itself never calls this)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Whole documents travel through Arrow in the enrichment operator:
        # bound a batch by rows so one batch of 20k-word texts stays small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where it is unset.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir`` from the
    configuration, then (local mode only) a new temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder"
        )
    folder = tempfile.mkdtemp(prefix="tierline-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for tables written by a job."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tierline-scratch/{name}-{uuid.uuid4().hex[:12]}"

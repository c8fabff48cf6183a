"""Physical-plan properties the scale design relies on (checked on the executed plan)."""

from __future__ import annotations

import os
import re

from pyspark.sql import functions as F

from tierline.operators import dedup, keys, quality
from tierline.plans import registry

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_before_the_shuffle(spark):
    p = plan(registry.all_queries()["latest_per_key"](spark, SF_DIR))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_incremental_bounds_reach_the_scan(spark):
    df = registry.all_queries()["incremental_rows"](spark, SF_DIR)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in p and "LessThanOrEqual(ts," in p
    read_schema = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    assert "props" not in read_schema and "value" not in read_schema  # columns pruned at the scan


def test_duplicate_split_uses_no_window(spark):
    df = spark.read.parquet(os.path.join(SF_DIR, "orders.parquet"))
    valid, rejected = quality.split_duplicate_keys(df.select("o_orderkey", "o_custkey"), ["o_custkey"])
    assert "Window" not in plan(valid) and "Window" not in plan(rejected)


def test_surrogate_keys_range_partition_the_data(spark):
    df = spark.read.parquet(os.path.join(SF_DIR, "customer.parquet")).select("c_custkey")
    out = keys.assign_keys(df, ["c_custkey"], "k", num_partitions=4)
    # The numbered data is read back from the checkpoint; only the per-partition
    # counts (one row per partition) meet in one place.
    p = plan(out)
    assert "Scan ExistingRDD" in p or "ExistingRDD" in p
    assert out.count() == df.count()


def test_anti_join_keeps_the_loaded_side_unshuffled_for_small_increments(spark):
    big = spark.range(0, 200000).select(F.col("id").alias("k"))
    small = spark.range(0, 10).select((F.col("id") * 1000).alias("k"))
    p = plan(dedup.anti_join_new(small, big, ["k"]))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_small_keys_are_hashed_not_sorted(spark):
    """Counting keys and picking the latest row need no aggregate over sorted rows."""
    queries = registry.all_queries()
    for name in ("dup_key_valid", "dup_key_rejected", "latest_mark", "run_log_latest", "audit_events"):
        assert "SortAggregate" not in plan(queries[name](spark, SF_DIR)), name
    assert "WindowGroupLimit" in plan(queries["latest_mark"](spark, SF_DIR))


def test_full_fact_load_has_no_prefilter(spark):
    assert "LeftSemi" not in plan(registry.all_queries()["fact_load"](spark, SF_DIR))

"""Configuration-driven jobs: batch ingest, cleaning rules, gold metrics.

Configs are dicts shaped like::

    bronze = {"source": {"path": ..., "format": "csv"},
              "options": {"header": True, "inferSchema": True}}
    silver = {"cleaning_rules": [{"column": "product_name", "action": "trim"}, ...]}
    gold = {"aggregation": {"group_by": [...]},
            "metrics": [{"column": "amount", "function": "sum", "alias": "total_sales"}]}

Unlike a config-as-documentation file, every key here is honoured: the source
``format`` picks the reader and ``metrics`` picks the aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.rules import DEFAULT_BAND_ELSE, DEFAULT_BANDS, RULE_ACTIONS, band, metric_column


def read_source(spark: SparkSession, config: Mapping) -> DataFrame:
    """Batch read of ``config['source']`` with ``config['options']``.

    For large inputs give a schema (``config['schema']``, DDL) instead of
    ``inferSchema``, which costs a full extra pass over the files.
    """
    src = config["source"]
    reader = spark.read.format(src.get("format", "csv"))
    opts = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in (config.get("options") or {}).items()}
    if config.get("schema"):
        reader = reader.schema(config["schema"])
        opts.pop("inferSchema", None)
    return reader.options(**opts).load(src["path"])


def apply_rules(df: DataFrame, rules) -> DataFrame:
    """Fold an ordered rule list over the frame, one projection per rule.

    Actions: ``trim``, ``upper``, ``lower``, ``cast_double`` (trim then try-cast)
    and ``band`` (``{"column", "action": "band", "target", "bands": [[bound,
    label], ...], "otherwise"}``). Catalyst collapses the projections into one.
    """
    for rule in rules:
        column, action = rule["column"], rule["action"]
        if action == "band":
            bands = [tuple(b) for b in rule.get("bands", DEFAULT_BANDS)]
            target = rule.get("target", f"{column}_category")
            df = df.withColumn(target, band(F.col(f"`{column}`"), bands, rule.get("otherwise", DEFAULT_BAND_ELSE)))
            continue
        if action not in RULE_ACTIONS:
            raise ValueError(f"unknown cleaning action {action!r}; allowed: {sorted([*RULE_ACTIONS, 'band'])}")
        df = df.withColumn(column, RULE_ACTIONS[action](F.col(f"`{column}`"), rule))
    return df


def aggregate_metrics(df: DataFrame, config: Mapping) -> DataFrame:
    """``groupBy(group_by).agg(metrics…)``: partial aggregation, one shuffle."""
    group_by = list((config.get("aggregation") or {}).get("group_by") or [])
    metrics = [metric_column(m) for m in config["metrics"]]
    return df.groupBy(*group_by).agg(*metrics) if group_by else df.agg(*metrics)

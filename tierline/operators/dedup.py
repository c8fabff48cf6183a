"""Deduplication: rows not yet loaded (null-safe anti-join) and latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_condition(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    cond: Column | None = None
    for k in keys:
        l, r = left[k], right[k]
        c = l.eqNullSafe(r) if null_safe else (l == r)
        cond = c if cond is None else cond & c
    return cond


def prefixed_keys(keys: Sequence[str], prefix: str = "_tl_k_") -> list[Column]:
    """The key columns under names that cannot clash, for the other side of a join."""
    return [F.col(f"`{k}`").alias(f"{prefix}{k}") for k in keys]


def same_keys(keys: Sequence[str], prefix: str = "_tl_k_") -> Column:
    """Null-safe equality of the keys with the prefixed keys of the other side."""
    cond: Column | None = None
    for k in keys:
        c = F.col(f"`{k}`").eqNullSafe(F.col(f"`{prefix}{k}`"))
        cond = c if cond is None else cond & c
    return cond


def anti_join_new(
    incoming: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    null_safe: bool = True,
    prefilter: bool = True,
) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``.

    Keys compare null-safe by default (``<=>``): with plain ``=`` a NULL key
    part (an open ``end_date``) never matches and the row is loaded again.

    ``existing`` is usually the whole loaded table and ``incoming`` one
    increment. With ``prefilter`` the loaded keys are first semi-joined with
    the increment's distinct keys; when the increment is small that join is a
    broadcast hash join (planner/AQE size check), so the large table is
    scanned but never shuffled, and the anti-join then runs against the few
    keys that matched. A large increment falls back to sort-merge joins, no
    worse than shuffling all loaded keys. A hot key on the incoming side is
    split by AQE's skew-join handling, which covers left-anti joins.
    """
    cols = [F.col(f"`{k}`") for k in keys]
    right = existing.select(*cols)
    if prefilter:
        inc_keys = incoming.select(*cols).distinct()
        right = right.join(inc_keys, key_condition(right, inc_keys, keys, null_safe), "left_semi")
    right = right.distinct()
    return incoming.join(right, key_condition(incoming, right, keys, null_safe), "left_anti")


def barred_keys(incoming: DataFrame, existing: DataFrame | None, keys: Sequence[str], prefilter: bool = True) -> DataFrame:
    """``(keys, _tl_n, _tl_loaded)`` of the incoming keys that come more than once or are in ``existing``.

    One hash aggregate over both sides' keys (null-safe): whole rows are neither shuffled
    nor sorted. With ``prefilter``, for a small increment, ``existing`` is first cut to its
    keys, so the large table is scanned but not shuffled.
    """
    cols = [F.col(f"`{k}`") for k in keys]
    came = incoming.select(*cols, F.lit(1).alias("_tl_in"), F.lit(False).alias("_tl_there"))
    if existing is not None:
        there = existing.select(*cols)
        if prefilter:
            there = there.join(incoming.select(*prefixed_keys(keys)).distinct(), same_keys(keys), "left_semi")
        came = came.unionByName(there.select(*cols, F.lit(0).alias("_tl_in"), F.lit(True).alias("_tl_there")))
    found = came.groupBy(*cols).agg(F.sum("_tl_in").alias("_tl_n"), F.bool_or("_tl_there").alias("_tl_loaded"))
    return found.filter((F.col("_tl_n") > 1) | ((F.col("_tl_n") > 0) & F.col("_tl_loaded")))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order`` (give a *total* order: add tie-breakers).

    ``row_number() … = 1`` is planned as a window group limit: each map
    partition keeps its own top row per key before the shuffle, so even a key
    with a third of all rows sends one row per partition across the network.
    """
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_tl_rn", F.row_number().over(w)).filter(F.col("_tl_rn") == 1).drop("_tl_rn")

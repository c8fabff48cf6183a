"""Type-2 slowly changing dimensions as a pure DataFrame function.

``scd2_apply`` takes the current state of a dimension (all versions, or None
for a first load) and an incoming batch, and returns the complete new state
plus the change set. It writes nothing; a writer decides how the state is
stored (see ``tierline.sources.tables.DimensionStore``).

Dimension columns: business keys, carried attributes, ``hash_value``, the
surrogate key, ``start_date``, ``end_date``, ``is_current``, ``created_at``,
``updated_at``. ``end_date`` is the version's validity end (NULL while
current).

Semantics:
- the batch is reduced to its latest row per business key under ``order``
  (a total order: pass tie-breakers);
- keys compare null-safe, so a NULL key is one business key like any other;
- a key with no current row is *new*; a key whose tracked-column hash differs
  from its current row is *changed*; anything else is left alone, including
  keys absent from the batch (deletes are not propagated);
- a changed key's current row is expired (``end_date = as_of`` date,
  ``is_current = false``, ``updated_at = as_of``) and a new version is added;
- new versions get surrogate keys continuing after the largest existing key,
  in business-key order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.casting import ntz_literal
from tierline.functions.hashing import row_hash
from tierline.operators.dedup import latest_per_key, prefixed_keys, same_keys
from tierline.operators.keys import assign_keys, max_key

SCD_COLUMNS = ("hash_value", "start_date", "end_date", "is_current", "created_at", "updated_at")


@dataclass
class Scd2Result:
    state: DataFrame  # every version after the load
    changes: DataFrame  # business keys + change_type ('new' | 'changed') + new surrogate key
    current: DataFrame  # the current rows after the load (one per key)
    expired: DataFrame | None  # rows this load expired (None on a first load)


def _ts(value) -> Column:
    """``as_of`` as a zone-free timestamp (None: the session's local time now)."""
    return F.localtimestamp() if value is None else ntz_literal(value)


def dimension_columns(keys: Sequence[str], attrs: Sequence[str], key_col: str) -> list[str]:
    return [*keys, *attrs, "hash_value", key_col, "start_date", "end_date", "is_current", "created_at", "updated_at"]


def scd2_changes(
    current: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    tracked: Sequence[str],
    order: Sequence[Column],
    key_col: str,
    double_scale: int = 6,
    start_key: int = 0,
    staging: str | None = None,
) -> DataFrame:
    """New and changed keys of a batch: their row, ``hash_value``, ``change_type`` and new surrogate key (materialised).

    ``current`` holds the dimension's current rows, at least those whose key may be in the batch.
    ``staging``: folder for the change set (see :func:`assign_keys`), the caller's to remove.
    """
    latest = latest_per_key(incoming, keys, order).select(*keys, *attrs)
    staged = latest.withColumn("hash_value", row_hash(latest, tracked, double_scale))
    if current is None:
        changes = staged.withColumn("change_type", F.lit("new"))
    else:
        # Only current rows whose key is in the batch matter; the semi-join against the
        # batch's keys is a broadcast when the batch is small, so the dimension is not shuffled.
        cur = (
            current.filter(F.col("is_current"))
            .select(*prefixed_keys(keys), F.col("hash_value").alias("_tl_cur_hash"))
            .join(staged.select(*keys), same_keys(keys), "left_semi")
        )
        joined = staged.join(cur, same_keys(keys), "left")
        changes = joined.filter(
            F.col("_tl_cur_hash").isNull() | (F.col("hash_value") != F.col("_tl_cur_hash"))
        ).select(
            *staged.columns,
            F.when(F.col("_tl_cur_hash").isNull(), F.lit("new")).otherwise(F.lit("changed")).alias("change_type"),
        )
    return assign_keys(changes, list(keys), key_col, start=start_key, staging=staging)


def scd2_rows(
    current: DataFrame | None, changes: DataFrame, keys: Sequence[str], attrs: Sequence[str], as_of, key_col: str
) -> DataFrame:
    """``current`` rows after the changes, in one pass: unchanged ones, new versions, and (``is_current`` false) expired ones."""
    as_of_ts = _ts(as_of)
    as_of_date = F.to_date(as_of_ts)
    out_cols = dimension_columns(keys, attrs, key_col)
    new_versions = changes.select(
        *keys,
        *attrs,
        "hash_value",
        key_col,
        as_of_date.alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
        as_of_ts.alias("created_at"),
        as_of_ts.alias("updated_at"),
    ).select(*out_cols)
    if current is None:
        return new_versions
    changed_keys = changes.filter(F.col("change_type") == "changed").select(
        *prefixed_keys(keys), F.lit(True).alias("_tl_changed")
    )
    cur_rows = current.filter(F.col("is_current")).join(changed_keys, same_keys(keys), "left")
    expired = F.col("_tl_changed").isNotNull()
    kept = cur_rows.select(
        *[F.col(c) for c in out_cols if c not in ("end_date", "is_current", "updated_at")],
        F.when(expired, as_of_date).otherwise(F.col("end_date")).alias("end_date"),
        F.when(expired, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
        F.when(expired, as_of_ts).otherwise(F.col("updated_at")).alias("updated_at"),
    ).select(*out_cols)
    return kept.unionByName(new_versions)


def scd2_apply(
    current: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    tracked: Sequence[str],
    order: Sequence[Column],
    as_of,  # None = now
    key_col: str,
    double_scale: int = 6,
    start_key: int | None = None,
) -> Scd2Result:
    if current is None:
        start = 0
    else:
        # The largest key handed out so far: given by the caller (a store keeps it with
        # each commit), else one scan of the key column.
        start = max_key(current, key_col) if start_key is None else start_key
    keyed = scd2_changes(current, incoming, keys, attrs, tracked, order, key_col, double_scale, start)
    change_set = keyed.select(*keys, "change_type", key_col)
    rows = scd2_rows(current, keyed, keys, attrs, as_of, key_col)
    if current is None:
        return Scd2Result(rows, change_set, rows, None)
    history = current.filter(~F.col("is_current")).select(*rows.columns)
    return Scd2Result(
        history.unionByName(rows), change_set, rows.filter(F.col("is_current")), rows.filter(~F.col("is_current"))
    )

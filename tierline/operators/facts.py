"""Fact loads: attach the dimension's surrogate key to incoming rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.casting import ntz_literal
from tierline.operators.dedup import prefixed_keys, same_keys


def fact_rows(
    incoming: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    key_col: str,
    columns: Sequence[str],
    created_at=None,
    point_in_time_col: str | None = None,
    prefilter: bool = True,
) -> DataFrame:
    """``key_col`` + ``columns`` (+ ``created_at``) for every incoming row.

    Default: the *current* dimension row's key (left join; a missing dimension
    row leaves the key NULL and keeps the fact row). With
    ``point_in_time_col`` the version valid at that time is used instead
    (``start_date <= t < end_date``), an equi-join on the business key with a
    range residual.

    The join is a plain equi-join: AQE turns it into a broadcast only when the
    dimension side is measured small at run time, and splits skewed fact keys.
    With ``prefilter`` the dimension is first cut to the keys present in the
    increment (a semi-join that broadcasts the increment's distinct keys when
    they are few), so a small increment never shuffles a large dimension; pass
    ``False`` for a full load, where it only adds work. Keys compare null-safe.
    Current keys must be unique (see ``quality.unique_current_keys``), otherwise
    fact rows multiply.
    """
    dim = dimension if point_in_time_col is not None else dimension.filter(F.col("is_current"))
    validity = ["start_date", "end_date"] if point_in_time_col is not None else []
    dim = dim.select(*prefixed_keys(keys), key_col, *[F.col(c).alias(f"_tl_{c}") for c in validity])
    if prefilter:
        dim = dim.join(incoming.select(*keys).distinct(), same_keys(keys), "left_semi")
    cond = same_keys(keys)
    if point_in_time_col is not None:
        t = F.to_date(F.col(point_in_time_col))
        cond = cond & (F.col("_tl_start_date") <= t) & (F.col("_tl_end_date").isNull() | (t < F.col("_tl_end_date")))
    joined = incoming.join(dim, cond, "left")
    out = joined.select(F.col(key_col), *[F.col(c) for c in columns])
    when = F.localtimestamp() if created_at is None else ntz_literal(created_at)
    return out.withColumn("created_at", when)

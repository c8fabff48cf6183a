"""Key buckets: where rows of a business key can be, so that a look-up reads only there.

A key's bucket is its hash modulo a power of two, at most ``FINEST``. Since a coarser
bucket follows from a finer one, every load can have as many buckets as its size
calls for, and one list of finest buckets says for each load which of its folders
can hold a wanted key. NULL key parts are hashed like any value that is not there,
so equal keys (null-safe) are always in one bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most buckets of a load.
FINEST = 1024
ROWS_PER_BUCKET = 1_000_000
#: Partition columns of a bucketed load.
LAYOUT = ("key_buckets", "key_bucket")


def bucket_of(keys: Sequence[str], buckets: int | Column = FINEST) -> Column:
    hashed = F.xxhash64(*(F.col(f"`{k}`").cast("string") for k in keys))
    return F.pmod(hashed, F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """The least power of two that keeps a load's buckets at about ``rows_per_bucket`` rows."""
    wanted = max(1, -(-rows // rows_per_bucket))
    return min(FINEST, 1 << (wanted - 1).bit_length())


def touched(df: DataFrame, keys: Sequence[str], buckets: int = FINEST) -> tuple[int, list[int]]:
    """(rows, buckets that hold them), from one aggregate; at most ``buckets`` numbers reach the driver."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.collect_set(bucket_of(keys, buckets)).alias("b")).first()
    return int(row["n"]), sorted(row["b"])


def with_layout(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows with their ``LAYOUT`` columns, a bucket's rows together in as many tasks as their size needs."""
    many, one = LAYOUT
    rows = df.withColumn(many, F.lit(buckets)).withColumn(one, bucket_of(keys, buckets))
    return rows.hint("rebalance", one) if buckets > 1 else rows


def can_hold(layouts: Iterable[int], wanted: Iterable[int]) -> Column | None:
    """Filter on the ``LAYOUT`` columns: folders that can hold keys of the ``wanted`` finest buckets; ``None``: all can."""
    wanted = set(wanted)
    many, one = (F.col(c) for c in LAYOUT)
    parts, all_of_them = [], True
    for buckets in sorted(set(layouts)):
        some = sorted({w % buckets for w in wanted})
        all_of_them &= len(some) == buckets
        if some:
            parts.append((many == buckets) if len(some) == buckets else (many == buckets) & one.isin(some))
    if all_of_them:
        return None
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)

"""Dense, ordered surrogate keys without funnelling rows into one partition.

``row_number() OVER (ORDER BY …)`` with no partition moves every row to a
single task. Here the rows are range-partitioned on the order columns and
sorted inside each partition; each row gets its position inside its partition;
the per-partition counts (one row per partition, so their size is bounded by
the partition count, not the data) are turned into prefix offsets and
broadcast back. The partitioned frame is checkpointed to the shared folder, or
written as a table that the caller removes, first, because the count pass and the
numbering pass must see the same partitioning (range bounds come from sampling and
would differ on recompute).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.session import ensure_checkpoint_dir

# monotonically_increasing_id puts the partition index in the upper 31 bits
# and the row position in the lower 33 bits.
_POSITION_BITS = 33


def assign_keys(
    df: DataFrame,
    order_cols: Sequence[str],
    key_col: str,
    start: int = 0,
    num_partitions: int | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Add ``key_col`` = ``start + 1, start + 2, …`` in ``order_cols`` order.

    Keys are dense and unique; ``order_cols`` should be a total order (ties get
    distinct keys in an unspecified order). ``start`` is usually the current
    maximum key of the target, so keys continue across loads.

    ``staging``: a new folder in shared storage. The numbered rows are then a Parquet table
    there instead of a checkpoint: later reads of the result open the columns they need only,
    and the caller removes the folder once the result is no longer used.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = [F.col(f"`{c}`") for c in order_cols]
    # Without a fixed count AQE sizes the range partitions (coalescing keeps them
    # contiguous ranges, so the global order holds across partitions).
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    positioned = (
        ranged.sortWithinPartitions(*order)
        .withColumn("_tl_pid", F.spark_partition_id())
        .withColumn("_tl_mid", F.monotonically_increasing_id())
    )
    if staging is None:
        positioned = positioned.checkpoint(eager=True)
    else:
        positioned.write.parquet(staging)
        positioned = spark.read.schema(positioned.schema).parquet(staging)
    counts = positioned.groupBy("_tl_pid").agg(F.count(F.lit(1)).alias("_tl_n"))
    before = Window.orderBy("_tl_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_tl_pid", F.coalesce(F.sum("_tl_n").over(before), F.lit(0)).alias("_tl_off")
    )
    position = F.col("_tl_mid") - F.shiftleft(F.col("_tl_pid").cast("long"), _POSITION_BITS)
    return (
        positioned.join(F.broadcast(offsets), "_tl_pid")
        .withColumn(key_col, F.lit(start).cast("long") + F.col("_tl_off") + position + F.lit(1))
        .drop("_tl_pid", "_tl_mid", "_tl_off")
    )


def max_key(df: DataFrame, key_col: str) -> int:
    """Current maximum key (0 for an empty or missing target): one scalar fetch."""
    row = df.agg(F.max(key_col).alias("m")).first()
    return int(row["m"]) if row is not None and row["m"] is not None else 0

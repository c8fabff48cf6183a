"""Consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``VIRTUAL_NODES`` points of a 64-bit ring; a key starts at its
hash and belongs to the first point clockwise. Shards have capacities that add up
to the number of keys and differ by at most one; a key that finds its shard full
continues clockwise to the next point whose shard has room. Balance is therefore
exact (row counts at most one apart), and only overflow moves further.

Keys are taken in ring order, so the outcome of a whole arc between two points
follows from its key count. Spark counts keys per arc (at most shards x
``VIRTUAL_NODES`` rows, whatever the input), the walk over arcs gives pieces
"keys i to j of the ring order go to shard s", and every row finds its piece by
its place in the ring order. That place comes from one range-partitioned sort of
narrow rows plus one count per partition, so neither a hot key nor the whole order
meets in one task.

The ring position is a hash of the key columns; ties (equal keys) are ordered by
``order`` columns, so equal keys stay together until a shard is full.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import ship_package, staged, text_or_empty

VIRTUAL_NODES = 128
#: Law of the placement, as a name for the result.
LAW = "rows"


def ring_points(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(position, shard) in ring order; positions are signed 64-bit."""
    points = [
        (xxhash.xxh64_intdigest(f"{shard}/{node}", 0) - (1 << 63), shard)
        for shard in range(shards)
        for node in range(virtual_nodes)
    ]
    return sorted(points)


def bounded_pieces(arc_counts: list[int], points: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """(first place, shard, first slot) of the pieces of the ring order, ascending.

    ``arc_counts[i]`` keys lie at or before point i and after the point before it
    (the last entry: keys after the last point, which wrap to the first).
    """
    total = sum(arc_counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    owners = [shard for _, shard in points]
    pieces: list[tuple[int, int, int]] = []
    place = 0
    for arc, count in enumerate(arc_counts):
        at = arc
        while count:
            shard = owners[at % len(owners)]
            take = min(count, room[shard] - used[shard])
            if take:
                pieces.append((place, shard, used[shard]))
                used[shard] += take
                place += take
                count -= take
            else:
                at += 1
    return pieces


def place_on_ring(
    df: DataFrame, key_hash: Column, order: list[str], shards: int, virtual_nodes: int = VIRTUAL_NODES
) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    ``df`` should be narrow: its rows are written once in ring order and read
    twice. Defined results: nulls in ``order`` columns come first; rows equal in
    all of them take neighbouring slots; an empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = df.sparkSession
    ship_package(spark)
    points = ring_points(shards, virtual_nodes)
    ordered = [F.col("__at"), *(F.col(c).asc_nulls_first() for c in order)]
    rows = staged(
        df.withColumn("__at", key_hash)
        .repartitionByRange(*ordered)
        .sortWithinPartitions(*ordered)
        .withColumn("__id", F.monotonically_increasing_id()),
        "ring-order",
    )
    part = F.shiftrightunsigned("__id", 33).cast("int")
    positions = spark.sparkContext.broadcast(np.array([p for p, _ in points]))

    @F.pandas_udf(T.IntegerType())
    def arc_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(positions.value, at.to_numpy()).astype(np.int32))

    # bounded by partitions plus arcs, as both are cut from one order
    counts = rows.groupBy(part.alias("part"), arc_of("__at").alias("arc")).agg(F.count("*").alias("n")).collect()
    arc_counts = [0] * (len(points) + 1)
    part_counts: dict[int, int] = {}
    for row in counts:
        arc_counts[row["arc"]] += row["n"]
        part_counts[row["part"]] = part_counts.get(row["part"], 0) + row["n"]
    before, total = {}, 0
    for number in sorted(part_counts):
        before[number] = total
        total += part_counts[number]
    pieces = bounded_pieces(arc_counts, points, shards)
    table = spark.sparkContext.broadcast((before, *(np.array([p[i] for p in pieces], dtype=np.int64) for i in range(3))))
    schema = T.StructType(
        [f for f in df.schema.fields if f.name not in ("shard", "slot")]
        + [T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]
    )
    kept = schema.names[:-2]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, first, shard, slot = table.value
        for batch in batches:
            ids = batch.column(len(kept)).to_numpy()
            at = (ids & ((1 << 33) - 1)) + np.array([before[p] for p in (ids >> 33).tolist()], dtype=np.int64)
            piece = np.searchsorted(first, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(shard[piece].astype(np.int32), pa.int32()), pa.array(slot[piece] + at - first[piece], pa.int64())],
                names=schema.names,
            )

    return rows.select(*kept, "__id").mapInArrow(place, schema)


def shard_texts(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot): documents by text, so that equal texts share a ring position.

    ``size`` is the text's UTF-8 bytes plus 8; a null text counts as empty.
    """
    narrow = df.select(
        key,
        (F.octet_length(text_or_empty(text)) + 8).cast("long").alias("size"),
        F.crc32(text_or_empty(text)).alias("text_crc32"),
        F.xxhash64(text_or_empty(text)).alias("__hash"),
    )
    placed = place_on_ring(narrow, F.col("__hash"), [key, "size", "text_crc32"], shards)
    return placed.drop("__hash")


def walk(positions: list[int], points: list[tuple[int, int]], shards: int) -> list[tuple[int, int]]:
    """(shard, slot) of keys at ``positions`` (ascending), placed one by one: the definition, for tests."""
    total = len(positions)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, out = [0] * shards, []
    starts = [p for p, _ in points]
    for position in positions:
        at = bisect_left(starts, position)
        while used[shard := points[at % len(points)][1]] >= room[shard]:
            at += 1
        out.append((shard, used[shard]))
        used[shard] += 1
    return out

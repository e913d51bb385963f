"""Sharding over fixed virtual slots.

A record's hash names one of ``SLOTS`` slots for ever. Bytes and rows are added up per slot, and a
versioned map says which shard owns a slot. Rebalancing edits the map: it moves slots from full shards
to empty ones and writes the next version; no record is hashed again.

The driver holds one line per slot (``SLOTS`` is a constant), whatever the size of the data.

Defined results: a NULL text has 8 bytes and CRC 0; a NULL id is placed by its text's hash; repeated rows
each take a place of their own; an empty table gives an empty result; columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commutewell.llm.common import stored

SLOTS = 8192
SHARDS = 24
OVERHEAD = 8  # bytes that a record takes besides its text


def with_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of every record."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), text)), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_loads(records: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot; at most ``slots`` lines reach the driver."""
    sizes, rows = [0] * slots, [0] * slots
    for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect():
        sizes[r.virtual_slot], rows[r.virtual_slot] = r.bytes, r.n
    return sizes, rows


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0: equal runs of slots."""
    return [s * shards // slots for s in range(slots)]


def rebalanced(owner: list[int], sizes: list[int], shards: int) -> list[int]:
    """``owner`` edited until moving a slot from the fullest to the emptiest shard no longer helps.

    Each move takes the largest slot that is at most half the gap, or else one smaller than the gap, so the
    sum of squared loads falls every time and the loop ends. Slots without bytes stay where they are.
    """
    owner = list(owner)
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(owner):
        if sizes[slot]:
            held[shard].append((sizes[slot], slot))
    load = [sum(size for size, _ in h) for h in held]
    for h in held:
        h.sort()
    fullest = [(-n, s) for s, n in enumerate(load)]
    emptiest = [(n, s) for s, n in enumerate(load)]
    heapq.heapify(fullest)
    heapq.heapify(emptiest)
    while True:
        while -fullest[0][0] != load[fullest[0][1]]:
            heapq.heappop(fullest)
        while emptiest[0][0] != load[emptiest[0][1]]:
            heapq.heappop(emptiest)
        high, low = fullest[0][1], emptiest[0][1]
        gap = load[high] - load[low]
        at = max(bisect_right(held[high], (gap // 2, len(owner))) - 1, 0)
        if not held[high] or held[high][at][0] >= gap:
            return owner
        size, slot = held[high].pop(at)
        insort(held[low], (size, slot))
        owner[slot] = low
        for shard, by in ((high, -size), (low, size)):
            load[shard] += by
            heapq.heappush(fullest, (-load[shard], shard))
            heapq.heappush(emptiest, (load[shard], shard))


def write_map(spark: SparkSession, path: str, version: int, owner: list[int], rows: list[int]) -> None:
    """Add one version of the map: slot, its shard, and how many rows of that shard lie in lower slots."""
    before: dict[int, int] = {}
    lines = []
    for slot, shard in enumerate(owner):
        lines.append((slot, shard, before.get(shard, 0)))
        before[shard] = before.get(shard, 0) + rows[slot]
    frame = spark.createDataFrame(lines, "virtual_slot int, shard int, rows_before long")
    frame.coalesce(1).write.parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int, rows_before long").parquet(f"{path}/version={version}")


def placed(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Every record with its shard and its place there, gapless from 0.

    Places are counted within a virtual slot and shifted by the rows of the shard's lower slots, so no task
    holds a shard. The map has one line per slot, a constant, and is broadcast.
    """
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        records.join(F.broadcast(slot_map), "virtual_slot")
        .withColumn("slot", F.row_number().over(within) - 1 + F.col("rows_before"))
        .drop("rows_before")
    )


def shard(docs: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Records placed by the rebalanced map; both versions of the map are kept below ``path``."""
    spark = docs.sparkSession
    records = stored(with_slots(docs, slots), "slots")
    sizes, rows = slot_loads(records, slots)
    owner = first_map(shards, slots)
    write_map(spark, path, 0, owner, rows)
    write_map(spark, path, 1, rebalanced(owner, sizes, shards), rows)
    return placed(records, read_map(spark, path, 1)).withColumn("map_version", F.lit(1))

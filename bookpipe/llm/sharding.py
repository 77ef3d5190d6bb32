"""Shards of nearly equal size through fixed virtual slots.

Records are hashed into thousands of slots, bytes are added up per slot, and a
versioned map gives each slot its shard. The map is small and of fixed size whatever
the corpus; placing a record needs its hash and the map alone. When sizes drift or a
shard is added, ``rebalance`` edits the map: it moves as few slots as bring the
shards near each other again, and stores a new version beside the old ones.

Equal texts share a slot, so that copies stay together. A group of copies with more
than a quarter of a shard's bytes would outweigh any map: its rows are hashed
one by one. At most ``4 * shards`` groups can be that large.

Rows have a gapless place in their shard, in order of slot, then doc_id: the rows of
earlier slots of the shard (from the map's row counts) plus the place in the slot, so
no sort holds more than a slot's rows.

Cases: a null text weighs 1 byte, like an empty one, and counts as its copy. Rows
without doc_id are placed as well, first in their slot. Repeated rows get places of
their own. Of an empty table there are no rows, and slots are dealt in turn.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookpipe.llm.common import shared_path, text_or_empty

SLOTS = 4_096
SHARDS = 8
MAP_SCHEMA = "version int, slot int, shard int"


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and a hash of the text."""
    text = text_or_empty()
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
    )


def wide_groups(rows: DataFrame, shards: int) -> list[int]:
    """Hashes of texts whose copies weigh over a quarter of a shard: at most 4 * shards."""
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_n"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    most = groups.where(F.col("_n") > 1).orderBy(F.desc("_bytes"), "text_key").limit(4 * shards).collect()
    return [g["text_key"] for g in most if g["_bytes"] * 4 * shards > total]


def slot_of(wide: list[int], slots: int) -> Column:
    by_text = F.pmod("text_key", F.lit(slots))
    by_row = F.pmod(F.xxhash64("text_key", "doc_id"), F.lit(slots))
    return (F.when(F.col("text_key").isin(wide), by_row).otherwise(by_text) if wide else by_text).cast("int")


def deal(weights: dict[int, int], slots: int, shards: int) -> list[int]:
    """Shard of each slot: heaviest slot first, to the lightest shard."""
    loads, shard_of = [(0, s) for s in range(shards)], [0] * slots
    for place, slot in enumerate(sorted(range(slots), key=lambda k: (-weights.get(k, 0), k))):
        load, shard = heapq.heappop(loads)
        shard_of[slot] = shard
        heapq.heappush(loads, (load + weights.get(slot, 0), shard))
    return shard_of


def rebalance(shard_of: list[int], weights: dict[int, int], shards: int, tolerance: float = 0.01) -> list[int]:
    """An edited copy of the map: slots move from the heaviest shard to the lightest.

    Each move takes the largest slot that still narrows the gap, until all shards are
    within ``tolerance`` of each other or no move helps.
    """
    edited, held = list(shard_of), [[] for _ in range(shards)]
    loads = [0] * shards
    for slot, shard in enumerate(edited):
        held[shard].append(slot)
        loads[shard] += weights.get(slot, 0)
    mean = sum(loads) / shards
    while True:
        high, low = max(range(shards), key=loads.__getitem__), min(range(shards), key=loads.__getitem__)
        gap = loads[high] - loads[low]
        movable = [s for s in held[high] if 0 < weights.get(s, 0) < gap]
        if gap <= tolerance * mean or not movable:
            return edited
        slot = min(movable, key=lambda s: (abs(gap / 2 - weights[s]), s))
        held[high].remove(slot)
        held[low].append(slot)
        loads[high] -= weights[slot]
        loads[low] += weights[slot]
        edited[slot] = low


def store_map(spark: SparkSession, path: str, version: int, shard_of: list[int]) -> None:
    rows = [(version, slot, shard) for slot, shard in enumerate(shard_of)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[int]]:
    """The version asked for, or the newest, and the shard of each slot."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    version = stored.agg(F.max("version")).first()[0] if version is None else version
    return version, [r["shard"] for r in stored.where(F.col("version") == version).orderBy("slot").collect()]


def slot_weights(slotted: DataFrame) -> list:
    """Bytes and rows of each slot: at most as many rows as slots."""
    return slotted.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()


def place(docs: DataFrame, map_path: str, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version.

    The first call on ``map_path`` makes version 0 of the map; later ones place by the newest.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "records")
    records(docs).write.parquet(path)
    rows = spark.read.parquet(path)
    slotted = rows.withColumn("virtual_slot", slot_of(wide_groups(rows, shards), slots))
    found = {r["virtual_slot"]: (r["bytes"], r["n"]) for r in slot_weights(slotted)}
    if not _exists(spark, map_path):
        store_map(spark, map_path, 0, deal({k: v[0] for k, v in found.items()}, slots, shards))
    version, shard_of = read_map(spark, map_path)
    before, small = [0] * (max(shard_of) + 1), []
    for slot, shard in enumerate(shard_of):
        small.append((slot, shard, before[shard]))
        before[shard] += found.get(slot, (0, 0))[1]
    known = spark.createDataFrame(small, "virtual_slot int, shard int, _before bigint")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "text_key")
    # The map has one row per slot: a fixed number.
    out = slotted.withColumn("_place", F.row_number().over(within)).join(F.broadcast(known), "virtual_slot")
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_before") + F.col("_place") - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.lit(version).alias("map_version"),
    )


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

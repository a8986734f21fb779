"""Sharding by fixed virtual slots and a stored, versioned slot-to-shard map.

Records are hashed into a few thousand slots, bytes are summed per slot, and
each slot is owned by one shard.  Moving a slot is an edit of the map: a new
version is written beside the old one.  Everything that touches records is
DataFrame code; only the map, one row per slot, is planned in the driver.

Defined results: a null text has no bytes and the CRC of no bytes; rows with
equal or null ids are spread by their text's CRC as well; an empty table gives
an empty result and a map with empty shards; other columns are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import numbered, store

SLOTS = 4096
SHARDS = 8
SALTS = 16


def record_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``virtual_slot`` and a ``salt`` per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("salt"),
    )
    return narrow.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes per slot: at most ``slots`` rows reach the driver."""
    sums = dict(records.groupBy("virtual_slot").agg(F.sum("size")).collect())
    return [sums.get(slot, 0) for slot in range(slots)]


def plan_map(weights: list[int], shards: int) -> list[int]:
    """The shard of every slot: heaviest slot first, to the lightest shard so far."""
    loads = [(0, shard) for shard in range(shards)]
    owner = [0] * len(weights)
    for slot in sorted(range(len(weights)), key=lambda s: (-weights[s], s)):
        load, shard = heapq.heappop(loads)
        owner[slot] = shard
        heapq.heappush(loads, (load + weights[slot], shard))
    return owner


def rebalance_map(owner: list[int], weights: list[int], shards: int) -> list[int]:
    """``owner`` edited for ``shards`` shards: slots leave overfull shards only, and only for the lightest one.

    A slot moves only if its new shard stays within the fair share, so most stay where they are.
    """
    owner = list(owner)
    loads = [0] * shards
    held: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(owner):
        loads[shard] += weights[slot]
        held[shard].append(slot)
    for slots in held:
        slots.sort(key=lambda s: (weights[s], s))
    fair = sum(weights) / shards
    for donor in sorted(range(shards), key=lambda s: -loads[s]):
        while held[donor] and loads[donor] > fair:
            slot = held[donor].pop()
            target = min(range(shards), key=lambda s: (loads[s], s))
            if loads[target] + weights[slot] > fair:
                continue
            loads[donor] -= weights[slot]
            loads[target] += weights[slot]
            owner[slot] = target
    return owner


def map_frame(spark: SparkSession, owner: list[int], version: int) -> DataFrame:
    """The map as rows ``virtual_slot``, ``shard``, ``version``."""
    listed = F.split(F.lit(",".join(map(str, owner))), ",")
    return spark.range(1).select(F.posexplode(listed).alias("virtual_slot", "shard")).select(
        "virtual_slot", F.col("shard").cast("int").alias("shard"), F.lit(version).alias("version")
    )


def save_map(spark: SparkSession, owner: list[int], path: str, version: int) -> None:
    """Write a version beside the earlier ones; an existing one is never overwritten."""
    map_frame(spark, owner, version).drop("version").coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def assign(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``records`` with the ``shard`` of their slot; the map has one row per slot, a fixed number."""
    return records.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot")


def shard_by_bytes(docs: DataFrame, map_path: str, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Documents in shards of near equal bytes, numbered from 0 within each; the map is version 1 at ``map_path``."""
    spark = docs.sparkSession
    records = store(record_slots(docs, slots), "shard-records")
    save_map(spark, plan_map(slot_bytes(records, slots), shards), map_path, 1)
    owned = assign(records, load_map(spark, map_path, 1))
    placed = owned.withColumn("salt", F.col("virtual_slot") * SALTS + F.col("salt"))
    return numbered(placed, "shard", "salt", "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot", "virtual_slot"
    )

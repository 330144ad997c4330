"""Sharding by fixed virtual slots.

Each record is hashed into one of a few thousand slots; bytes are summed by slot; a small versioned map says which shard
owns each slot. Rebalancing edits that map and never rehashes a record. Only the records of a slot that holds far more than
its share, as when very many rows have one id and text, are dealt to slots by row, so that no slot outweighs a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, stored

SLOTS, SHARDS = 4096, 8
#: A slot with so many times the mean bytes or rows of a slot is dealt out by row.
HEAVY = 8


@dataclass(frozen=True)
class SlotMap:
    """owner[slot] is the shard of that slot. Each edit gives a new version; save() adds it to a table and load() reads any."""

    version: int
    shards: int
    owner: tuple[int, ...]

    @staticmethod
    def even(slots: int, shards: int) -> SlotMap:
        return SlotMap(0, shards, tuple(i % shards for i in range(slots)))

    def rebalanced(self, weight: np.ndarray) -> SlotMap:
        """Moves one slot, or exchanges two, between the heaviest and the lightest shard for as long as they come closer.

        Every edit lessens the sum of the squares of the loads, so this ends; then no slot of the heaviest shard is lighter
        than the distance between the two.
        """
        weight, owner = np.asarray(weight, np.int64), np.array(self.owner)
        load = np.bincount(owner, weight, self.shards).astype(np.int64)
        while True:
            high, low = int(load.argmax()), int(load.argmin())
            gap = int(load[high] - load[low])
            if gap <= 1:
                break
            mine, theirs = np.flatnonzero(owner == high), np.flatnonzero(owner == low)
            theirs = np.append(theirs[np.argsort(weight[theirs], kind="stable")], -1)
            other = np.append(weight[theirs[:-1]], 0)  # the last: nothing comes back
            order = np.argsort(other, kind="stable")
            near = np.searchsorted(other[order], weight[mine] - gap / 2)
            best = (gap, -1, -1)
            for shift in (-1, 0):
                at = order[np.clip(near + shift, 0, len(order) - 1)]
                moved = weight[mine] - other[at]
                left = np.where(moved > 0, np.abs(gap - 2 * moved), gap)
                if len(left) and left.min() < best[0]:
                    i = int(left.argmin())
                    best = (int(left[i]), int(mine[i]), int(theirs[at[i]]))
            if best[1] < 0:
                break
            _, a, b = best
            moved = int(weight[a] - (weight[b] if b >= 0 else 0))
            owner[a] = low
            if b >= 0:
                owner[b] = high
            load[high] -= moved
            load[low] += moved
        return SlotMap(self.version + 1, self.shards, tuple(owner.tolist()))

    def grown(self, weight: np.ndarray) -> SlotMap:
        """One more shard; slots move only into it, the heaviest shards giving first."""
        weight, owner = np.asarray(weight, np.int64), np.array(self.owner)
        load = np.bincount(owner, weight, self.shards).astype(np.int64)
        goal, new = int(weight.sum()) // (self.shards + 1), 0
        for slot in np.argsort(-weight, kind="stable"):
            give = owner[slot]
            if new + weight[slot] <= goal and load[give] - weight[slot] >= goal:
                owner[slot], new = self.shards, new + weight[slot]
                load[give] -= weight[slot]
        return SlotMap(self.version + 1, self.shards + 1, tuple(owner.tolist()))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(self.version, self.shards, i, s) for i, s in enumerate(self.owner)]
        spark.createDataFrame(rows, "version int, shards int, slot int, shard int").coalesce(1).write.mode("append").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """That version, or the newest."""
        table = spark.read.parquet(path)
        version = table.agg(F.max("version")).first()[0] if version is None else version
        rows = table.where(F.col("version") == version).orderBy("slot").collect()
        return SlotMap(version, rows[0]["shards"], tuple(r["shard"] for r in rows))


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1; a null text has none), text_crc32, row, virtual_slot, by the hash of id and text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"))
    return out.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_weights(records: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows of each slot, on the driver: as many numbers as there are slots, whatever the input."""
    size, rows = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for slot, b, n in records.groupBy("virtual_slot").agg(F.sum("size"), F.count("*")).collect():
        size[slot], rows[slot] = b, n
    return size, rows


def dealt(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """records, those of slots that hold HEAVY times the mean bytes or rows in slots by row."""
    size, rows = slot_weights(records, slots)
    heavy = np.flatnonzero(((size > HEAVY * size.mean()) | (rows > HEAVY * rows.mean())) & (rows > 1)).tolist()  # at most 2 * slots / HEAVY
    by_row = F.pmod(F.xxhash64("doc_id", "text_crc32", "row"), F.lit(slots)).cast("int")
    return records.withColumn("virtual_slot", F.when(F.col("virtual_slot").isin(heavy), by_row).otherwise(F.col("virtual_slot"))) if heavy else records


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, slot_map: SlotMap | None = None, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard, slot (the row's place in its shard, gapless from 0), map_version.

    slot_map: the map to edit, else an even one; the edited one is stored at map_path if that is given. Law: bytes of the
    shards near equal, as far as single records allow. Rows of one id and text share a virtual slot, unless these are so many
    that they are dealt out; ties in a slot are ordered by checksum and size, and rows that agree in all of that are
    interchangeable. Null ids are ids like any other, null texts empty. An empty table gives no rows.
    """
    spark = docs.sparkSession
    records = dealt(stored(slotted(docs, slots), "slots"), slots)
    size, rows = slot_weights(records, slots)
    edited = (slot_map or SlotMap.even(slots, shards)).rebalanced(size)
    if map_path:
        edited.save(spark, map_path)
    owner, first = np.array(edited.owner), np.zeros(slots, np.int64)
    for s in range(edited.shards):
        own = np.flatnonzero(owner == s)
        first[own] = np.cumsum(rows[own]) - rows[own]
    table = spark.createDataFrame([(i, int(owner[i]), int(first[i])) for i in range(slots)], "virtual_slot int, shard int, _first long")
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "row"))
    got = records.withColumn("_place", place).join(F.broadcast(table), "virtual_slot")  # broadcast: one row for each slot
    return got.select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("_first") + F.col("_place") - 1).alias("slot"), F.lit(edited.version).alias("map_version"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = shard_documents(documents(spark, sf_dir))
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


QUERIES, SQL = {"op3_sharding": op3_sharding}, {}

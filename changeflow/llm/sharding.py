"""Shards by fixed virtual slots and an edited, versioned slot-to-shard map.

A record's slot is a hash of its id, one of a fixed number of virtual slots. Bytes are
aggregated per slot; the map from slots to shards is made from those sums alone, so it is
as small as the number of slots, whatever the number of records. Rebalancing edits the
map: it moves the fewest slots that mend the balance, and stores the result as the next
version. Records never need to be rehashed.

A slot of many equal rows (of null or repeated ids) may outweigh a shard. Slots of more than
a SPREAD-th of a shard's share are therefore spread: their rows are hashed once more, with the
place each had when the records were first written, over all slots. Rows equal in id and text
are interchangeable. A null text has no bytes. An empty table gives an empty result and a map
whose slots have no bytes.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

VIRTUAL_SLOTS = 8192
#: Slots above this part of a shard's share are spread.
SPREAD = 16
#: Bytes that a record takes besides its text.
RECORD_BYTES = 8


def record_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(RECORD_BYTES)


def virtual_slot(*keys: str, slots: int = VIRTUAL_SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slot_bytes(records: DataFrame) -> DataFrame:
    """Rows and bytes of each virtual slot: (virtual_slot, rows, bytes)."""
    return records.groupBy("virtual_slot").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes")
    )


@dataclass(frozen=True)
class SlotMap:
    """The shard of every virtual slot, as of one version."""

    version: int
    shards: int
    shard_of: np.ndarray

    @classmethod
    def balanced(cls, weights: np.ndarray, shards: int) -> SlotMap:
        """Version 0: heaviest slot first, each to the lightest shard."""
        shard_of = np.zeros(len(weights), np.int32)
        heap = [(0, s) for s in range(shards)]
        for slot in np.argsort(-weights, kind="stable"):
            load, shard = heap[0]
            shard_of[slot] = shard
            heapq.heapreplace(heap, (load + int(weights[slot]), shard))
        return cls(0, shards, shard_of)

    def rebalanced(self, weights: np.ndarray, shards: int | None = None) -> SlotMap:
        """The next version: slots move from the heaviest to the lightest shard.

        A move must narrow the gap between the two; of those, the one that leaves the
        smallest gap is made. ``shards`` may be larger than before. Shards that end keep
        their slots until these are moved, which happens first.
        """
        shards = self.shards if shards is None else shards
        shard_of = self.shard_of.copy()
        load = np.bincount(shard_of, weights, max(shards, self.shards)).astype(np.int64)
        for slot in np.flatnonzero(shard_of >= shards):
            target = int(load[:shards].argmin())
            shard_of[slot] = target
            load[target] += int(weights[slot])
        load = load[:shards]
        while True:
            heavy, light = int(load.argmax()), int(load.argmin())
            gap = load[heavy] - load[light]
            own = np.flatnonzero((shard_of == heavy) & (weights > 0) & (weights < gap))
            if not len(own):
                break
            slot = own[np.abs(gap - 2 * weights[own]).argmin()]
            shard_of[slot] = light
            load[heavy] -= weights[slot]
            load[light] += weights[slot]
        return SlotMap(self.version + 1, shards, shard_of)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(int(slot), int(shard)) for slot, shard in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "virtual_slot int, shard int")

    def store(self, spark: SparkSession, path: str) -> None:
        """Write this version; an existing version is never overwritten."""
        target = f"{path.rstrip('/')}/version={self.version}"
        self.frame(spark).withColumn("shards", F.lit(self.shards)).coalesce(1).write.parquet(target)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A stored version, the latest unless one is named."""
        stored = spark.read.option("basePath", path).parquet(path)
        if version is None:
            version = stored.agg(F.max("version")).first()[0]
        rows = stored.where(F.col("version") == version).orderBy("virtual_slot").collect()
        return cls(int(version), rows[0]["shards"], np.array([r["shard"] for r in rows], np.int32))


def slot_weights(records: DataFrame, slots: int = VIRTUAL_SLOTS) -> np.ndarray:
    """Bytes per virtual slot, on the driver: as many numbers as there are slots."""
    weights = np.zeros(slots, np.int64)
    for row in slot_bytes(records).collect():
        weights[row["virtual_slot"]] = row["bytes"]
    return weights


def placed(records: DataFrame, slot_map: SlotMap) -> DataFrame:
    """Records with their shard and their place in it, gapless from 0.

    ``records`` are those of :func:`sharded`. Rows are numbered
    within their virtual slot and start where the shard's earlier slots end.
    """
    spark = records.sparkSession
    mapped = F.broadcast(slot_map.frame(spark))  # as many rows as virtual slots
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        slot_bytes(records)
        .join(mapped, "virtual_slot")
        .select(
            "virtual_slot", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_start")
        )
    )
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "_place")
    return (
        records.withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(starts), "virtual_slot")  # as many rows as virtual slots
        .withColumn("slot", F.col("_start") + F.col("_row") - F.lit(1))
        .drop("_start", "_row", "_place")
    )


def spread(records: DataFrame, weights: np.ndarray, shards: int) -> DataFrame:
    """Records whose slot is too heavy for an even balance, in slots by their place too."""
    heavy = np.flatnonzero(weights * shards * SPREAD > weights.sum())  # shards * SPREAD at most
    if not len(heavy):
        return records
    own = virtual_slot("virtual_slot", "_place", slots=len(weights))
    slot = F.col("virtual_slot")
    return records.withColumn("virtual_slot", F.when(slot.isin(heavy.tolist()), own).otherwise(slot))


def sharded(documents: DataFrame, shards: int, path: str, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """Every document with its shard under a map of its own bytes, balanced and then edited.

    Records and versions of the map lie below ``path``: version 0 balances the slots that the
    ids and texts give, version 1 is edited for the slots that had to be spread. Records are
    written once, so that a place is the same wherever it is read again.
    """
    spark = documents.sparkSession
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")))
    documents.select(
        "doc_id",
        record_size().alias("size"),
        crc.alias("text_crc32"),
        virtual_slot("doc_id", "text", slots=slots).alias("virtual_slot"),
        F.monotonically_increasing_id().alias("_place"),
    ).write.parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records")
    weights = slot_weights(records, slots)
    SlotMap.balanced(weights, shards).store(spark, f"{path}/map")
    records = spread(records, weights, shards)
    edited = SlotMap.load(spark, f"{path}/map").rebalanced(slot_weights(records, slots))
    edited.store(spark, f"{path}/map")
    return placed(records, SlotMap.load(spark, f"{path}/map"))

"""Compaction of a keyed change topic.

Below a clean point only what a key's latest state depends on remains: its last record, and
the last one that names an operation where that is another. Tombstones remain for a while,
so that a consumer on its way from the start learns of the deletes, then go as well. What
lies at the clean point or beyond is left alone. Records keep their positions, so consumers
read on from where they are, and a replay of what is left gives the state of the whole topic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITION = ("kafka_offset", "kafka_partition")


def compacted(
    topic: DataFrame,
    keys: Sequence[str],
    clean: Column,
    expired: Column,
    position: Sequence[str] = POSITION,
) -> DataFrame:
    """The topic after compaction.

    ``clean`` tells the records below the clean point, ``expired`` the tombstones whose time
    is over. Records are ordered by ``position``. Those without a key (all of its columns
    null) say nothing about any state; below the clean point they go.
    """
    names = topic.columns
    record = F.struct(*position, *[c for c in names if c not in position])
    named = F.col("op_type").isNotNull()
    keyed = F.coalesce(*[F.col(k).cast("string") for k in keys])
    last = (
        topic.filter(clean & keyed.isNotNull())
        .groupBy(*[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)])
        .agg(F.max(record).alias("last"), F.max(F.when(named, record)).alias("operation"))
        .select(F.explode(F.array_distinct(F.array("last", "operation"))).alias("kept"))
        .filter(F.col("kept").isNotNull())
        .select(*[F.col(f"kept.{c}").alias(c) for c in names])
    )
    over = F.coalesce((F.col("op_type") == "D") & expired, F.lit(False))
    dirty = topic.filter(~F.coalesce(clean, F.lit(False)))
    return last.filter(~over).unionByName(dirty)

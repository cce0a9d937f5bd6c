"""Whether a topic keeps to its keys: all events of a key in one partition, in rising order.

Everything that reduces a key by offset relies on this. It holds where the key is the
message key and the topic has never been written anew; it does not where a producer keys by
something else, where partitions were added, or where a topic was copied out of order.

What is known of a key is one row: the partition it was first seen in, and the greatest
offset it reached there. A batch reads the rows of its keys only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOVED = "moved"
BACKWARDS = "backwards"


def with_known(known: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Events beside what is known of their key before them: home, reached (null if new).

    A new key is at home in the partition of its least offset in the batch.
    """
    keyed = events.filter(F.col(key).isNotNull())
    first = keyed.groupBy(key).agg(F.min(F.struct("kafka_offset", "kafka_partition")).alias("first"))
    homes = first.join(known.select(key, "home", "reached"), key, "left").select(
        key, F.coalesce("home", "first.kafka_partition").alias("home"), "reached"
    )
    return keyed.join(homes, key)


def violations(known: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """The events that break the order of their key: key, position, violation, home, reached.

    ``moved``: in another partition than the key's first event. ``backwards``: in the same
    one, but not beyond what earlier batches reached.
    """
    away = F.col("kafka_partition") != F.col("home")
    behind = F.col("kafka_offset") <= F.col("reached")
    what = F.when(away, MOVED).when(behind, BACKWARDS)
    found = with_known(known, events, key).withColumn("violation", what)
    return found.filter(F.col("violation").isNotNull()).select(
        key, "kafka_partition", "kafka_offset", "violation", "home", "reached"
    )


def known_after(known: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """What is known of the batch's keys after it: key, home, reached."""
    at_home = F.when(F.col("kafka_partition") == F.col("home"), F.col("kafka_offset"))
    return (
        with_known(known, events, key)
        .groupBy(key, "home")
        .agg(F.greatest(F.max("reached"), F.max(at_home)).alias("reached"))
    )

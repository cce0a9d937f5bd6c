"""Delta forms of the latest state and of the roll-ups.

Each takes what is stored of the keys a batch touches, one row a key, and the batch's
events, and gives the rows to store instead. Neither reads a key's history: an order with
a million lines costs a batch what one with ten does.

A list that only grows is stored in chunks. The row of its order has the first chunk once
that is full (``head``), the one still open (``tail``), and the position its next element
takes; full chunks also go to a table of their own, which only readers open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import schemas


def latest_schema(event: T.StructType, keys: Sequence[str], columns: Sequence[str]) -> T.StructType:
    """The stored row of a key's latest state: its last event, and its last operation."""
    fields = [event[name] for name in (*keys, *columns, "op_type")]
    return T.StructType([*fields, *schemas.POSITION.fields, T.StructField("op_offset", T.LongType())])


def merged_latest(
    state: DataFrame, log: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The latest state after a batch of events; keys without any stay as they are."""
    offset = F.when(F.col("op_type").isNotNull(), F.col("kafka_offset")).alias("op_offset")
    names = [*keys, *columns, "op_type", *schemas.POSITION.names]
    both = state.select(*names, "op_offset").unionByName(log.select(*names, offset))
    event = F.max(F.struct("kafka_offset", "kafka_partition", *columns)).alias("event")
    operation = F.when(F.col("op_offset").isNotNull(), F.struct("op_offset", "op_type"))
    return (
        both.groupBy(*keys)
        .agg(event, F.max(operation).alias("operation"))
        .select(*keys, *[f"event.{c}" for c in columns], "operation.op_type",
                "event.kafka_partition", "event.kafka_offset", "operation.op_offset")
    )


def list_schema(key: str, element: T.DataType, *more: T.StructField) -> T.StructType:
    """The stored row of a list."""
    items = T.ArrayType(element)
    return T.StructType(
        [
            T.StructField(key, T.StringType()),
            *more,
            T.StructField("next_position", T.LongType()),
            T.StructField("head", items),
            T.StructField("tail", items),
        ]
    )


def grown(state: DataFrame, added: DataFrame, key: str, chunk: int) -> DataFrame:
    """The stored rows after a batch, whose elements of a key are one array (``new``).

    ``full`` has the chunks that are full now. All other columns of both sides are kept.
    A batch that is too large for that takes :func:`grown_chunks` and :func:`grown_lists`.
    """
    both = state.join(added, key, "full")
    nothing = F.slice(F.coalesce("tail", "new"), 1, 0)
    both = both.withColumn("open", F.concat(F.coalesce("tail", nothing), F.coalesce("new", nothing)))
    both = both.withColumns({
        "count": F.floor(F.size("open") / chunk).cast("int"),
        "first": F.expr(f"coalesce(next_position, 0) div {int(chunk)}"),
    })
    chunks = F.transform(
        F.sequence(F.lit(0), F.col("count") - 1),
        lambda n: F.struct((F.col("first") + n).alias("part"), F.slice("open", n * chunk + 1, F.lit(chunk)).alias("items")),
    )
    head = F.when((F.col("first") == 0) & (F.col("count") > 0), F.slice("open", 1, chunk))
    added_rows = F.when(F.col("new").isNull(), 0).otherwise(F.size("new"))
    told = [c for c in (*state.columns, *added.columns) if c not in (key, "next_position", "head", "tail", "new")]
    return both.select(
        key,
        *told,
        (F.coalesce("next_position", F.lit(0)) + added_rows).cast("long").alias("next_position"),
        F.coalesce("head", head).alias("head"),
        F.slice("open", F.col("count") * chunk + 1, F.lit(chunk)).alias("tail"),
        F.when(F.col("count") > 0, chunks).alias("full"),
        F.col("new").isNotNull().alias("grew"),
    )


def full_chunks(lists: DataFrame, key: str) -> DataFrame:
    """The chunks that :func:`grown` filled: key, part, items."""
    return lists.select(key, F.explode("full").alias("held")).select(key, "held.part", "held.items")


def grown_chunks(state: DataFrame, elements: DataFrame, key: str, chunk: int) -> DataFrame:
    """The chunks that new elements fall into, whole: key, part, items.

    ``elements`` has the key, the element's ``position`` among the batch's of its key, and
    the ``element``.
    """
    starts = state.select(key, "next_position")
    at = F.coalesce("next_position", F.lit(0)) + F.col("position")
    grouped = (
        elements.join(starts, key, "left")
        .select(key, at.alias("at"), "element")
        .groupBy(key, F.expr(f"at div {int(chunk)}").alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "element"))).alias("new"))
    )
    open_part = F.expr(f"next_position div {int(chunk)}").alias("part")
    new = F.transform("new", lambda x: x["element"])
    return grouped.join(state.select(key, open_part, "tail"), [key, "part"], "left").select(
        key, "part", F.when(F.col("tail").isNull(), new).otherwise(F.concat("tail", new)).alias("items")
    )


def grown_lists(state: DataFrame, chunks: DataFrame, key: str, chunk: int) -> DataFrame:
    """The stored rows after a batch: key, next_position, head, tail."""
    first = F.max_by("items", F.when(F.col("part") == 0, F.col("part")))
    grown = chunks.groupBy(key).agg(
        F.max("part").alias("part"), F.max_by("items", "part").alias("last"), first.alias("first")
    )
    full = F.size("last") == chunk
    position = F.when(F.col("part").isNull(), F.col("next_position")).otherwise(
        F.col("part") * chunk + F.size("last")
    )
    nothing = F.slice("last", 1, 0)
    return state.select(key, "next_position", "head", "tail").join(grown, key, "full").select(
        key,
        position.alias("next_position"),
        F.coalesce("head", F.when(F.size("first") == chunk, F.col("first"))).alias("head"),
        F.when(F.col("part").isNull(), F.col("tail")).when(full, nothing).otherwise(F.col("last")).alias("tail"),
    )


def stored_parts(state: DataFrame, key: str, chunk: int, *carried: str) -> DataFrame:
    """The parts a stored row itself holds, the first and the open one: key, part, items."""
    first = F.when(F.col("head").isNotNull(), F.struct(F.lit(0).cast("bigint").alias("part"), F.col("head").alias("items")))
    open_part = F.struct(F.expr(f"next_position div {int(chunk)}").alias("part"), F.col("tail").alias("items"))
    last = F.when(F.size("tail") > 0, open_part)
    held = F.filter(F.array(first, last), lambda x: x.isNotNull())
    return state.select(key, *carried, F.explode(held).alias("held")).select(key, *carried, "held.part", "held.items")

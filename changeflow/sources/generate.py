"""Synthetic change events with a chosen mix, generated in parallel.

Every draw is a digest of (seed, draw number, purpose), so the events do not depend
on how Spark partitions the work, and a retried task repeats its events exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow import schemas

# What an event may refer to.
ORDER_COUNT = 20
CUSTOMER_COUNT = 8
CHANNELS = ("web", "phone", "partner-api")
STATUSES = ("CONFIRMED", "PICKING", "SHIPPED", "CANCELLED")
FIRST_DATE = "2026-01-05"
PAIR_RATIO = 0.3

#: Draws per block of the two-level count of emitted events.
BLOCK = 1_000_000


@dataclass(frozen=True)
class EventMix:
    """Shares of deletes and automatic links, the seed, and the first instant."""

    delete_ratio: float = 0.2
    automatic_ratio: float = 0.25
    seed: int = 20260105
    start_ms: int = 1_767_600_000_000


def _draw(mix: EventMix, purpose: str, bound: int) -> Column:
    """A number in [0, bound) that depends on the seed, the draw and the purpose."""
    text = F.concat_ws(":", F.lit(str(mix.seed)), F.col("draw").cast("string"), F.lit(purpose))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % bound


def _share(mix: EventMix, purpose: str, ratio: float) -> Column:
    return _draw(mix, purpose, 1_000_000) < int(ratio * 1_000_000)


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def generated_events(draws: DataFrame, count: int, mix: EventMix = EventMix()) -> DataFrame:
    """Exactly ``count`` events from the consecutive numbers in ``draws.draw``.

    A draw yields a delete, an insert, or a delete and insert one millisecond apart.
    Draws are thus one event or two; which is the last to fit follows from a count
    per block of draws and a running total within each, never one global sort.
    """
    n = F.col("draw")
    # Steps of 1 to 30 seconds without a running sum: draws come in twos, 31 seconds
    # apart, and the second of the two falls anywhere in between.
    within = 1 + _draw(mix, "step", 30)
    seconds = F.expr("draw div 2") * 31 + F.when(n % 2 == 1, within).otherwise(0)
    delete = _share(mix, "delete", mix.delete_ratio)
    pair = ~delete & _share(mix, "pair", PAIR_RATIO)
    planned = draws.select(
        "draw",
        F.expr(f"draw div {BLOCK}").alias("block"),
        (mix.start_ms + seconds * 1000).alias("moment"),
        delete.alias("is_delete"),
        pair.alias("is_pair"),
        F.when(pair, 2).otherwise(1).alias("size"),
    )
    blocks = planned.groupBy("block").agg(F.sum("size").alias("block_size"))
    running = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before_block = blocks.select(
        "block", F.coalesce(F.sum("block_size").over(running), F.lit(0)).alias("offset")
    )
    in_block = Window.partitionBy("block").orderBy("draw").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = (
        planned.join(before_block, "block")
        .withColumn("first", F.col("offset") + F.coalesce(F.sum("size").over(in_block), F.lit(0)))
        .filter(F.col("first") < count)
    )
    # The pair that would overrun the count is cut to a single insert.
    paired = F.col("is_pair") & (F.col("first") + 2 <= count)
    first_op = F.when(F.col("is_delete") | paired, "D").otherwise("I")

    def event(op: Column, step: int, ref: str) -> Column:
        return F.struct(
            (F.col("first") + step).alias("sequence"),
            op.alias("op_type"),
            (F.col("moment") + step).alias("op_ts"),
            F.lit(ref).alias("purpose"),
            _draw(mix, ref, CUSTOMER_COUNT).alias("customer"),
            _draw(mix, f"channel-{step}", len(CHANNELS)).alias("channel"),
            _draw(mix, f"status-{step}", len(STATUSES)).alias("state"),
            _draw(mix, f"day-{step}", 6).alias("day"),
            (5 + _draw(mix, f"delay-{step}", 246)).alias("delay"),
        )

    second = event(F.lit("I"), 1, "customer-1")
    events = F.when(paired, F.array(event(first_op, 0, "customer-0"), second)).otherwise(
        F.array(event(first_op, 0, "customer-0"))
    )

    def numbered(prefix: str, number: Column, width: int) -> Column:
        return F.concat(F.lit(prefix), F.lpad((number + 1).cast("string"), width, "0"))

    return placed.select(
        numbered("ORD-", _draw(mix, "order", ORDER_COUNT), 4).alias("order_id"),
        F.when(_share(mix, "origin", mix.automatic_ratio), "A").otherwise("M").alias("link_origin"),
        F.explode(events).alias("e"),
    ).select(
        "e.sequence",
        "order_id",
        numbered("CUST-", F.col("e.customer"), 5).alias("customer_ref"),
        _pick(CHANNELS, F.col("e.channel")).alias("channel_id"),
        _pick(STATUSES, F.col("e.state")).alias("status"),
        F.date_format(
            F.date_add(F.to_date(F.lit(FIRST_DATE)), F.col("e.day").cast("int")), "yyyy-MM-dd"
        ).alias("event_date"),
        "link_origin",
        "e.op_type",
        "e.op_ts",
        (F.col("e.op_ts") + F.col("e.delay")).alias("current_ts"),
    ).select("sequence", *schemas.ORDER_EVENT.names)

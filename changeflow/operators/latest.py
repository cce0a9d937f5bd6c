"""Latest state per key, tombstones, and child roll-ups over a change log.

All reductions are aggregates with map-side partial results. Events of a key are
ordered by ``kafka_offset``: the key must be the message key, so that all its events
lie in one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions.values import trim_controls

ORDER_COLUMNS = ("customer_ref", "channel_id", "status", "event_date", "link_origin")
LINE_COLUMNS = ("product_ref", "quantity", "unit_price")
CUSTOMER_COLUMNS = ("customer_name", "country_code", "segment")

#: Elements of one array. An order with more has further rows, numbered by their part.
CHUNK = 100_000

#: Ranges an order's elements are numbered in, so that no task sorts all of a large one.
RANGES = 4096

#: Rows of an order that one task takes at once. Only orders with more are cut into ranges.
CROWDED = 100_000


def latest_operation() -> Column:
    """Aggregate: the last operation that is not null."""
    op = F.col("op_type")
    return F.max_by(op, F.when(op.isNotNull(), F.col("kafka_offset")))


def latest(
    log: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    *,
    ignore_nulls: bool = False,
    keep_deleted: bool = False,
) -> DataFrame:
    """The last value of every column per key.

    With ``ignore_nulls`` each column keeps its last non-null value, so a partial
    event erases nothing; otherwise the last event counts as it is. Keys whose last
    operation is a delete are dropped, as are keys that never named an operation;
    ``keep_deleted`` keeps both, with their ``op_type``, for a changelog.

    A null key has no state; a key of several columns may have nulls among them.
    """
    source = log.filter(F.col(keys[0]).isNotNull()) if len(keys) == 1 else log
    if ignore_nulls:
        values = [
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col("kafka_offset"))).alias(c)
            for c in columns
        ]
        state = source.groupBy(*keys).agg(*values, latest_operation().alias("op_type"))
    else:
        # The last event carries all its columns: one aggregate instead of one each.
        event = F.max(F.struct("kafka_offset", "kafka_partition", *columns)).alias("event")
        state = (
            source.groupBy(*keys)
            .agg(event, latest_operation().alias("op_type"))
            .select(*keys, *[f"event.{c}" for c in columns], "op_type")
        )
    return state if keep_deleted else live(state)


def live(state: DataFrame) -> DataFrame:
    """Drop deleted keys and the operation column."""
    return state.filter(F.col("op_type") != "D").drop("op_type")


def latest_orders(log: DataFrame, ignore_nulls: bool = False) -> DataFrame:
    state = latest(log, ["order_id"], ORDER_COLUMNS, ignore_nulls=ignore_nulls, keep_deleted=True)
    return state.filter(F.col("op_type") != "D")


def latest_order_lines(log: DataFrame, ignore_nulls: bool = False) -> DataFrame:
    """Live lines under one struct key."""
    state = latest(log, ["order_id", "line_number"], LINE_COLUMNS, ignore_nulls=ignore_nulls)
    key = F.struct("order_id", "line_number").alias("order_line_key")
    return state.select(key, *LINE_COLUMNS)


def latest_customers(log: DataFrame, ignore_nulls: bool = False) -> DataFrame:
    return latest(log, ["customer_ref"], CUSTOMER_COLUMNS, ignore_nulls=ignore_nulls)


def _operations() -> dict[str, Column]:
    """Per event, the offsets an order's last operation and last delete are found by.

    Two maxima over offsets instead of a latest value: plain longs, which keep aggregates in
    generated code.
    """
    op, offset = F.col("op_type"), F.col("kafka_offset")
    return {"_last": F.when(op.isNotNull(), offset), "_last_delete": F.when(op == "D", offset)}


#: Whether the last operation that is not null leaves the order alive; null where none was named.
ALIVE = "_last > coalesce(_last_delete, -1)"


def _line(*leading: str) -> Column:
    return F.struct(*leading, "line_number", *LINE_COLUMNS)


def _equal_ranges(rows: DataFrame, column: str) -> Column:
    """The range a number falls into when all that occur are cut into RANGES equal ones."""
    ends = rows.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    low, high = ends.select("lo").scalar(), ends.select("hi").scalar()
    share = (F.col(column).cast("double") - low) / (high.cast("double") - low + 1)
    return F.coalesce(F.floor(share * RANGES), F.lit(-1))


def _starts(counts: DataFrame, carried: Sequence[str], summed: Sequence[str]) -> DataFrame:
    """Per order and range, the elements in earlier ranges; and what is told of the whole order.

    ``counts`` has the elements of a range (``_n``). Of the whole order ``carried`` columns
    are the greatest, ``summed`` ones the sum.
    """
    whole = Window.partitionBy("order_id")
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        "order_id",
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
        *[F.max(c).over(whole).alias(c) for c in carried],
        *[F.sum(c).over(whole).alias(c) for c in summed],
    )


def crowded(rows: DataFrame) -> DataFrame:
    """The orders with more than CROWDED rows: one for each CROWDED rows at most."""
    return rows.groupBy("order_id").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > CROWDED).select("order_id")


def split_crowded(rows: DataFrame, many: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of the other orders, and those of the crowded ones."""
    return tuple(rows.join(F.broadcast(many), "order_id", how) for how in ("left_anti", "left_semi"))


def cut(items: str, chunk: int) -> Column:
    """An array in parts of ``chunk`` elements: part, items. An empty one is part 0."""
    parts = F.greatest(F.ceil(F.size(items) / chunk), F.lit(1)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda n: F.struct(n.cast("long").alias("part"), F.slice(items, n * chunk + 1, F.lit(chunk)).alias("items")),
    )


def positions(
    rows: DataFrame,
    in_range: Column,
    ordering: Sequence[str | Column],
    greatest: dict[str, Column] | None = None,
    summed: dict[str, Column] | None = None,
    many: DataFrame | None = None,
) -> DataFrame:
    """Number the elements of every order from 0 (``position``).

    Rows are shuffled once and numbered within their order; those of crowded orders
    (``many``) in two levels. Every row also tells the ``greatest`` and ``summed`` values of
    its order. ``in_range`` must not fall where ``ordering`` rises.
    """
    greatest, summed = greatest or {}, summed or {}
    few, spread = split_crowded(rows, crowded(rows) if many is None else many)
    whole = Window.partitionBy("order_id")
    numbered = few.select(
        "*",
        *[F.max(c).over(whole).alias(name) for name, c in greatest.items()],
        *[F.sum(c).over(whole).alias(name) for name, c in summed.items()],
        (F.row_number().over(whole.orderBy(*ordering)) - 1).cast("long").alias("position"),
    )
    return numbered.unionByName(_positions_by_range(spread, in_range, ordering, greatest, summed))


def _positions_by_range(
    rows: DataFrame, in_range: Column, ordering: Sequence[str | Column], greatest: dict[str, Column], summed: dict[str, Column]
) -> DataFrame:
    """Number in two levels: within order and range, then ranges by their counts.

    The last number of a range is its count, so rows are shuffled once.
    """
    within = Window.partitionBy("order_id", "_range").orderBy(*ordering)
    numbered = rows.withColumn("_range", in_range).withColumn("_at", F.row_number().over(within) - 1)
    counts = numbered.groupBy("order_id", "_range").agg(
        (F.max("_at") + 1).alias("_n"),
        *[F.max(c).alias(name) for name, c in greatest.items()],
        *[F.sum(c).alias(name) for name, c in summed.items()],
    )
    return (
        numbered.join(_starts(counts, list(greatest), list(summed)), ["order_id", "_range"])
        .withColumn("position", F.col("_start") + F.col("_at"))
        .drop("_range", "_start", "_at")
    )


#: How the events of an order lie in their topic.
IN_TOPIC = ("kafka_offset", "kafka_partition")


def numbered_in_order(events: DataFrame, **told: dict[str, Column]) -> DataFrame:
    """The events of every order numbered from 0 (``position``) as they lie in their topic."""
    return positions(events, _equal_ranges(events, "kafka_offset"), IN_TOPIC, **told)


def _listed(log: DataFrame, mode: str) -> tuple[DataFrame, tuple[str, ...], DataFrame]:
    """The lines to list, what orders them, and which orders are crowded."""
    events = log.filter(F.col("order_id").isNotNull())
    if mode == "changelog":
        return events, IN_TOPIC, crowded(events)
    if mode == "current":
        lines = latest_order_lines(events).select("order_line_key.*", *LINE_COLUMNS)
        return lines, ("line_number",), crowded(events)
    raise ValueError(f"mode must be 'changelog' or 'current', not {mode!r}")


def order_lines(log: DataFrame, mode: str = "changelog", **told: dict[str, Column]) -> DataFrame:
    """The long form of ``lines_by_order``: one row for each line, with its ``position``.

    What is ``told`` of an order is as in :func:`positions`.
    """
    lines, ordering, many = _listed(log, mode)
    return positions(lines, _equal_ranges(lines, ordering[0]), ordering, many=many, **told)


def lines_by_order(log: DataFrame, mode: str = "changelog", chunk: int = CHUNK) -> DataFrame:
    """The lines of an order as arrays, with the order's total.

    ``changelog`` rolls up every line event, superseded and deleted ones included,
    and drops an order whose last line event is a delete. ``current`` rolls up the
    live lines only, whatever their history.

    An array holds ``chunk`` elements at most: the row of ``lines_part`` n those from
    position n * chunk on. Usually there is only part 0; it alone has the total. Lines are
    gathered order by order, those of crowded orders part by part.
    """
    rows, ordering, many = _listed(log, mode)
    few, spread = split_crowded(rows, many)
    greatest, summed = _operations() if mode == "changelog" else {}, {"_total": F.col("quantity") * F.col("unit_price")}
    told = [F.max(c).alias(n) for n, c in greatest.items()] + [F.sum(c).alias(n) for n, c in summed.items()]
    leading = [c for c in ordering if c != "line_number"]  # which a line starts with
    listed = few.groupBy("order_id").agg(F.sort_array(F.collect_list(_line(*leading))).alias("_lines"), *told)
    numbered = _positions_by_range(spread, _equal_ranges(spread, ordering[0]), ordering, greatest, summed)
    if mode == "changelog":
        listed, numbered = listed.filter(ALIVE), numbered.filter(ALIVE)
    parts = listed.select("order_id", "_total", F.explode(cut("_lines", chunk)).alias("_cut")).select(
        "order_id", F.col("_cut.part").alias("lines_part"), _shown_lines("_cut.items"), "_total"
    )
    gathered = (
        numbered.groupBy("order_id", F.expr(f"position div {int(chunk)}").alias("lines_part"))
        .agg(F.sort_array(F.collect_list(_line("position"))).alias("_lines"), F.first("_total").alias("_total"))
        .select("order_id", "lines_part", _shown_lines("_lines"), "_total")
    )
    # A sum over no amounts is zero, not unknown.
    total = F.coalesce("_total", F.lit(0)).cast("decimal(33,2)")
    return parts.unionByName(gathered).select(
        "order_id", "lines_part", "lines", F.when(F.col("lines_part") == 0, total).alias("order_total")
    )


def _shown_lines(items: str) -> Column:
    """Lines without what ordered them."""
    columns = ("line_number", *LINE_COLUMNS)
    return F.transform(items, lambda x: F.struct(*[x[c].alias(c) for c in columns])).alias("lines")


def order_customer_refs(log: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The distinct trimmed customer references ever seen on an order.

    Repeats are collapsed before references are gathered. An array holds ``chunk`` of
    them at most, and further ones follow under the next ``refs_part``. Part 0 stands for
    the order even if it has no reference.
    """
    events = log.filter(F.col("order_id").isNotNull()).withColumn("ref", trim_controls(F.col("customer_ref")))
    few, spread = split_crowded(events, crowded(events))
    in_range = F.pmod(F.xxhash64("ref"), F.lit(RANGES))
    operations = [F.max(c).alias(n) for n, c in _operations().items()]
    ranged = F.transform("_refs", lambda ref: F.struct(F.pmod(F.xxhash64(ref), F.lit(RANGES)), ref.alias("ref")))
    listed = (
        few.groupBy("order_id").agg(F.collect_set("ref").alias("_refs"), *operations).filter(ALIVE)
        .withColumn("_refs", F.transform(F.sort_array(ranged), lambda x: x["ref"]))
        .select("order_id", F.explode(cut("_refs", chunk)).alias("_cut"))
        .select("order_id", F.col("_cut.part").alias("refs_part"), F.sort_array("_cut.items").alias("customer_refs"))
    )
    grouped = spread.groupBy("order_id", in_range.alias("_range")).agg(F.collect_set("ref").alias("_refs"), *operations)
    counts = grouped.withColumn("_n", F.size("_refs")).drop("_refs")
    starts = _starts(counts, list(_operations()), []).filter(ALIVE)
    gathered = (
        grouped.select("order_id", "_range", "_refs")
        .join(starts, ["order_id", "_range"])
        .select("order_id", "_start", F.posexplode_outer(F.sort_array("_refs")).alias("_at", "ref"))
        .withColumn("position", F.col("_start") + F.coalesce("_at", F.lit(0)))
        .groupBy("order_id", F.expr(f"position div {int(chunk)}").alias("refs_part"))
        .agg(F.sort_array(F.collect_list("ref")).alias("customer_refs"))
        .filter((F.col("refs_part") == 0) | (F.size("customer_refs") > 0))
    )
    return listed.unionByName(gathered)

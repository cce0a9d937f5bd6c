"""The enriched order view, kept current as any of its three inputs changes.

A micro-batch mixes events of all three topics. What is stored of the keys it touches, one
row a key, is read, merged with the events and written back; the orders that changed are
shown anew, the others are not looked at. No batch reads an order's history.

Every topic partition has a mark, committed with the tables: the greatest offset applied.
Events up to it are passed over, so a topic read again from its start, under whatever
checkpoint, changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow import schemas
from changeflow.functions.values import trim_controls
from changeflow.operators.enrich import enriched_orders
from changeflow.operators.latest import (
    CHUNK, CUSTOMER_COLUMNS, IN_TOPIC, LINE_COLUMNS, ORDER_COLUMNS, RANGES, crowded, numbered_in_order, positions,
    split_crowded,
)
from changeflow.operators.rollup import (
    full_chunks, grown, grown_chunks, grown_lists, latest_schema, list_schema, merged_latest, stored_parts,
)
from changeflow.streaming.kept import BROADCAST_BYTES, Kept, measured
from changeflow.streaming.tables import GATHER_EVERY, Head, Table, TableSet, batch_source

TOPICS = {
    "orders": schemas.ORDER_EVENT,
    "lines": schemas.LINE_EVENT,
    "customers": schemas.CUSTOMER_EVENT,
}

#: Buckets of the gathered tables: enough that the keys of a batch touch few of them.
BUCKETS = 1024

#: The greatest applied offset of each topic partition.
MARKS = "marks"

LINE = schemas.ORDER_LINES.elementType
OPERATION = (T.StructField("op_type", T.StringType()), T.StructField("op_offset", T.LongType()))
VIEW = T.StructType([*schemas.ENRICHED.fields, *schemas.struct(part=schemas.LONG, deleted=T.BooleanType()).fields])


def _tables(buckets: int) -> dict[str, Table]:
    total = T.StructField("order_total", schemas.TOTAL)
    pair = schemas.struct(pair=schemas.LONG, order_id=schemas.TEXT, ref=schemas.TEXT)
    chunk = schemas.struct(order_id=schemas.TEXT, part=schemas.LONG)
    orders = latest_schema(schemas.ORDER_EVENT, ["order_id"], ORDER_COLUMNS)
    customers = latest_schema(schemas.CUSTOMER_EVENT, ["customer_ref"], CUSTOMER_COLUMNS)
    named = schemas.struct(customer_ref=schemas.TEXT, order_id=schemas.TEXT)

    def chunks(element: T.DataType) -> T.StructType:
        return T.StructType([*chunk.fields, T.StructField("items", T.ArrayType(element))])

    return {
        "orders": Table(orders, ("order_id",), lookup="order_id", buckets=buckets),
        "customers": Table(customers, ("customer_ref",), lookup="customer_ref", buckets=buckets),
        # which orders have ever named a customer, looked up by the customer
        "named": Table(named, ("customer_ref", "order_id"), lookup="customer_ref", buckets=buckets),
        "lines": Table(list_schema("order_id", LINE, total, *OPERATION), ("order_id",), lookup="order_id", buckets=buckets),
        "line_chunks": Table(chunks(LINE), lookup="order_id", buckets=buckets),
        # which references an order has, looked up by both
        "pairs": Table(pair, ("pair", "order_id", "ref"), lookup="pair", buckets=buckets),
        "refs": Table(list_schema("order_id", schemas.TEXT), ("order_id",), lookup="order_id", buckets=buckets),
        "ref_chunks": Table(chunks(schemas.TEXT), lookup="order_id", buckets=buckets),
        "view": Table(VIEW, ("order_key", "part"), "deleted", "order_key", buckets),
        "changes": Table(VIEW, lookup="order_key", buckets=buckets),
    }


def mixed_topics(topics: dict[str, DataFrame]) -> DataFrame:
    """One stream of all topics, each event tagged with where it came from."""
    tagged = [events.withColumn("topic", F.lit(name)) for name, events in topics.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _partition() -> Column:
    return F.concat_ws("/", "topic", F.col("kafka_partition").cast("string"))


def _alive() -> Column:
    """Whether the last operation that was named leaves the key alive."""
    return F.coalesce(F.col("op_type") != "D", F.lit(False))


class Keys:
    """Keys to be looked up: measured once, and broadcast where they are few."""

    def __init__(self, frame: DataFrame, *columns: str) -> None:
        self.frame, self.columns = frame, list(columns)
        self.wanted = F.broadcast(frame) if measured(frame)[1] <= BROADCAST_BYTES else frame
        self._touched: list[int] | None = None

    def touched(self, tables: TableSet, name: str, head: Head) -> list[int]:
        """The buckets they fall into, the same in all tables that are looked up by them."""
        if all(p.buckets is None for p in head.parts.get(name, [])):
            return []
        if self._touched is None:
            self._touched = tables.touched(name, self.frame, head, self.columns[0])
        return self._touched


class EnrichedView:
    """The view, and the state of its inputs that it is kept current from."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        gather_every: int = GATHER_EVERY,
        buckets: int = BUCKETS,
        chunk: int = CHUNK,
    ) -> None:
        self.chunk = chunk
        self.tables = TableSet(spark, root, _tables(buckets), gather_every)

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(
            lambda batch, batch_id: self.apply(batch, batch_id, checkpoint)
        ).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def apply(self, batch: DataFrame, batch_id: int, source: str) -> None:
        source = batch_source(source, batch)
        attempt = self.tables.begin()
        if attempt.head.holds(source, batch_id):
            return
        with Kept() as keep:
            fresh = keep.written(unseen(batch, attempt.head))
            found = fresh.groupBy("topic", _partition()).agg(F.max("kafka_offset")).collect()
            if found:
                rows = self._after(fresh, {r[0] for r in found}, attempt.head, keep)
                self.tables.write("view", rows.pop("view"), attempt)
                self.tables.write_all({"changes": self.tables.attempted("view", attempt), **rows}, attempt)
                self.tables.gather(attempt)
            marks = attempt.head.note(MARKS) | {r[1]: r[2] for r in found}
            self.tables.commit(attempt, source, batch_id, marks=marks)

    # --- a batch --------------------------------------------------------------------

    def _stored(self, name: str, keys: Keys, head: Head) -> DataFrame:
        """The stored rows of some keys, from the buckets that hold them."""
        rows = self.tables.current(name, head, keys.touched(self.tables, name, head))
        return rows.join(keys.wanted, keys.columns, "left_semi")

    def _chunks(self, name: str, keys: DataFrame, head: Head) -> DataFrame:
        """The full chunks of some orders."""
        if not head.parts.get(name):
            return self._none(name)
        touched = self.tables.touched(name, keys, head, "order_id")
        return self.tables.versions(name, head, touched=touched).join(keys, "order_id", "left_semi")

    def _none(self, name: str) -> DataFrame:
        return self.tables.appended(name, Head())

    def _after(self, fresh: DataFrame, topics: set[str], head: Head, keep: Kept) -> dict[str, DataFrame]:
        """The rows to store, and to show, once the events are applied.

        Of topics without events nothing is computed.
        """
        new = {t: fresh.filter(F.col("topic") == t).filter(F.col(k).isNotNull())
               for t, k in (("orders", "order_id"), ("lines", "order_id"), ("customers", "customer_ref"))}
        by_event = {t: new[t].select("order_id").distinct() for t in ("orders", "lines")}
        changed = keep.written(new["customers"].select("customer_ref").distinct())
        found = [by_event[t] for t in ("orders", "lines") if t in topics]
        if "customers" in topics:
            found.append(self._stored("named", Keys(changed, "customer_ref"), head).select("order_id"))
        ids = Keys(keep.written(reduce(DataFrame.union, found).distinct()), "order_id")

        orders = self._stored("orders", ids, head)
        if "orders" in topics:
            orders = merged_latest(orders, new["orders"], ["order_id"], ORDER_COLUMNS)
        orders = keep.written(orders)
        refs = orders.filter(F.col("customer_ref").isNotNull()).select("customer_ref").union(changed)
        customers = self._stored("customers", Keys(keep.written(refs.distinct()), "customer_ref"), head)
        if "customers" in topics:
            customers = merged_latest(customers, new["customers"], ["customer_ref"], CUSTOMER_COLUMNS)
        customers = keep.written(customers)

        before = {name: keep.written(self._stored(name, ids, head)) for name in ("lines", "refs")}
        lines, line_chunks = before["lines"], self._none("line_chunks")
        if "lines" in topics:
            lines, line_chunks = self._lines(lines, new["lines"], keep)
        refs, ref_chunks, pairs = before["refs"], self._none("ref_chunks"), None
        if "orders" in topics:
            pairs = keep.written(self._pairs(new["orders"], head, keep))
            refs, ref_chunks = self._refs(refs, pairs, keep)

        shown = keep.written(self._to_show(by_event, orders, changed, before["lines"], lines, refs))
        whole = shown.filter("whole").select("order_id")
        standing = keep.written(shown.join(orders.filter(_alive()), "order_id").drop("whole"))
        here = standing.select("order_id")
        line_state = lines.join(here, "order_id", "left_semi").filter(_alive())
        ref_state = refs.join(here, "order_id", "left_semi")
        line_parts = self._parts("line_chunks", line_state, line_chunks, whole, head, "order_total")
        ref_parts = self._parts("ref_chunks", ref_state, ref_chunks, whole, head)
        fresh = enriched_orders(
            standing.select("order_id", *ORDER_COLUMNS),
            customers.filter(_alive()).select("customer_ref", *CUSTOMER_COLUMNS),
            line_rows(line_parts),
            ref_rows(ref_parts, here),
        )
        rows = {"view": self._shown(shown, standing, fresh, before)}
        if "customers" in topics:
            rows["customers"] = customers.join(changed, "customer_ref", "left_semi")
        if "lines" in topics:
            rows["lines"] = lines.filter("grew")
            rows["line_chunks"] = line_chunks
        if pairs is not None:
            named = new["orders"].filter(F.col("customer_ref").isNotNull())
            rows |= {
                "orders": orders.join(by_event["orders"], "order_id", "left_semi"),
                "pairs": pairs,
                "refs": refs.filter("grew"),
                "ref_chunks": ref_chunks,
                "named": named.select("customer_ref", "order_id").distinct(),
            }
        return rows

    def _lines(self, before: DataFrame, events: DataFrame, keep: Kept) -> tuple[DataFrame, DataFrame]:
        """The lines of each order: what is listed, their total, their last operation; and full chunks.

        What a batch adds to an order is gathered at once. Only of orders that are crowded
        in the batch lines are numbered and gathered chunk by chunk.
        """
        element = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LINE.fields])
        placed = F.sort_array(F.collect_list(F.struct(*IN_TOPIC, element.alias("element"))))
        many = keep(crowded(events))
        spread = not many.isEmpty()
        few, rest = split_crowded(events, many) if spread else (events, events)
        own, large = split_crowded(before, many) if spread else (before, before)
        added = few.groupBy("order_id").agg(F.transform(placed, lambda x: x["element"]).alias("new"), *_sums())
        lines = keep.written(_totalled(grown(own, added, "order_id", self.chunk)))
        chunks = full_chunks(lines, "order_id")
        if spread:
            numbered = numbered_in_order(rest).select("order_id", "position", element.alias("element"))
            grown_parts = keep.written(grown_chunks(large, numbered, "order_id", self.chunk))
            sums = rest.groupBy("order_id").agg(*_sums())
            stored = large.select("order_id", "order_total", "op_type", "op_offset").join(sums, "order_id", "full")
            lists = grown_lists(large, grown_parts, "order_id", self.chunk)
            told = _totalled(lists.join(stored, "order_id").withColumn("grew", F.lit(True)))
            lines = lines.drop("full").unionByName(keep.written(told))
            chunks = chunks.unionByName(grown_parts.filter(F.size("items") == self.chunk))
        return lines, chunks

    def _pairs(self, events: DataFrame, head: Head, keep: Kept) -> DataFrame:
        """References that their orders did not have yet."""
        ref = trim_controls(F.col("customer_ref"))
        seen = events.select("order_id", ref.alias("ref")).filter(F.col("ref").isNotNull()).distinct()
        keyed = keep.written(seen.withColumn("pair", F.xxhash64("order_id", "ref")))
        known = self._stored("pairs", Keys(keyed, "pair", "order_id", "ref"), head)
        return keyed.join(known, ["pair", "order_id", "ref"], "left_anti")

    def _refs(self, before: DataFrame, pairs: DataFrame, keep: Kept) -> tuple[DataFrame, DataFrame]:
        """The references of each order, numbered by a hash; and full chunks."""
        in_range = F.pmod("pair", F.lit(RANGES)).cast("long")
        many = keep(crowded(pairs))
        spread = not many.isEmpty()
        few, rest = split_crowded(pairs, many) if spread else (pairs, pairs)
        own, large = split_crowded(before, many) if spread else (before, before)
        placed = F.sort_array(F.collect_list(F.struct(in_range.alias("at"), "ref")))
        added = few.groupBy("order_id").agg(F.transform(placed, lambda x: x["ref"]).alias("new"))
        refs = keep.written(grown(own, added, "order_id", self.chunk))
        chunks = full_chunks(refs, "order_id")
        if spread:
            numbered = positions(rest, in_range, [in_range, "ref"]).select("order_id", "position", F.col("ref").alias("element"))
            grown_parts = keep.written(grown_chunks(large, numbered, "order_id", self.chunk))
            lists = grown_lists(large, grown_parts, "order_id", self.chunk).withColumn("grew", F.lit(True))
            refs = refs.drop("full").unionByName(keep.written(lists))
            chunks = chunks.unionByName(grown_parts.filter(F.size("items") == self.chunk))
        return refs, chunks

    def _to_show(
        self, by_event: dict[str, DataFrame], orders: DataFrame, changed: DataFrame,
        lines_before: DataFrame, lines: DataFrame, refs: DataFrame,
    ) -> DataFrame:
        """The orders to show anew, and whether whole or just where their lists grew.

        An order is shown whole after an event of its own or of its customer, if its lines
        have come to an end or to life again, and if its references fill several parts.
        """
        own = by_event["orders"].withColumn("own", F.lit(True))
        bought = by_event["lines"].withColumn("bought", F.lit(True))
        customer = orders.join(changed, "customer_ref", "left_semi").select("order_id", F.lit(True).alias("customer"))
        was = lines_before.select("order_id", _alive().alias("was"))
        now = lines.select("order_id", _alive().alias("now"))
        many = refs.select("order_id", (F.col("next_position") > self.chunk).alias("many"))
        touched = own.join(bought, "order_id", "full").join(customer, "order_id", "full")
        flags = touched.join(was, "order_id", "left").join(now, "order_id", "left").join(many, "order_id", "left")
        turned = F.coalesce("was", F.lit(False)) != F.coalesce("now", F.lit(False))
        whole = F.coalesce("own", "customer", F.lit(False)) | turned | F.coalesce("many", F.lit(False))
        return flags.select("order_id", whole.alias("whole"))

    def _parts(
        self, name: str, state: DataFrame, grown: DataFrame, whole: DataFrame, head: Head, *carried: str
    ) -> DataFrame:
        """The parts to show: the first and the open one, those that grew, or all."""
        own = stored_parts(state, "order_id", self.chunk, *carried)
        several = state.filter(F.col("next_position") > self.chunk).select("order_id")
        full = grown.select("order_id", "part", "items").join(several, "order_id", "left_semi")
        stored = self._chunks(name, several.join(whole, "order_id", "left_semi"), head).select("order_id", "part", "items")
        between = full.unionByName(stored).filter("part > 0")
        return own.unionByName(between, allowMissingColumns=True)

    def _shown(
        self, shown: DataFrame, standing: DataFrame, fresh: DataFrame, before: dict[str, DataFrame]
    ) -> DataFrame:
        """Rows of the view: the parts of orders that stand, tombstones for those that went."""
        part = F.coalesce("lines_part", "refs_part", F.lit(0)).alias("part")
        fresh = fresh.select("*", part, F.lit(False).alias("deleted"))
        # what was shown before: as many parts as the longer list had, and one at least
        count = F.greatest(
            F.ceil(F.coalesce("line_count", F.lit(0)) / self.chunk),
            F.ceil(F.coalesce("ref_count", F.lit(0)) / self.chunk),
            F.lit(1),
        )
        counts = (
            shown.filter("whole").select("order_id")
            .join(before["lines"].select("order_id", F.col("next_position").alias("line_count")), "order_id", "left")
            .join(before["refs"].select("order_id", F.col("next_position").alias("ref_count")), "order_id", "left")
        )
        held = counts.select("order_id", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("part"))
        absent = shown.filter("NOT whole").join(standing, "order_id", "left_anti")
        held = held.unionByName(absent.select("order_id", F.lit(0).cast("long").alias("part")))
        gone = held.withColumnRenamed("order_id", "order_key").join(fresh, ["order_key", "part"], "left_anti")
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ENRICHED.fields[2:]]
        ended = gone.select("order_key", F.col("order_key").alias("order_id"), *nothing, "part", F.lit(True).alias("deleted"))
        return fresh.unionByName(ended)

    # --- reading --------------------------------------------------------------------

    def current(self, head: Head | None = None) -> DataFrame:
        """The view at a version, by default the newest."""
        return self.tables.current("view", head).select(*schemas.ENRICHED.names)

    def _all_parts(self, name: str, state: DataFrame, head: Head, *carried: str) -> DataFrame:
        own = stored_parts(state, "order_id", self.chunk, *carried)
        stored = self.tables.appended(name, head).filter("part > 0")
        if stored.isEmpty():
            return own
        several = state.filter(F.col("next_position") > self.chunk).select("order_id")
        return own.unionByName(stored.join(several, "order_id", "left_semi"), allowMissingColumns=True)

    def lines_by_order(self) -> DataFrame:
        """The lines of every order at the newest version."""
        head = self.tables.head()
        alive = self.tables.current("lines", head).filter(_alive())
        return line_rows(self._all_parts("line_chunks", alive, head, "order_total"))

    def customer_refs(self) -> DataFrame:
        """The customer references of every order at the newest version."""
        head = self.tables.head()
        standing = self.tables.current("orders", head).filter(_alive()).select("order_id")
        return ref_rows(self._all_parts("ref_chunks", self.tables.current("refs", head), head), standing)

    def changes(self) -> DataFrame:
        """All rows the view ever emitted, tombstones included, with their ``commit_version``.

        They are kept for good. A consumer reads on from the last version it has seen.
        """
        return self.tables.versions("changes")


def unseen(batch: DataFrame, head: Head) -> DataFrame:
    """Events beyond the marks of their topic partitions."""
    marks = head.note(MARKS)
    if not marks:
        return batch
    known = F.create_map(*[F.lit(x) for entry in marks.items() for x in entry])
    mark = F.try_element_at(known, _partition())
    return batch.filter(F.col("kafka_offset") > F.coalesce(mark, F.lit(-1)))


def _sums() -> list[Column]:
    """Aggregates: what the line events of a batch add to the total, and the last operation among them."""
    amount = F.coalesce(F.sum(F.col("quantity") * F.col("unit_price")), F.lit(0)).cast("decimal(33,2)")
    operation = F.when(F.col("op_type").isNotNull(), F.struct(F.col("kafka_offset").alias("op_offset"), "op_type"))
    return [amount.alias("added"), F.max(operation).alias("operation")]


def _totalled(rows: DataFrame) -> DataFrame:
    """Stored totals and last operations, with what a batch brought to them."""
    total = F.coalesce("order_total", F.lit(0)) + F.coalesce("added", F.lit(0))
    later = F.col("operation").isNotNull()
    return rows.withColumns({
        "order_total": total.cast("decimal(33,2)"),
        "op_type": F.when(later, F.col("operation.op_type")).otherwise(F.col("op_type")),
        "op_offset": F.when(later, F.col("operation.op_offset")).otherwise(F.col("op_offset")),
    }).drop("added", "operation")


def line_rows(parts: DataFrame) -> DataFrame:
    """Rows of ``lines_by_order`` from parts, which carry the total of their order; part 0 tells it."""
    total = F.when(F.col("part") == 0, F.col("order_total")).alias("order_total")
    return parts.select("order_id", F.col("part").alias("lines_part"), F.col("items").alias("lines"), total)


def ref_rows(parts: DataFrame, standing: DataFrame) -> DataFrame:
    """Rows of ``order_customer_refs`` from parts; part 0 stands even without a reference."""
    first = standing.withColumn("part", F.lit(0).cast("long"))
    return (
        parts.join(standing, "order_id", "left_semi")
        .join(first, ["order_id", "part"], "full")
        .select(
            "order_id",
            F.col("part").alias("refs_part"),
            F.array_sort(F.coalesce("items", F.array().cast("array<string>"))).alias("customer_refs"),
        )
    )

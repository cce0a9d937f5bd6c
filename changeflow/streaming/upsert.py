"""The upsert job: micro-batches of order events onto the warehouse tables.

A micro-batch is cut into batches of relevant records, all of which are applied in one go
against one pinned version of the tables; it ends by creating the manifest. Events that are
not applied are stored beside, with the reason, under the same commit, and so are the
counts of events read, skipped and flushed. Only when this returns does the stream record
its offsets.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow import schemas
from changeflow.operators import apply, events, resolve
from changeflow.settings import UpsertSettings
from changeflow.sources.clustered import among, few_values
from changeflow.streaming.kept import BROADCAST_BYTES, Kept, measured
from changeflow.streaming.outbox import Outbox
from changeflow.streaming.tables import (
    BUCKET, GATHER_EVERY, Attempt, Head, Table, TableSet, batch_source, bucket_of,
)

#: What one change of a link looks like in the log of the links table.
LINK_CHANGES = T.StructType([*schemas.LINKS.fields, T.StructField("op_type", T.StringType())])

#: What is kept of an event that was not applied.
REJECTS = schemas.struct(
    kafka_partition=schemas.INT, kafka_offset=schemas.LONG, order_id=schemas.TEXT, op_type=schemas.TEXT,
    link_origin=schemas.TEXT, reject_reason=schemas.TEXT, counted=T.BooleanType(),
)

WAREHOUSE = {
    "customers_backfill": Table(schemas.CUSTOMERS),
    "order_customer_candidates": Table(schemas.CANDIDATES, apply.ORDER_KEY),
    "order_customer_candidates_history": Table(schemas.CANDIDATES),
    "order_customer_links": Table(LINK_CHANGES, apply.ORDER_KEY, "op_type <=> 'D'"),
    "order_customer_links_history": Table(schemas.LINKS),
    "rejects": Table(REJECTS),
}

#: Counts of a source since its first batch, committed with every batch.
COUNTERS = "counters"

Reference = Callable[[], DataFrame]


@dataclass(frozen=True)
class References:
    """The tables loaded by others, read afresh for every batch."""

    orders: Reference
    sources: Reference
    customers: Reference
    #: Buckets the orders are partitioned by (see ``bucketed``), or zero.
    order_buckets: int = 0


def bucketed(orders: DataFrame, buckets: int) -> DataFrame:
    """Orders with the column to partition them by, so a batch reads few of them.

    Write the result with ``partitionBy("id_bucket")``.
    """
    return orders.withColumn(BUCKET, bucket_of(F.col("id"), buckets)).hint("rebalance", BUCKET)


class Warehouse:
    """The tables the upsert maintains, as they stand at one version."""

    def __init__(self, spark: SparkSession, root: str, gather_every: int = GATHER_EVERY) -> None:
        self.tables = TableSet(spark, root, WAREHOUSE, gather_every)

    def backfilled_customers(self, head: Head | None = None) -> DataFrame:
        return self.tables.appended("customers_backfill", head)

    def candidates_history(self, head: Head | None = None) -> DataFrame:
        return self.tables.appended("order_customer_candidates_history", head)

    def links_history(self, head: Head | None = None) -> DataFrame:
        return self.tables.appended("order_customer_links_history", head)

    def candidates(self, head: Head | None = None) -> DataFrame:
        """Per order, the candidate set of the last batch that brought one."""
        return self.tables.current("order_customer_candidates", head)

    def links(self, head: Head | None = None) -> DataFrame:
        """At most one link per order: its last change, unless that removed it."""
        return apply.standing_links(self.tables.current("order_customer_links", head))

    def rejects(self, head: Head | None = None) -> DataFrame:
        """The events that were not applied: where they lie in the topic, and why."""
        return self.tables.appended("rejects", head)

    def counters(self, source: str, head: Head | None = None) -> dict[str, int]:
        """Events read and skipped, batches flushed; a redelivered micro-batch counts once."""
        nothing = {"read": 0, "skipped": 0, "flushes": 0}
        return nothing | (head or self.tables.head()).note(COUNTERS).get(source, {})


def applied_rows(missing: DataFrame, stage: DataFrame) -> dict[str, DataFrame]:
    """What the steps add to each table, from the stage of one batch or of several."""
    proposals = apply.candidate_rows(stage)
    return {
        "customers_backfill": missing,
        "order_customer_candidates_history": proposals,
        "order_customer_candidates": apply.last_batch_of(proposals),
        "order_customer_links_history": apply.link_history_rows(stage),
        "order_customer_links": apply.last_operations(stage),
    }


class UpsertSink:
    """Applies one micro-batch of decoded events; pass it to ``foreachBatch``.

    ``publish`` receives the applied rows that ``consumer`` has not seen, once they are
    committed. It sees all of them, whoever wrote them, and after a crash some again.

    Events may have a ``decode_status``: those that did not decode are rejected for it.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        references: References,
        source: str,
        settings: UpsertSettings = UpsertSettings(),
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
        publish: Callable[[DataFrame], None] | None = None,
        consumer: str = "topic",
    ) -> None:
        self.warehouse = warehouse
        self.references = references
        self.source = source
        self.settings = settings
        self.clock = clock
        self.publish = publish
        self.outbox = Outbox(warehouse.tables, "order_customer_links_history", consumer)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        source = batch_source(self.source, batch)
        attempt = self.warehouse.tables.begin()
        if not attempt.head.holds(source, batch_id):
            self._flush(batch, batch_id, source, attempt)
        if self.publish:
            self.outbox.deliver(self.publish)

    def _flush(self, batch: DataFrame, batch_id: int, source: str, attempt: Attempt) -> None:
        tables = self.warehouse.tables
        status = "decode_status" if "decode_status" in batch.columns else None
        with Kept() as keep:
            batch = keep(batch)
            reason = events.reject_reason(F.col(status) if status else None).alias("reason")
            counts = {r[0]: r[1] for r in batch.groupBy(reason).count().collect()}
            if not counts:
                return
            relevant, rows = counts.get(None, 0), {}
            if len(counts) > (None in counts):
                rows["rejects"] = events.rejected(batch, status)
            if relevant:
                decoded = batch.filter(F.col(status) == events.DECODED) if status else batch
                rows |= self._applied(events.normalised(events.relevant(decoded)), relevant, attempt, keep)
            tables.write_all(rows, attempt)
            tables.gather(attempt)
            counters = attempt.head.note(COUNTERS)
            counters[self.source] = self._counted(counters.get(self.source, {}), counts, relevant)
            tables.commit(attempt, source, batch_id, counters=counters)

    def _counted(self, before: dict[str, int], counts: dict[str | None, int], relevant: int) -> dict[str, int]:
        skipped = sum(n for why, n in counts.items() if why is not None and why not in events.UNCOUNTED)
        flushes = -(-relevant // (self.settings.batch_size or max(1, relevant)))
        added = {"read": sum(counts.values()), "skipped": skipped, "flushes": flushes}
        return {name: before.get(name, 0) + n for name, n in added.items()}

    def _applied(self, records: DataFrame, count: int, attempt: Attempt, keep: Kept) -> dict[str, DataFrame]:
        size = self.settings.batch_size
        if size and count > size:
            records = events.batches_by_relevance(records, size)
        else:
            records = records.withColumn("batch_no", F.lit(0).cast("bigint"))
        records = keep(resolve.distinct_records(records, positions=True))
        small = measured(records)[1] <= BROADCAST_BYTES
        applied_at = F.lit(self.clock())
        catalog = (
            self.references.customers()
            .select(*schemas.CUSTOMERS.names)
            .unionByName(self.warehouse.backfilled_customers(attempt.head))
        )
        if small:
            # One pass over each reference table, and no shuffle of either.
            catalog = keep(self._named_customers(catalog, records))
        missing = keep(
            resolve.missing_customers(records, catalog, self.settings, applied_at)
        )
        stage = keep(
            resolve.resolved(
                F.broadcast(records) if small else records,
                self._orders(records),
                self.references.sources(),
                resolve.with_missing(catalog, missing),
                self.settings,
                applied_at,
            )
        )
        stage.count()
        return applied_rows(missing, stage)

    def _orders(self, records: DataFrame) -> DataFrame:
        """The orders, less the files and partitions no record of the batch can match."""
        orders, buckets = self.references.orders(), self.references.order_buckets
        ids = few_values(records.select("order_id"))
        if ids is not None:
            orders = orders.filter(among(F.col("id"), ids))
        if not buckets:
            return orders
        bucket = bucket_of(F.col("order_id"), buckets).alias("bucket")
        touched = [row.bucket for row in records.select(bucket).distinct().collect()]
        return orders.filter(F.col(BUCKET).isin(touched))

    def _named_customers(self, catalog: DataFrame, records: DataFrame) -> DataFrame:
        """Catalog rows that hold a reference of a small batch, or its identifier."""
        refs = records.filter(F.col("customer_ref").isNotNull()).select("customer_ref").distinct()
        catalog = self._near(catalog, refs)
        by_ref = refs.select(
            F.col("customer_ref").alias("external_customer_id"), F.lit(True).alias("same_ref")
        )
        by_id = refs.select(
            resolve.customer_id(F.col("customer_ref")).alias("id"), F.lit(True).alias("same_id")
        )
        return (
            catalog.filter(F.col("source_id") == self.settings.catalog_source_id)
            .join(F.broadcast(by_ref), "external_customer_id", "left")
            # A row may hold the identifier of a reference under another reference.
            .join(F.broadcast(by_id), "id", "left")
            .filter(F.col("same_ref") | F.col("same_id"))
            .select(*catalog.columns)
        )

    def _near(self, catalog: DataFrame, refs: DataFrame) -> DataFrame:
        """Less the row groups that hold none of a batch's few references, nor their identifiers."""
        values = few_values(refs)
        if values is None:
            return catalog
        wanted: Column = among(F.col("external_customer_id"), values)
        ids = few_values(refs.select(resolve.customer_id(F.col("customer_ref")).alias("id")))
        return catalog.filter(wanted | among(F.col("id"), ids))


def start_upsert(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, **trigger
) -> StreamingQuery:
    """Start the job. ``trigger`` is what ``DataStreamWriter.trigger`` takes."""
    writer = events.observed(stream).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()

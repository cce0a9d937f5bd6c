"""A job beside the others that reports where a topic does not keep to its keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow import schemas
from changeflow.operators.ordering import known_after, violations
from changeflow.streaming.kept import BROADCAST_BYTES, Kept, measured
from changeflow.streaming.tables import GATHER_EVERY, Table, TableSet, batch_source

KNOWN = schemas.struct(key=schemas.TEXT, home=schemas.INT, reached=schemas.LONG)
FOUND = schemas.struct(
    key=schemas.TEXT, kafka_partition=schemas.INT, kafka_offset=schemas.LONG,
    violation=schemas.TEXT, home=schemas.INT, reached=schemas.LONG,
)
BUCKETS = 1024


class KeyGuard:
    """Where each key is at home and how far it has come, across batches and restarts."""

    def __init__(
        self, spark: SparkSession, root: str, key: str, gather_every: int = GATHER_EVERY, buckets: int = BUCKETS
    ) -> None:
        self.key = key
        known = Table(KNOWN, ("key",), lookup="key", buckets=buckets)
        self.tables = TableSet(spark, root, {"known": known, "violations": Table(FOUND)}, gather_every)

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(
            lambda batch, batch_id: self.apply(batch, batch_id, checkpoint)
        ).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def apply(self, batch: DataFrame, batch_id: int, source: str) -> None:
        """Report the violations of a batch, and note how far its keys have come."""
        source = batch_source(source, batch)
        attempt = self.tables.begin()
        if attempt.head.holds(source, batch_id):
            return
        with Kept() as keep:
            events = keep(batch.select(F.col(self.key).alias("key"), *schemas.POSITION.names))
            keys = keep(events.filter("key IS NOT NULL").select("key").distinct())
            count, size = measured(keys)
            if count:
                wanted = F.broadcast(keys) if size <= BROADCAST_BYTES else keys
                touched = self.tables.touched("known", keys, attempt.head)
                known = keep(self.tables.current("known", attempt.head, touched).join(wanted, "key", "left_semi"))
                rows = {"known": known_after(known, events, "key"), "violations": violations(known, events, "key")}
                self.tables.write_all(rows, attempt)
                self.tables.gather(attempt)
            self.tables.commit(attempt, source, batch_id)

    def violations(self) -> DataFrame:
        """All events so far that broke the order of their key."""
        return self.tables.appended("violations")

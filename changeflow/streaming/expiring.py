"""Latest state whose deleted keys are forgotten after a while.

A state that keeps the last non-null value of every column has to remember a deleted key,
for the key may come back; left alone it grows with every key there ever was. Here a
tombstone is kept for a horizon: a key revived within it still shows its older values where
the new ones are null, one revived later starts from nothing. Event times decide which.
Tombstones of keys that do not come back are forgotten a horizon after they arrived, by the
arrival of the batch before; they leave the files when their bucket is gathered next.

The state is a table like others, read by the buckets of a batch's keys and committed with
the changes, so a batch is a handful of plans over all its keys, however many they are.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow import schemas
from changeflow.streaming.kept import BROADCAST_BYTES, Kept, measured
from changeflow.streaming.latest import LatestTable
from changeflow.streaming.tables import GATHER_EVERY, Head, Table, batch_source

#: When the delete that stands happened, in event time, and when a key was touched last, in
#: the time of the job: milliseconds both. The latter is also noted of the last batch.
DELETED, ARRIVED = "deleted_at", "arrived_at"
BUCKETS = 64


def folded(
    before: DataFrame, events: DataFrame, keys: Sequence[str], columns: Sequence[str], horizon_ms: int
) -> DataFrame:
    """Per key its latest values, its last operation, and when that was if it was a delete.

    ``before`` has one row at most of a key, which goes before its ``events``; those are
    taken in the order of their offsets. An event more than the horizon after the delete that
    stands begins a new life of its key: of a column the last non-null value in the last life
    counts, and so it is with the operation.
    """
    carried, position = [*keys, *columns, "op_type"], schemas.POSITION.names
    nothing = [F.lit(None).cast("long").alias(c) for c in ("op_ts", *position)]
    deleted = F.when(F.col("op_type") == "D", F.col("op_ts").cast("long")).alias(DELETED)
    rows = before.select(*carried, DELETED, *nothing, F.lit(False).alias("_new")).unionByName(
        events.select(*carried, deleted, "op_ts", *position, F.lit(True).alias("_new"))
    )
    order = Window.partitionBy(*keys).orderBy("_new", *[F.col(c).asc_nulls_last() for c in position[::-1]])
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    stands = F.when(F.col("op_type").isNotNull(), F.struct(DELETED))
    rows = rows.select(
        "*",
        F.row_number().over(order).alias("_no"),
        F.last(stands, ignorenulls=True).over(earlier)[DELETED].alias("_stands"),
        F.count("op_type").over(earlier).alias("_ops"),
    )
    late = F.coalesce(F.col("op_ts") > F.col("_stands") + horizon_ms, F.lit(False))
    # of the events up to the next operation the first late one has ended the delete
    ended = F.last(F.when(late, F.col("_ops")), ignorenulls=True).over(earlier)
    rows = rows.withColumn("_begins", late & ~ended.eqNullSafe(F.col("_ops")))
    life = F.sum(F.col("_begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_life", life)

    def last(name: str, *beside: str):
        told = F.col(name).isNotNull()
        return F.max_by(F.struct("_life", name, *beside), F.when(told, F.col("_no"))).alias(f"_{name}")

    def value(name: str, of: str):
        return F.when(F.col(f"_{of}._life") == F.col("_last_life"), F.col(f"_{of}.{name}")).alias(name)

    ends = rows.groupBy(*keys).agg(
        F.max("_life").alias("_last_life"), *[last(c) for c in columns], last("op_type", DELETED)
    )
    return ends.select(*keys, *[value(c, c) for c in columns], *[value(c, "op_type") for c in ("op_type", DELETED)])


class ExpiringLatestTable(LatestTable):
    """A table with one row per live key, whose state forgets deleted keys after a horizon.

    A column keeps its last non-null value. Events carry ``op_ts`` in milliseconds. ``clock``
    gives the seconds at which a batch arrives.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        event: T.StructType,
        keys: Sequence[str],
        columns: Sequence[str],
        horizon_ms: int,
        gather_every: int = GATHER_EVERY,
        buckets: int = BUCKETS,
        clock: Callable[[], float] = time.time,
        **publishing,
    ) -> None:
        super().__init__(spark, root, event, keys, columns, gather_every, **publishing)
        self.horizon_ms, self.clock = horizon_ms, clock
        times = [T.StructField(name, T.LongType()) for name in (DELETED, ARRIVED)]
        state = T.StructType([*self.state_schema.fields, *times])
        self.tables.tables["state"] = Table(state, tuple(self.keys), lookup=self.keys[0], buckets=buckets)

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(
            lambda batch, batch_id: self.apply(batch, batch_id, checkpoint)
        ).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def apply(self, batch: DataFrame, batch_id: int, source: str) -> None:
        """Append the state of the keys that the events of a micro-batch touch, and commit."""
        source = batch_source(source, batch)
        attempt = self.tables.begin()
        if not attempt.head.holds(source, batch_id):
            now, forgotten = int(self.clock() * 1000), self._forgotten(attempt.head)
            with Kept() as keep:
                used = [*self.keys, *self.columns, "op_type", "op_ts", *schemas.POSITION.names]
                events = keep(batch.dropna("all", subset=self.keys).select(*used))
                keys = keep(events.select(*self.keys).distinct())
                count, size = measured(keys)
                if count:
                    before = self._before(attempt.head, keys, size, forgotten)
                    after = folded(before, events, self.keys, self.columns, self.horizon_ms)
                    after = keep(after.withColumn(ARRIVED, F.lit(now).cast("long")))
                    self.tables.write_all({"state": after, "changes": after}, attempt)
                self.tables.gather(attempt, state=forgotten)
                self.tables.commit(attempt, source, batch_id, **{ARRIVED: {"last": now}})
        if self.publish:
            self.outbox.deliver(self.publish)

    def _before(self, head: Head, keys: DataFrame, size: int, forgotten: str) -> DataFrame:
        """What is remembered of a batch's keys."""
        touched = self.tables.touched("state", keys, head, self.keys[0])
        known = self.tables.current("state", head, touched).filter(f"NOT ({forgotten})")
        wanted = keys.toDF(*[f"_{k}" for k in self.keys])
        # part of a key may be null
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        return known.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, same, "left_semi")

    def _forgotten(self, head: Head) -> str:
        """Which rows (SQL) of the state are forgotten after the last batch."""
        last = head.note(ARRIVED).get("last")
        return "false" if last is None else f"{DELETED} IS NOT NULL AND {ARRIVED} + {self.horizon_ms} < {last}"

    def current(self) -> DataFrame:
        """The live keys: last change per key, deletes removed."""
        return super().current().select(*self.state_schema.names)

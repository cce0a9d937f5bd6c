"""Latest state of a change stream as a keyed table, kept current with tombstones."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.compaction import compacted
from changeflow.operators.latest import latest
from changeflow.streaming.outbox import Outbox, seen_by_all
from changeflow.streaming.tables import GATHER_EVERY, VERSION, Table, TableSet, batch_source

#: Keeps the state of a key on disk rather than in the memory of an executor.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LatestTable:
    """A table with one row per live key, maintained from a changelog.

    ``publish`` receives the changed keys once they are committed, all that the consumer it
    stands for has not seen; after a crash in between it receives them again.

    The streaming aggregate emits every key that changed, deleted ones included: a
    filter before the sink would say nothing when a key is deleted, and the stale
    row would stay.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        event: T.StructType,
        keys: Sequence[str],
        columns: Sequence[str],
        gather_every: int = GATHER_EVERY,
        publish: Callable[[DataFrame], None] | None = None,
        consumer: str = "topic",
    ) -> None:
        self.publish = publish
        self.spark = spark
        self.keys = list(keys)
        self.columns = list(columns)
        state = T.StructType([event[name] for name in (*keys, *columns, "op_type")])
        self.state_schema = state
        tables = {"state": Table(state, tuple(self.keys), "op_type <=> 'D'"), "changes": Table(state)}
        self.tables = TableSet(spark, root, tables, gather_every)
        self.outbox = Outbox(self.tables, "changes", consumer)

    def changelog(self, stream: DataFrame, ignore_nulls: bool = False) -> DataFrame:
        """The running latest state of the keys each micro-batch touches."""
        return latest(
            stream, self.keys, self.columns, ignore_nulls=ignore_nulls, keep_deleted=True
        )

    def start(
        self, stream: DataFrame, checkpoint: str, ignore_nulls: bool = False, **trigger
    ) -> StreamingQuery:
        self.spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        writer = (
            self.changelog(stream, ignore_nulls)
            .writeStream.outputMode("update")
            .foreachBatch(lambda changes, batch_id: self.apply(changes, batch_id, checkpoint))
            .option("checkpointLocation", checkpoint)
        )
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def apply(self, changes: DataFrame, batch_id: int, source: str) -> None:
        """Append the changed keys of one micro-batch and commit."""
        source = batch_source(source, changes)
        attempt = self.tables.begin()
        if not attempt.head.holds(source, batch_id):
            # a batch with state behind it runs once; the second table is read off the first
            self.tables.write("changes", changes, attempt)
            self.tables.write("state", self.tables.attempted("changes", attempt), attempt)
            self.tables.gather(attempt)
            self.tables.commit(attempt, source, batch_id)
        if self.publish:
            self.outbox.deliver(self.publish)

    def changes(self) -> DataFrame:
        """The whole changelog, tombstones included, with each row's ``commit_version``.

        It is kept until it is compacted. A consumer reads on from the last version it has seen.
        """
        return self.tables.versions("changes")

    def compact(self, horizon: int) -> int:
        """Leave of the changelog what a reader from its start needs; returns the clean point.

        Below the version that all consumers have seen, the last change of each key remains,
        deletes among them for ``horizon`` more versions. Versions stay as they are. The
        tables change by a commit of their own; of two writers at work one fails.
        """
        attempt = self.tables.begin()
        clean = seen_by_all(attempt.head, "changes")
        below = self.tables.versions("changes", attempt.head, upto=clean)
        expired = F.col(VERSION) <= clean - horizon
        rows = compacted(below, self.keys, F.lit(True), expired, [VERSION])
        if self.tables.rewrite("changes", rows, clean, attempt):
            self.tables.commit(attempt)
        return clean

    def current(self) -> DataFrame:
        """The live keys: last change per key, deletes removed."""
        return self.tables.current("state").filter(F.col("op_type") != "D")

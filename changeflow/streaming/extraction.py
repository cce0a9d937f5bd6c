"""Repeated extraction of source tables into their topics, each from its bookmark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import schemas
from changeflow.sources.extract import Bookmark, changed_rows, changes_up_to, next_bookmark, topic_name
from changeflow.streaming.tables import GATHER_EVERY, Table, TableSet

BOOKMARKS = schemas.struct(source_table=schemas.TEXT, updated_at=schemas.TIME, row_id=schemas.LONG)


class Extraction:
    """Extracts what changed in a table since its last run.

    ``deliver`` receives the topic and the changed rows, and returns once they are
    stored. The bookmark moves afterwards, so a crash in between delivers the rows
    again rather than not at all.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        deliver: Callable[[str, DataFrame], None],
        environment: str = "dev",
        gather_every: int = GATHER_EVERY,
    ) -> None:
        self.spark = spark
        self.deliver = deliver
        self.environment = environment
        self.tables = TableSet(spark, root, {"bookmarks": Table(BOOKMARKS, ("source_table",))}, gather_every)

    def bookmark(self, name: str) -> Bookmark | None:
        row = (
            self.tables.current("bookmarks")
            .filter(F.col("source_table") == name)
            .first()
        )
        return row and Bookmark(row.updated_at, row.row_id)

    def run(
        self, name: str, table: DataFrame, updated_at: str = "updated_at", row_id: str = "id"
    ) -> Bookmark | None:
        """Deliver the changes of one table; returns its new bookmark, if it moved.

        The last change is found first, so rows that arrive while the others are read
        wait for the next run instead of being skipped. The first run delivers rows
        without an update time as well.
        """
        topic = topic_name(name, self.environment)
        mark = self.bookmark(name)
        changes = changed_rows(table, mark, updated_at, row_id)
        last = next_bookmark(changes, updated_at, row_id)
        if last is None:
            return None
        self.deliver(topic, changes_up_to(changes, last, updated_at, row_id))
        attempt = self.tables.begin()
        moved = [(name, last.updated_at, last.row_id)]
        self.tables.write("bookmarks", self.spark.createDataFrame(moved, BOOKMARKS), attempt)
        self.tables.gather(attempt)
        run_number = attempt.head.applied.get(name, -1) + 1
        self.tables.commit(attempt, name, run_number)
        return last

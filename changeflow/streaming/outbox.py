"""Handing the rows of a table on to others: each consumer has a cursor, kept with the tables.

A consumer reads the versions between its cursor and the newest one, whoever wrote them, and
its cursor moves once it has stored them. Rows are never taken from where a crash or another
writer's gathering could have moved them: a table's rows keep their version for good. So
nothing is lost, and what was handed on before a crash but not yet noted is handed on again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from changeflow.streaming.tables import Head, TableSet

CURSORS = "cursors"


@dataclass(frozen=True)
class Outbox:
    """What a consumer of a table has not seen yet."""

    tables: TableSet
    table: str
    consumer: str

    @property
    def cursor(self) -> str:
        return f"{self.table}/{self.consumer}"

    def position(self, head: Head) -> int:
        """The last version the consumer has stored."""
        return head.note(CURSORS).get(self.cursor, 0)

    def pending(self, head: Head) -> int | None:
        """The newest version with rows the consumer has not seen."""
        last = max((p.last for p in head.parts.get(self.table, [])), default=0)
        return last if last > self.position(head) else None

    def deliver(self, publish: Callable[[DataFrame], None]) -> int | None:
        """Hand on what there is, then move the cursor; returns where it stands if it moved."""
        head = self.tables.head()
        last = self.pending(head)
        if last is None:
            return None
        publish(self.tables.versions(self.table, head, after=self.position(head)))
        # another delivery of the same consumer may have been faster
        self.tables.noted(CURSORS, lambda kept: kept | {self.cursor: max(last, kept.get(self.cursor, 0))})
        return last

    def start_here(self) -> None:
        """Leave what there is to others: the consumer sees later versions only."""
        last = self.pending(self.tables.head())
        if last is not None:
            self.tables.noted(CURSORS, lambda kept: kept | {self.cursor: max(last, kept.get(self.cursor, 0))})


def seen_by_all(head: Head, table: str) -> int:
    """The last version that every consumer of a table has stored; the newest if it has none."""
    own = [at for cursor, at in head.note(CURSORS).items() if cursor.rpartition("/")[0] == table]
    return min(own, default=head.version)

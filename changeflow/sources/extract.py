"""Incremental extraction of source tables into change topics."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The tables extracted and the prefix of their topics.
TABLES = ("orders", "order_lines", "customers")
TOPIC_PREFIX = "cdc.{env}."


@dataclass(frozen=True)
class Bookmark:
    """The last row already extracted: its update time and its id."""

    updated_at: datetime
    row_id: int


#: Before every update time a row may have.
BEGINNING = Bookmark(datetime(1000, 1, 1), -(1 << 63))


def topic_name(table: str, environment: str = "dev") -> str:
    """Topic of a listed table; other tables are not extracted."""
    if table not in TABLES:
        raise ValueError(f"{table!r} is not one of the extracted tables {TABLES}")
    return TOPIC_PREFIX.format(env=environment) + table


def after(bookmark: Bookmark, updated_at: str, row_id: str) -> Column:
    """Rows past the bookmark in (time, id) order.

    The time bound stands alone as well, so the scan can skip files and row groups.
    """
    ts, key = F.col(updated_at), F.col(row_id)
    mark = F.lit(bookmark.updated_at)
    return (ts >= mark) & ((ts > mark) | (key > bookmark.row_id))


def changed_rows(
    table: DataFrame,
    bookmark: Bookmark | None,
    updated_at: str = "updated_at",
    row_id: str = "id",
) -> DataFrame:
    """Every row changed since the bookmark, in one partition-parallel read.

    Without a bookmark the whole table is read, rows without an update time included.
    These have no place after a bookmark: once there is one they are not seen, and
    neither are deleted rows, which leave no trace in the table. ``table`` may be a JDBC relation: the bound is pushed to
    the database, and its ``partitionColumn`` options set the parallelism.
    """
    return table if bookmark is None else table.filter(after(bookmark, updated_at, row_id))


def changes_up_to(
    changes: DataFrame, last: Bookmark, updated_at: str = "updated_at", row_id: str = "id"
) -> DataFrame:
    """The changes up to and including a bookmark, and those without an update time."""
    beyond = F.coalesce(after(last, updated_at, row_id), F.lit(False))
    return changes.filter(~beyond)


def next_bookmark(
    changes: DataFrame, updated_at: str = "updated_at", row_id: str = "id"
) -> Bookmark | None:
    """The bookmark after these changes; None where nothing changed.

    Rows without an update time move it to the beginning at most.
    """
    timed = F.when(F.col(updated_at).isNotNull(), F.struct(updated_at, row_id))
    found = changes.agg(F.max(timed).alias("last"), F.count("*").alias("n")).first()
    if found["last"] is None:
        return BEGINNING if found["n"] else None
    last_id = found["last"][row_id]
    return Bookmark(found["last"][updated_at], BEGINNING.row_id if last_id is None else last_id)

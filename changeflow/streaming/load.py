"""A whole log at once: the first load of the warehouse, or a catch-up.

Streaming a long history batch by batch takes as many commits as it has batches. Here all
batches of the log are resolved in one pass, and the tables receive, in one commit, what
applying the batches in turn would have left.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.operators import resolve
from changeflow.session import remove, scratch_dir
from changeflow.settings import UpsertSettings
from changeflow.streaming.upsert import References, Warehouse, applied_rows


def load_log(
    warehouse: Warehouse,
    references: References,
    records: DataFrame,
    source: str,
    applied_at: datetime,
    settings: UpsertSettings = UpsertSettings(),
) -> None:
    """Apply normalised records with their ``batch_no`` on top of the tables.

    The stage is written to the shared folder once and read by every table, so the
    joins run once and a lost executor repeats its own part only. Loading the same
    source again does nothing.
    """
    tables = warehouse.tables
    attempt = tables.begin()
    head = attempt.head
    if head.holds(source, 0):
        return
    now = F.lit(applied_at)
    customers = references.customers()
    catalog = customers.unionByName(
        warehouse.backfilled_customers(head).select(*customers.columns)
    )
    args = (references.orders(), references.sources(), catalog, settings, now)
    path = scratch_dir(tables.spark, "stage")
    try:
        resolve.staged(records, *args, positions=True).write.parquet(path)
        stage = tables.spark.read.parquet(path)
        missing = resolve.missing_customers(
            resolve.distinct_records(records), catalog, settings, now
        )
        tables.write_all(applied_rows(missing, stage), attempt)
        tables.commit(attempt, source, 0)
    finally:
        remove(tables.spark, path)

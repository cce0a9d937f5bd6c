"""Steps three to six: histories, current candidates and current links.

The replay of a batch onto the links is a reduction, not a loop. Every operation
first removes the link of its order, so what remains depends on the last operation
alone: an insert leaves its row, a delete leaves none. The audit rows come from the
stage and lose nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow import schemas
from changeflow.functions.values import ACTION_INSERT, audit_action, op_rank
from changeflow.operators.resolve import (
    POSITION_COLUMNS,
    distinct_records,
    missing_customers,
    one_per_reference,
    resolved,
    with_missing,
)
from changeflow.settings import UpsertSettings

ORDER_KEY = ("order_source_id", "order_id")
CANDIDATE_COLUMNS = tuple(schemas.CANDIDATES.names)
LINK_COLUMNS = tuple(schemas.LINKS.names)


def candidate_rows(stage: DataFrame) -> DataFrame:
    """Step three: every staged insert as a candidate row."""
    return (
        stage.filter(F.col("op_type") == "I")
        .withColumn("audit_action", F.lit(ACTION_INSERT))
        .withColumn("audit_action_status", F.lit("DONE"))
        .select(*CANDIDATE_COLUMNS, *_kept(stage, "batch_no"))
    )


def link_history_rows(stage: DataFrame) -> DataFrame:
    """Step five: inserts and deletes, the latter also when they removed nothing."""
    return (
        stage.filter(F.col("op_type").isin("D", "I"))
        .withColumn("audit_action", audit_action(F.col("op_type")))
        .withColumn("audit_action_at", F.col("updated_at"))
        .withColumn("audit_action_status", F.lit("DONE"))
        .select(*LINK_COLUMNS, *_kept(stage, "batch_no"))
    )


def last_batch_of(proposals: DataFrame) -> DataFrame:
    """Per order, the candidate rows of its last batch."""
    keys = [*ORDER_KEY, "batch_no"]
    last = proposals.groupBy(*ORDER_KEY).agg(F.max("batch_no").alias("batch_no"))
    return proposals.join(last, keys, "left_semi").select(*CANDIDATE_COLUMNS)


def refreshed_candidates(previous: DataFrame, stage: DataFrame) -> DataFrame:
    """Step four: replace the candidate set of every order with a staged insert."""
    fresh = candidate_rows(stage).select(*CANDIDATE_COLUMNS)
    survivors = previous.join(fresh.select(*ORDER_KEY).distinct(), list(ORDER_KEY), "left_anti")
    return survivors.select(*CANDIDATE_COLUMNS).unionByName(fresh)


def _kept(frame: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in frame.columns]


def _sort_key(created_at: Column, precision: str) -> list[Column]:
    """Replay order inside a batch: instant, then deletes before inserts.

    Instants are seconds unless ``precision`` is ``"ms"``. The topic position only
    refines ties the order leaves open.
    """
    if precision not in ("second", "ms"):
        raise ValueError(f"precision must be 'second' or 'ms', not {precision!r}")
    position = [F.col(f"position.{c}").alias(c) for c in POSITION_COLUMNS]
    instant = F.col("position.op_ts") if precision == "ms" else created_at
    return [instant.alias("instant"), op_rank(F.col("op_type")).alias("rank"), *position]


def replay_order(stage: DataFrame) -> DataFrame:
    """Number the staged operations of an order in the order they are replayed.

    Operations are ranked within batch and order, so a window group never exceeds
    one batch however often the order occurs overall.
    """
    keys = ["batch_no", *ORDER_KEY]
    order = [*_sort_key(F.col("created_at"), "second"), F.col("customer_id")]
    window = Window.partitionBy(*keys).orderBy(*order)
    return stage.filter(F.col("op_type").isin("D", "I")).withColumn(
        "replay_no", F.row_number().over(window)
    )


def last_operations(stage: DataFrame, precision: str = "second") -> DataFrame:
    """The last staged operation of every touched order, as a link row.

    Carries ``op_type``: ``I`` is the link that stands, ``D`` says there is none.
    """
    payload = [
        c for c in LINK_COLUMNS if c not in (*ORDER_KEY, "customer_id") and c in stage.columns
    ]
    order = F.struct(
        *_kept(stage, "batch_no"),
        *_sort_key(F.col("created_at"), precision),
        "customer_id",
        "op_type",
        *payload,
    )
    rows = (
        stage.filter(F.col("op_type").isin("D", "I"))
        .groupBy(*ORDER_KEY)
        .agg(F.max(order).alias("last"))
        .select(*ORDER_KEY, "last.customer_id", "last.op_type", *[f"last.{c}" for c in payload])
    )
    return _link_rows(rows)


def _link_rows(rows: DataFrame) -> DataFrame:
    return (
        rows.withColumn("audit_action", F.lit(ACTION_INSERT))
        .withColumn("audit_action_at", F.col("updated_at"))
        .withColumn("audit_action_status", F.lit("DONE"))
        .select(*LINK_COLUMNS, "op_type")
    )


def standing_links(last: DataFrame) -> DataFrame:
    """Drop the operations that leave no link behind."""
    return last.filter(F.col("op_type") == "I").select(*LINK_COLUMNS)


def replayed_links(
    previous: DataFrame, stage: DataFrame, precision: str = "second"
) -> DataFrame:
    """Step six: links after the stage is replayed onto the previous ones."""
    last = last_operations(stage, precision)
    survivors = previous.join(last.select(*ORDER_KEY), list(ORDER_KEY), "left_anti")
    return survivors.select(*LINK_COLUMNS).unionByName(standing_links(last))


# --- whole logs at once -----------------------------------------------------------
# The forms below give the state after many batches without applying them one by
# one. They reduce the log per order before the joins, so the joins see one row per
# order (links) or one batch per order (candidates) instead of every event.


def links_from_log(
    records: DataFrame,
    orders: DataFrame,
    sources: DataFrame,
    customers: DataFrame,
    settings: UpsertSettings,
    applied_at: Column,
    precision: str = "second",
) -> DataFrame:
    """Links after replaying every batch of a log in turn.

    All events of an order reach the same order rows, so the last event of an order
    id decides, and only that one needs resolving. Of several catalog rows for its
    reference the greatest identifier stands, as it would be replayed last; picking
    it beforehand leaves one row per order, with nothing to reduce after the joins.
    """
    positioned = records.filter(F.col("order_id").isNotNull()).select(
        "*", F.struct(*POSITION_COLUMNS).alias("position")
    )
    order = _sort_key(F.col("op_timestamp"), precision)
    last_event = (
        positioned.groupBy("order_id")
        .agg(
            F.max(F.struct("batch_no", *order, "op_type", "customer_ref", "op_timestamp")).alias(
                "last"
            )
        )
        .select("order_id", "last.batch_no", "last.op_type", "last.customer_ref", "last.op_timestamp")
        .filter(F.col("op_type") == "I")
    )
    catalog = with_missing(
        customers, missing_customers(last_event, customers, settings, applied_at)
    )
    stage = resolved(
        last_event, orders, sources, one_per_reference(catalog), settings, applied_at
    )
    return standing_links(_link_rows(stage))


def links_by_precision(
    records: DataFrame,
    orders: DataFrame,
    sources: DataFrame,
    customers: DataFrame,
    settings: UpsertSettings,
    applied_at: Column,
) -> DataFrame:
    """Links by either precision side by side: the order, by_second and by_ms.

    One pass over the log finds the last event of an order by both, and both are resolved
    together. A customer is null where there is no link.
    """
    positioned = records.filter(F.col("order_id").isNotNull()).select(
        "*", F.struct(*POSITION_COLUMNS).alias("position")
    )
    told = ("op_type", "customer_ref", "op_timestamp")
    last = [
        F.max(F.struct("batch_no", *_sort_key(F.col("op_timestamp"), precision), *told))
        for precision in ("second", "ms")
    ]
    # the precision travels through the stage in place of the batch
    both = F.array(*[
        F.struct(F.lit(n).alias("batch_no"), *[event[c].alias(c) for c in told])
        for n, event in enumerate((F.col("by_second"), F.col("by_ms")))
    ])
    last_events = (
        positioned.groupBy("order_id")
        .agg(last[0].alias("by_second"), last[1].alias("by_ms"))
        .select("order_id", F.explode(both).alias("event"))
        .select("order_id", "event.*")
        .filter(F.col("op_type") == "I")
    )
    catalog = with_missing(
        customers, missing_customers(last_events, customers, settings, applied_at)
    )
    stage = resolved(
        last_events, orders, sources, one_per_reference(catalog), settings, applied_at
    )
    customer = [F.max(F.when(F.col("batch_no") == n, F.col("customer_id"))) for n in (0, 1)]
    return stage.groupBy(*ORDER_KEY).agg(customer[0].alias("by_second"), customer[1].alias("by_ms"))


def last_insert_batches(records: DataFrame) -> DataFrame:
    """Per order id, the last batch that holds an insert for it."""
    return (
        records.filter(F.col("op_type") == "I")
        .groupBy("order_id")
        .agg(F.max("batch_no").alias("batch_no"))
    )


def candidates_from_log(
    records: DataFrame,
    orders: DataFrame,
    sources: DataFrame,
    customers: DataFrame,
    settings: UpsertSettings,
    applied_at: Column,
) -> DataFrame:
    """Candidates after every batch of a log: the inserts of the last batch with any.

    The semi join is on order and batch, so even an order that fills much of the
    log is spread over its batches.
    """
    inserts = records.filter(F.col("op_type") == "I")
    current = inserts.join(last_insert_batches(records), ["order_id", "batch_no"], "left_semi")
    # References of superseded batches do no harm here, and finding them is one pass.
    missing = missing_customers(inserts, customers, settings, applied_at)
    catalog = with_missing(customers, missing)
    stage = resolved(distinct_records(current), orders, sources, catalog, settings, applied_at)
    return candidate_rows(stage).select(*CANDIDATE_COLUMNS)

"""Steps one and two of the upsert: backfill customers, then stage the batch.

``records`` are normalised events with a ``batch_no`` (a literal for a single
micro-batch). Both steps reduce the records with partial aggregation before any
join, so a key that holds much of the input is collapsed on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.keys import CATALOG, customer_hash, customer_id
from changeflow.settings import UpsertSettings

BATCH_COLUMNS = ("batch_no", "order_id", "customer_ref", "op_type", "op_timestamp")
POSITION_COLUMNS = ("op_ts", "kafka_partition", "kafka_offset")


def operational_orders(orders: DataFrame, sources: DataFrame) -> DataFrame:
    """Orders whose source system is an operational one."""
    operational = sources.filter(F.contains("source_type", F.lit("operational"))).select(
        F.col("id").alias("source_id")
    )
    return orders.join(operational, "source_id", "left_semi")


def missing_customers(
    records: DataFrame, customers: DataFrame, settings: UpsertSettings, applied_at: Column
) -> DataFrame:
    """Placeholder rows for references the catalog does not hold yet.

    ``created_at`` is the earliest operation of the first batch that names the
    reference. Null references cannot be stored and are left out here; their
    events are still staged. Keys are digested once per reference, not per event.
    """
    first_seen = (
        records.filter(F.col("customer_ref").isNotNull())
        .groupBy("customer_ref")
        .agg(F.min(F.struct("batch_no", "op_timestamp")).alias("first"))
    )
    ref = F.col("customer_ref")
    known = customers.filter(F.col("source_id") == settings.catalog_source_id).select("id")
    return (
        first_seen.select(
            customer_id(ref).alias("id"),
            customer_hash(ref).alias("customer_hash"),
            ref.alias("external_customer_id"),
            F.lit(settings.catalog_source_id).alias("source_id"),
            F.lit(CATALOG).alias("source_name"),
            F.lit("").alias("customer_name"),
            F.lit("").alias("country_code"),
            F.lit("PENDING").alias("resolution_state"),
            F.col("first.op_timestamp").alias("created_at"),
            applied_at.alias("updated_at"),
        )
        .join(known, "id", "left_anti")
    )


def distinct_records(records: DataFrame, positions: bool = False) -> DataFrame:
    """Collapse records equal in every column the stage keeps, per batch.

    Order and customer rows are unique under their primary keys, so this is the
    DISTINCT of the staged rows, moved below the joins. With ``positions`` the
    greatest topic position of the collapsed records stays, for ordering.
    """
    if not positions:
        return records.select(*BATCH_COLUMNS).distinct()
    return records.groupBy(*BATCH_COLUMNS).agg(
        F.max(F.struct(*POSITION_COLUMNS)).alias("position")
    )


def resolved(
    records: DataFrame,
    orders: DataFrame,
    sources: DataFrame,
    customers: DataFrame,
    settings: UpsertSettings,
    applied_at: Column,
) -> DataFrame:
    """Join records to their orders (inner) and catalog customers (outer).

    An order id known to several operational sources yields a row for each, as
    does a reference the catalog holds under several ids.
    """
    order_side = operational_orders(orders, sources).select(
        F.col("id").alias("order_id"),
        F.col("source_id").alias("order_source_id"),
        F.col("source_name").alias("order_source_name"),
        "order_status",
    )
    customer_side = customers.filter(F.col("source_id") == settings.catalog_source_id).select(
        F.col("external_customer_id").alias("customer_ref"),
        F.col("id").alias("customer_id"),
        F.col("source_id").alias("customer_source_id"),
        F.col("source_name").alias("customer_source_name"),
    )
    carried = [c for c in ("batch_no", "position") if c in records.columns]
    return (
        records.join(order_side, "order_id")
        .join(customer_side, "customer_ref", "left")
        .select(
            "order_id",
            "order_source_id",
            "order_source_name",
            "order_status",
            "customer_id",
            "customer_source_id",
            "customer_source_name",
            F.lit(settings.link_score).alias("link_score"),
            F.lit(-1).alias("link_rating"),
            F.lit("manual").alias("link_method"),
            F.col("customer_ref").alias("source_customer_ref"),
            F.col("op_timestamp").alias("created_at"),
            applied_at.alias("updated_at"),
            "op_type",
            *carried,
        )
    )


def with_missing(customers: DataFrame, missing: DataFrame) -> DataFrame:
    """The catalog as step two sees it: after the backfill of step one."""
    return customers.unionByName(missing.select(*customers.columns))


def one_per_reference(customers: DataFrame) -> DataFrame:
    """Of the rows of a source that share a reference, the one with the greatest id."""
    return (
        customers.groupBy("source_id", "external_customer_id")
        .agg(F.max(F.struct("id", "source_name")).alias("row"))
        .select("source_id", "external_customer_id", "row.id", "row.source_name")
    )


def staged(
    records: DataFrame,
    orders: DataFrame,
    sources: DataFrame,
    customers: DataFrame,
    settings: UpsertSettings,
    applied_at: Column,
    positions: bool = False,
) -> DataFrame:
    """Steps one and two: one row per distinct change and matching order and customer.

    ``customers`` is the catalog before the batch. Backfill and stage read the same
    collapsed records, so Spark shuffles them once for both.
    """
    distinct = distinct_records(records, positions)
    missing = missing_customers(distinct, customers, settings, applied_at)
    catalog = with_missing(customers, missing)
    return resolved(distinct, orders, sources, catalog, settings, applied_at)

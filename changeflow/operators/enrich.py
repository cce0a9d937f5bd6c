"""The enriched order view: latest order, customer, lines and references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow import schemas
from changeflow.operators.latest import (
    CHUNK,
    latest_customers,
    latest_orders,
    lines_by_order,
    order_customer_refs,
)


def enriched_orders(
    orders: DataFrame, customers: DataFrame, lines: DataFrame, refs: DataFrame
) -> DataFrame:
    """Left joins of the latest-state tables, one row per live order.

    The customer is found through the order's own reference; the other two share
    its key. Lines and references that span several rows are paired part by part, so
    each stands once.
    """
    parts = lines.withColumn("part", F.col("lines_part")).join(
        refs.withColumn("part", F.col("refs_part")), ["order_id", "part"], "full"
    )
    return (
        orders.join(customers, "customer_ref", "left")
        .join(parts, "order_id", "left")
        .withColumnRenamed("segment", "customer_segment")
        .withColumn("order_key", F.col("order_id"))
        .withColumn("order_total", F.col("order_total").cast("decimal(33,2)"))
        .select(*schemas.ENRICHED.names)
    )


def enriched_from_logs(
    order_log: DataFrame, customer_log: DataFrame, line_log: DataFrame, chunk: int = CHUNK
) -> DataFrame:
    """The view computed straight from the three change logs."""
    return enriched_orders(
        latest_orders(order_log),
        latest_customers(customer_log),
        lines_by_order(line_log, chunk=chunk),
        order_customer_refs(order_log, chunk=chunk),
    )

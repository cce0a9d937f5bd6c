"""Seed rows of the reference tables, inserted only where still missing."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import schemas

#: The source systems.
SOURCE_ROWS = [
    (1, "storefront", "operational-web", "Public web storefront"),
    (2, "call_center", "operational-phone", "Phone ordering desk"),
    (12, "catalog", "master-catalog", "Canonical customer catalog"),
]

#: The sample orders.
SEED_ORDERS = 20
SEED_STATUS = "CONFIRMED"
SEED_DATE = date(2026, 1, 5)
SEED_TIME = datetime(2026, 1, 5, 9)


def source_rows(spark: SparkSession) -> DataFrame:
    """The fixed sources as literal rows, whose size the optimizer knows."""
    rows = F.array(*[F.struct(*[F.lit(v) for v in row]) for row in SOURCE_ROWS])
    return spark.range(1).select(F.inline(rows)).toDF(*schemas.SOURCES.names)


def seed_sources(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """Sources that are not in the table yet, each tested by its id."""
    rows = source_rows(spark)
    return rows if existing is None else rows.join(existing.select("id"), "id", "left_anti")


def seed_orders(
    spark: SparkSession, existing: DataFrame, source_id: int = 1, source_name: str = "storefront"
) -> DataFrame:
    """The sample orders of a source, unless that source has any order at all."""
    number = F.col("id").cast("string")
    orders = spark.range(1, SEED_ORDERS + 1).select(
        F.concat(F.lit("ORD-"), F.lpad(number, 4, "0")).alias("id"),
        F.concat(F.lit("EXT-"), F.lpad(number, 6, "0")).alias("external_order_id"),
        F.lit(source_id).alias("source_id"),
        F.lit(source_name).alias("source_name"),
        F.lit(SEED_STATUS).alias("order_status"),
        F.lit(SEED_DATE).alias("order_date"),
        F.lit(SEED_TIME).alias("created_at"),
        F.lit(SEED_TIME).alias("updated_at"),
    )
    present = existing.filter(F.col("source_id") == source_id).select("source_id").distinct()
    return orders.join(present, "source_id", "left_anti").select(*schemas.ORDERS.names)

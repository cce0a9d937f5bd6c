"""Change logs and reference tables derived from the star-schema tables.

Every relation covers its whole source table. The defects a change log has (absent
keys, padded references, late and tied operations) follow from column values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.sources.seeds import source_rows

REFERENCE_TIME = "2023-12-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("bigint").cast("string"), width, "0"))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order change events, one per row of ``events``.

    A day's events fall within three seconds, so an order sees ties, pairs and
    inversions inside one second.
    """
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    ref = numbered("CUST-", F.floor("value"), 6)
    kind, day = F.col("event_type"), F.date_trunc("day", F.col("ts")).cast("timestamp")
    op_ts = F.unix_millis(day) + k * 30
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 3).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.when(k == 7, None)
        .when(k == 5, numbered("NEW-", F.col("user_id"), 12))
        .otherwise(numbered("ORD-", F.col("user_id"), 12))
        .alias("order_id"),
        F.when(k == 13, None)
        .when(k.isin(21, 22), F.concat(F.lit(" "), ref, F.lit(" ")))
        .otherwise(ref)
        .alias("customer_ref"),
        F.when(k < 34, "web").when(k < 67, "phone").otherwise("partner-api").alias("channel_id"),
        F.when(kind == "view", "CONFIRMED")
        .when(kind == "click", "PICKING")
        .when(kind != "signup", "SHIPPED")
        .alias("status"),
        F.date_format("ts", "yyyy-MM-dd").alias("event_date"),
        F.when(k == 31, None).when(k >= 75, "A").otherwise("M").alias("link_origin"),
        F.when(kind == "error", "D").when(kind == "purchase", "U").otherwise("I").alias("op_type"),
        op_ts.alias("op_ts"),
        (op_ts + k).alias("current_ts"),
    )


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-line change events from ``lineitem``; line keys repeat, so versions exist."""
    day = F.datediff(F.col("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 3).cast("int").alias("kafka_partition"),
        (
            day * F.lit(100_000_000_000_000)
            + F.col("l_partkey") * 100
            + F.col("l_linenumber")
        ).alias("kafka_offset"),
        numbered("ORD-", F.col("l_orderkey"), 12).alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.when(F.col("l_tax") > 0, F.concat(F.lit("P-"), F.col("l_partkey").cast("string"))).alias(
            "product_ref"
        ),
        F.when(F.col("l_discount") > 0, F.col("l_quantity").cast("int")).alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.when(F.col("l_returnflag") == "R", "D").otherwise("I").alias("op_type"),
    )


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer change events from ``customer``; references repeat, so versions exist."""
    nation, number = F.col("c_nationkey"), F.floor(F.abs(F.col("c_acctbal")) / 50)
    return table(spark, sf_dir, "customer").select(
        (number % 3).cast("int").alias("kafka_partition"),
        F.col("c_custkey").alias("kafka_offset"),
        numbered("CUST-", number, 6).alias("customer_ref"),
        F.when(nation != 7, F.col("c_name")).alias("customer_name"),
        F.concat(F.lit("N"), nation.cast("string")).alias("country_code"),
        F.col("c_mktsegment").alias("segment"),
        F.when(nation == 11, "D").otherwise("I").alias("op_type"),
    )


def sources_reference(spark: SparkSession) -> DataFrame:
    return source_rows(spark)


def orders_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders. The priority stands for the source system; medium ones are known to a
    second system as well, low and pending ones only to the (not operational) catalog.

    Events that name unknown orders are the log's business.
    """
    priority = F.col("o_orderpriority")
    main = F.when(priority == "1-URGENT", 2).when(priority == "5-LOW", 12).otherwise(1)
    systems = (
        F.when(F.col("o_orderstatus") == "P", F.array(F.lit(12)))
        .when(priority == "3-MEDIUM", F.array(main, F.lit(2)))
        .otherwise(F.array(main))
    )
    name = (
        F.when(F.col("source_id") == 1, "storefront")
        .when(F.col("source_id") == 2, "call_center")
        .otherwise("catalog")
    )
    loaded = table(spark, sf_dir, "orders")
    when = F.lit(REFERENCE_TIME).cast("timestamp")
    return loaded.select("*", F.explode(systems).alias("source_id")).select(
        numbered("ORD-", F.col("o_orderkey"), 12).alias("id"),
        numbered("EXT-", F.col("o_orderkey"), 12).alias("external_order_id"),
        "source_id",
        name.alias("source_name"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        when.alias("created_at"),
        when.alias("updated_at"),
    )


def customers_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers. Those of the building segment are in the catalog, some of them twice
    under a legacy id; the others are known to another source only.
    """
    ref, segment = numbered("CUST-", F.col("c_custkey"), 6), F.col("c_mktsegment")
    own = F.md5(F.concat(F.lit("catalog|"), ref, F.lit("|")))
    legacy = F.md5(F.concat(F.lit("legacy|"), ref, F.lit("|")))
    twice = (segment == "BUILDING") & (F.col("c_nationkey") < 12)
    when = F.lit(REFERENCE_TIME).cast("timestamp")
    catalog = segment == "BUILDING"
    return (
        table(spark, sf_dir, "customer")
        .select("*", F.explode(F.when(twice, F.array(own, legacy)).otherwise(F.array(own))).alias("id"))
        .select(
            "id",
            F.md5(F.concat(F.lit("['catalog', '"), ref, F.lit("']"))).alias("customer_hash"),
            ref.alias("external_customer_id"),
            F.when(catalog, 12).otherwise(1).alias("source_id"),
            F.when(catalog, "catalog").otherwise("storefront").alias("source_name"),
            F.col("c_name").alias("customer_name"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country_code"),
            F.lit("RESOLVED").alias("resolution_state"),
            when.alias("created_at"),
            when.alias("updated_at"),
        )
    )

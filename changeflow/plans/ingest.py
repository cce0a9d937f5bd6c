"""Queries over single events: decoding, filtering, keys, extraction, generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.keys import customer_hash, customer_id
from changeflow.operators import events, resolve
from changeflow.plans.inputs import SETTINGS, Inputs, shown
from changeflow.plans.oracle import instant_text, query
from changeflow.session import scratch_dir
from changeflow.sources import generate, kafka, seeds
from changeflow.streaming.extraction import Extraction


def cdc_frame_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame every event's order id as a registry would, and take the frame apart."""
    log = Inputs(spark, sf_dir).order_log
    schema_id = F.unhex(F.lpad(F.hex(F.col("op_ts") - F.lit(1_704_067_200_000)), 8, "0"))
    body = F.encode(F.coalesce("order_id", F.lit("")), "UTF-8")
    frame = F.concat(F.unhex(F.lit("00")), schema_id, body)
    parts = log.select("kafka_offset", *kafka.split_frame(frame))
    return parts.withColumn("body", F.decode("body", "UTF-8"))


def cdc_frame_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of two schema versions decoded each by its own, and the rest refused."""
    log = Inputs(spark, sf_dir).order_log
    k = (F.col("current_ts") - F.col("op_ts")).cast("int")
    old = F.to_json(F.struct("order_id", F.col("op_type").alias("op")))
    new = F.to_json(F.struct("order_id", "op_type", "customer_ref"), {"ignoreNullFields": "false"})
    whole = F.when(k % 2 == 0, kafka.framed(F.encode(new, "UTF-8"), 2)).otherwise(
        kafka.framed(F.encode(old, "UTF-8"), 1)
    )
    value = (
        F.when(k == 41, F.unhex(F.lit("00AA")))
        .when(k == 42, F.concat(F.unhex(F.lit("01")), whole))
        .when(k == 43, kafka.framed(F.encode(new, "UTF-8"), 7))
        .when(k == 44, None)
        .when(k == 46, kafka.framed(F.encode(F.lit("{"), "UTF-8"), 2))
        .otherwise(whole)
    )

    def old_version(body: Column) -> Column:
        event = F.from_json(body.cast("string"), "order_id string, op string")
        return F.struct(event["order_id"].alias("order_id"), event["op"].alias("op_type"))

    def new_version(body: Column) -> Column:
        return F.from_json(body.cast("string"), "order_id string, op_type string, customer_ref string")

    topic = log.select(value.alias("value"), "kafka_partition", "kafka_offset")
    events_ = kafka.decode_framed(topic, {1: old_version, 2: new_version})
    return events_.select("kafka_offset", "decode_status", "order_id", "op_type", "customer_ref")


def cdc_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode JSON payloads, some of them damaged, and tell why each is refused."""
    log = Inputs(spark, sf_dir).order_log
    k = (F.col("current_ts") - F.col("op_ts")).cast("int")
    fields = [c for c in log.columns if not c.startswith("kafka_")]
    whole = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    partial = F.to_json(F.struct("order_id", "op_type", "op_ts"), {"ignoreNullFields": "false"})
    payload = (
        F.when(k == 41, F.substring(whole, 1, 40))
        .when(k == 42, "{}")
        .when(k == 43, None)
        .when(k == 44, partial)
        .otherwise(whole)
    )
    topic = log.select("kafka_partition", "kafka_offset", payload.alias("value"))
    decoded = kafka.decode_json(topic)
    reason = events.reject_reason(F.col("decode_status"))
    return decoded.select(
        "kafka_offset",
        "decode_status",
        reason.alias("reject_reason"),
        F.when(F.col("decode_status") == events.DECODED, F.col("customer_ref")).alias(
            "customer_ref"
        ),
        F.when(F.col("decode_status") == events.DECODED, F.col("op_ts")).alias("op_ts"),
    )


def cdc_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.relevant(Inputs(spark, sf_dir).order_log).select(
        "kafka_offset", "order_id", "op_type", "link_origin"
    )


def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.rejected(Inputs(spark, sf_dir).order_log).select(
        "kafka_offset", "reject_reason", "counted"
    )


def batches_by_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relevant events, cut into batches of so many of them."""
    inputs = Inputs(spark, sf_dir)
    kept = events.batches_by_relevance(events.relevant(inputs.order_log), SETTINGS.batch_size)
    return kept.select("kafka_partition", "kafka_offset", "order_id", "batch_no")


def cdc_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = events.normalised(events.relevant(Inputs(spark, sf_dir).order_log))
    return shown(records.drop("op_ts", "kafka_partition"))


def expand_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a row change with both images, expanded to change events."""
    log = Inputs(spark, sf_dir).order_log
    image = ("order_id", "customer_ref", "status")
    changes = log.select(
        "kafka_offset",
        "op_type",
        "op_ts",
        F.struct("order_id", "customer_ref", F.lit("CONFIRMED").alias("status")).alias("before"),
        F.struct(*image).alias("after"),
    )
    return events.expanded_updates(changes)


def customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.col("customer_ref")
    return Inputs(spark, sf_dir).order_log.select(
        "kafka_offset",
        "customer_ref",
        customer_id(ref).alias("customer_id"),
        customer_hash(ref).alias("customer_hash"),
    )


def operational_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return shown(resolve.operational_orders(inputs.orders, inputs.sources)).select(
        "id", "source_id", "source_name", "order_status", "order_date"
    )


def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs per table, rows arriving in between; some rows have no update time."""
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "extract")

    def deliver(topic: str, rows: DataFrame) -> None:
        told = rows.select(F.lit(topic).alias("topic"), F.col("id").alias("row_id"), "updated_at")
        told.write.mode("append").parquet(f"{root}/delivered/run={run}")

    def source(name: str, key: str, updated_at: Column) -> DataFrame:
        stamp = updated_at.cast("timestamp").alias("updated_at")
        return inputs.table(name).select(F.col(key).alias("id"), stamp)

    balance = F.col("c_acctbal")
    tables = {
        "orders": source("orders", "o_orderkey", F.col("o_orderdate")),
        "order_lines": source("lineitem", "l_orderkey", F.col("l_shipdate")),
        "customers": source(
            "customer", "c_custkey",
            F.when(balance > 0, F.timestamp_seconds(F.floor(balance) * 86400)),
        ),
    }
    extraction = Extraction(spark, f"{root}/bookmarks", deliver)
    early = F.col("updated_at").isNull() | (F.col("updated_at") < F.lit("1996-01-01").cast("timestamp"))
    for run in (1, 2):
        for name, rows in tables.items():
            extraction.run(name, rows.filter(early) if run == 1 else rows)
    delivered = spark.read.schema("topic string, row_id long, updated_at timestamp, run int")
    return shown(delivered.parquet(f"{root}/delivered"))


def seed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed a source that has orders (nothing happens) and one that has none."""
    orders = Inputs(spark, sf_dir).orders
    seeded = (
        orders.unionByName(seeds.seed_orders(spark, orders))
        .unionByName(seeds.seed_orders(spark, orders, 3, "marketplace"))
    )
    return shown(seeded).select(
        "id", "external_order_id", "source_id", "source_name", "order_status", "order_date",
        "created_at",
    )


def gen_events_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many synthetic events as the event table has rows."""
    inputs = Inputs(spark, sf_dir)
    table = inputs.table("events")
    draws = table.select(F.col("event_id").alias("draw"))
    return generate.generated_events(draws, table.count())


QUERIES = {
    f.__name__: f
    for f in (
        cdc_frame_split, cdc_frame_decode, cdc_json_decode, cdc_relevant, cdc_rejects, cdc_normalized,
        batches_by_relevance, expand_updates, customer_keys, operational_orders, incremental_extract, seed_orders,
        gen_events_profile,
    )
}

REASON = """CASE WHEN order_id IS NULL THEN 'no_order'
                  WHEN op_type NOT IN ('I', 'D') THEN 'other_operation'
                  WHEN op_type = 'I' AND link_origin IS NOT DISTINCT FROM 'A' THEN 'automatic_insert'
             END"""


def _draw(purpose: str, bound: int) -> str:
    digest = f"substr(md5('20260105:' || CAST(draw AS VARCHAR) || ':{purpose}'), 1, 8)"
    return f"(CAST('0x' || {digest} AS BIGINT) % {bound})"


def _generated() -> str:
    def event(step: int) -> str:
        return f"""
            SELECT first + {step} AS sequence,
                   'ORD-' || lpad(CAST({_draw('order', 20)} + 1 AS VARCHAR), 4, '0') AS order_id,
                   'CUST-' || lpad(CAST({_draw(f'customer-{step}', 8)} + 1 AS VARCHAR), 5, '0')
                       AS customer_ref,
                   list_extract(['web', 'phone', 'partner-api'], {_draw(f'channel-{step}', 3)} + 1)
                       AS channel_id,
                   list_extract(['CONFIRMED', 'PICKING', 'SHIPPED', 'CANCELLED'],
                                {_draw(f'status-{step}', 4)} + 1) AS status,
                   CAST(DATE '2026-01-05' + CAST({_draw(f'day-{step}', 6)} AS INT) AS VARCHAR) AS event_date,
                   CASE WHEN {_draw('origin', 1000000)} < 250000 THEN 'A' ELSE 'M' END AS link_origin,
                   {"CASE WHEN is_delete OR paired THEN 'D' ELSE 'I' END" if step == 0 else "'I'"} AS op_type,
                   moment + {step} AS op_ts,
                   moment + {step} + 5 + {_draw(f'delay-{step}', 246)} AS current_ts
            FROM placed {"WHERE paired" if step else ""}"""

    return f"""
        WITH planned AS (
            SELECT event_id AS draw, {_draw('delete', 1000000).replace('draw', 'event_id')} < 200000 AS is_delete,
                   {_draw('pair', 1000000).replace('draw', 'event_id')} < 300000 AS pair_drawn,
                   1767600000000 + 1000 * ((event_id // 2) * 31 + CASE WHEN event_id % 2 = 1
                       THEN 1 + {_draw('step', 30).replace('draw', 'event_id')} ELSE 0 END) AS moment
            FROM events),
        sized AS (SELECT *, pair_drawn AND NOT is_delete AS is_pair FROM planned),
        ordered AS (
            SELECT *, coalesce(sum(CASE WHEN is_pair THEN 2 ELSE 1 END) OVER (
                       ORDER BY draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first
            FROM sized),
        placed AS (
            SELECT *, is_pair AND first + 2 <= (SELECT count(*) FROM events) AS paired
            FROM ordered WHERE first < (SELECT count(*) FROM events))
        {event(0)} UNION ALL {event(1)}"""


ORACLE = {
    "cdc_frame_split": query("""
        SELECT kafka_offset, '00' AS marker, op_ts - 1704067200000 AS schema_id,
               coalesce(order_id, '') AS body
        FROM order_log"""),
    "cdc_frame_decode": query("""
        SELECT kafka_offset, decode_status,
               CASE WHEN decode_status = 'decoded' THEN order_id END AS order_id,
               CASE WHEN decode_status = 'decoded' THEN op_type END AS op_type,
               CASE WHEN decode_status = 'decoded' AND k % 2 = 0 THEN customer_ref END AS customer_ref
        FROM (SELECT *, CASE k WHEN 41 THEN 'unknown_frame' WHEN 42 THEN 'unknown_frame'
                               WHEN 43 THEN 'unknown_schema' WHEN 44 THEN 'empty'
                               WHEN 46 THEN 'undecodable' ELSE 'decoded' END AS decode_status
              FROM order_log)"""),
    "cdc_json_decode": query(f"""
        SELECT kafka_offset, decode_status,
               CASE WHEN decode_status <> 'decoded' THEN decode_status ELSE {REASON} END AS reject_reason,
               CASE WHEN decode_status = 'decoded' THEN customer_ref END AS customer_ref,
               CASE WHEN decode_status = 'decoded' THEN op_ts END AS op_ts
        FROM (SELECT *, CASE k WHEN 41 THEN 'undecodable' WHEN 42 THEN 'empty' WHEN 43 THEN 'empty'
                               WHEN 44 THEN 'missing_field' ELSE 'decoded' END AS decode_status
              FROM order_log)"""),
    "cdc_relevant": query("SELECT kafka_offset, order_id, op_type, link_origin FROM relevant"),
    "cdc_rejects": query(f"""
        SELECT kafka_offset, reject_reason, true AS counted
        FROM (SELECT *, {REASON} AS reject_reason FROM order_log)
        WHERE reject_reason IS NOT NULL"""),
    "batches_by_relevance": query("""
        SELECT kafka_partition, kafka_offset, order_id,
               (row_number() OVER (ORDER BY kafka_offset, kafka_partition) - 1) // 500 AS batch_no
        FROM relevant"""),
    "cdc_normalized": query(f"""
        SELECT order_id, customer_ref, channel_id, status, event_date, link_origin, op_type,
               {instant_text("op_timestamp")}, kafka_offset
        FROM records"""),
    "expand_updates": query("""
        SELECT kafka_offset, CASE op_type WHEN 'U' THEN 'D' ELSE op_type END AS op_type, op_ts,
               order_id, customer_ref,
               CASE WHEN op_type IN ('U', 'D') THEN 'CONFIRMED' ELSE status END AS status
        FROM order_log
        UNION ALL
        SELECT kafka_offset, 'I', op_ts + 1, order_id, customer_ref, status
        FROM order_log WHERE op_type = 'U'"""),
    "customer_keys": query("""
        SELECT kafka_offset, customer_ref,
               md5('catalog|' || coalesce(customer_ref, '') || '|') AS customer_id,
               md5(CASE WHEN customer_ref IS NULL THEN '[''catalog'']'
                        ELSE '[''catalog'', ''' || customer_ref || ''']' END) AS customer_hash
        FROM order_log"""),
    "operational_orders": query("""
        SELECT id, source_id, source_name, order_status, CAST(order_date AS VARCHAR) AS order_date
        FROM orders_reference
        WHERE source_id IN (SELECT id FROM sources_reference WHERE source_type LIKE '%operational%')"""),
    "incremental_extract": """
        WITH sources AS (
            SELECT 'cdc.dev.orders' AS topic, o_orderkey AS row_id, CAST(o_orderdate AS TIMESTAMP) AS updated_at
            FROM orders
            UNION ALL
            SELECT 'cdc.dev.order_lines', l_orderkey, CAST(l_shipdate AS TIMESTAMP) FROM lineitem
            UNION ALL
            SELECT 'cdc.dev.customers', c_custkey,
                   CASE WHEN c_acctbal > 0
                        THEN make_timestamp(CAST(floor(c_acctbal) AS BIGINT) * 86400 * 1000000) END
            FROM customer)
        SELECT topic, row_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at,
               CASE WHEN coalesce(updated_at < TIMESTAMP '1996-01-01', true) THEN 1 ELSE 2 END AS run
        FROM sources""",
    "seed_orders": query("""
        SELECT id, 'EXT-' || substr(id, 5) AS external_order_id, source_id, source_name, order_status,
               CAST(order_date AS VARCHAR) AS order_date, '2023-12-31 00:00:00' AS created_at
        FROM orders_reference
        UNION ALL
        SELECT 'ORD-' || lpad(CAST(n AS VARCHAR), 4, '0'), 'EXT-' || lpad(CAST(n AS VARCHAR), 6, '0'),
               source_id, source_name, 'CONFIRMED', '2026-01-05', '2026-01-05 09:00:00'
        FROM range(1, 21) AS r(n), (VALUES (1, 'storefront'), (3, 'marketplace')) AS s(source_id, source_name)
        WHERE NOT EXISTS (SELECT 1 FROM orders_reference o WHERE o.source_id = s.source_id)"""),
    "gen_events_profile": _generated(),
}

"""Queries that run the streaming jobs over topics landed from the tables.

Each topic arrives in parts; the job is restarted from its checkpoint for every
part, so the cut points of the micro-batches are known and recovery is exercised.
Folders live below the shared checkpoint folder.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import schemas
from changeflow.operators.latest import CUSTOMER_COLUMNS, LINE_COLUMNS, ORDER_COLUMNS
from changeflow.plans.inputs import APPLIED_AT, SETTINGS, Inputs, shown
from changeflow.plans.ingest import REASON
from changeflow.plans.oracle import by_parts, query
from changeflow.plans.upsert import customer_rows, flush_sql, flush_tables
from changeflow.session import scratch_dir
from changeflow.sources import kafka
from changeflow.sources.landing import land, read_landing
from changeflow.streaming.enriched import TOPICS, EnrichedView, mixed_topics
from changeflow.streaming.expiring import ExpiringLatestTable
from changeflow.streaming.guard import KeyGuard
from changeflow.streaming.latest import LatestTable
from changeflow.streaming.load import load_log
from changeflow.streaming.tables import VERSION
from changeflow.streaming.upsert import References, UpsertSink, Warehouse, start_upsert

PARTS = 3
#: A micro-batch, which is a part here, is one batch.
WHOLE = replace(SETTINGS, batch_size=None)


def _run(query) -> None:
    query.awaitTermination()


def _references(inputs: Inputs) -> References:
    orders, sources, customers = inputs.orders, inputs.sources, inputs.customers
    return References(lambda: orders, lambda: sources, lambda: customers)


def _tables(warehouse: Warehouse) -> DataFrame:
    return flush_tables(
        {
            "customers": customer_rows(warehouse.backfilled_customers()),
            "candidates": warehouse.candidates(),
            "candidates_history": warehouse.candidates_history(),
            "links": warehouse.links(),
            "links_history": warehouse.links_history(),
        }
    )


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five tables after the log has streamed through the upsert job."""
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "upsert")
    topic, checkpoint = f"{root}/topic", f"{root}/checkpoint"
    warehouse = Warehouse(spark, f"{root}/warehouse", gather_every=2)
    sink = UpsertSink(warehouse, _references(inputs), "orders", WHOLE)
    log = inputs.order_log.withColumn("part", inputs.part_of(PARTS))
    for part in range(PARTS):
        land(log.filter(F.col("part") == part).drop("part"), topic)
        stream = read_landing(spark, topic, schemas.ORDER_EVENT)
        _run(start_upsert(stream, sink, checkpoint))
    return _tables(warehouse)


def redelivery_converges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch delivered twice: the job fails after each commit and starts again."""
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "redelivery")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    failures = []

    def fail_once(_: DataFrame) -> None:
        if len(failures) % 2 == 0:
            failures.append("after the commit, before the offsets")
            raise RuntimeError(failures[-1])
        failures.append("none")

    sink = UpsertSink(warehouse, _references(inputs), "orders", WHOLE, publish=fail_once)
    log = inputs.order_log.withColumn("part", inputs.part_of(2))
    for part in range(2):
        land(log.filter(F.col("part") == part).drop("part"), f"{root}/topic")
        for delivery in range(2):
            stream = read_landing(spark, f"{root}/topic", schemas.ORDER_EVENT)
            try:
                _run(start_upsert(stream, sink, f"{root}/checkpoint"))
            except StreamingQueryException:
                if delivery:
                    raise
    return _tables(warehouse)


def cdc_republish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records the job publishes while the log streams through it."""
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "republish")

    def publish(rows: DataFrame) -> None:
        kafka.published(rows.drop(VERSION)).write.mode("append").parquet(f"{root}/published")

    when = datetime.fromisoformat(APPLIED_AT)
    sink = UpsertSink(
        Warehouse(spark, f"{root}/warehouse"), _references(inputs), "orders", WHOLE,
        clock=lambda: when, publish=publish,
    )
    log = inputs.order_log.withColumn("part", inputs.part_of(2))
    for part in range(2):
        land(log.filter(F.col("part") == part).drop("part"), f"{root}/topic")
        stream = read_landing(spark, f"{root}/topic", schemas.ORDER_EVENT)
        _run(start_upsert(stream, sink, f"{root}/checkpoint"))
    return _told(spark, root)


def _told(spark: SparkSession, root: str) -> DataFrame:
    """The records a job has published."""
    records = spark.read.schema("key string, value string").parquet(f"{root}/published")
    told = ("order_source_id", "order_id", "customer_id", "audit_action", "link_score", "created_at")
    # a value is parsed once for all its fields
    return records.select("key", F.json_tuple("value", *told).alias(*told))


def stream_upsert_by_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five tables after one micro-batch of the whole log, cut by relevant records."""
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "relevance")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    land(inputs.order_log, f"{root}/topic")
    stream = read_landing(spark, f"{root}/topic", schemas.ORDER_EVENT)
    _run(start_upsert(stream, UpsertSink(warehouse, _references(inputs), "orders", SETTINGS), f"{root}/checkpoint"))
    return _tables(warehouse)


def _twice_restarted(spark: SparkSession, sf_dir: str) -> tuple[Inputs, Warehouse]:
    """The log in parts; the first batch is delivered twice, every part by a new job."""
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "counted")
    warehouse = Warehouse(spark, f"{root}/warehouse", gather_every=2)
    broken = [RuntimeError("after the commit, before the offsets")]

    def fail_once(_: DataFrame) -> None:
        if broken:
            raise broken.pop()

    log = inputs.order_log.withColumn("part", inputs.part_of(PARTS))
    for part in range(PARTS):
        land(log.filter(F.col("part") == part).drop("part"), f"{root}/topic")
        for _ in range(2 if broken else 1):
            sink = UpsertSink(warehouse, _references(inputs), "orders", SETTINGS, publish=fail_once)
            stream = read_landing(spark, f"{root}/topic", schemas.ORDER_EVENT)
            planned = len(broken)
            try:
                _run(start_upsert(stream, sink, f"{root}/checkpoint"))
            except StreamingQueryException:
                # the planned failure ends one run; what ends another is an error
                if len(broken) == planned:
                    raise
    return inputs, warehouse


def rejects_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events the job did not apply, as its table of rejects has them."""
    _, warehouse = _twice_restarted(spark, sf_dir)
    return warehouse.rejects()


def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job has counted after two restarts and a redelivery."""
    inputs, warehouse = _twice_restarted(spark, sf_dir)
    counts = warehouse.counters("orders")
    rows = F.array(*[F.struct(F.lit(k).alias("counter"), F.lit(n).cast("long").alias("n")) for k, n in counts.items()])
    return inputs.spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def outbox_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a consumer receives though its job crashed before it published.

    Another writer has applied more and gathered the tables before the job is back.
    """
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "outbox")
    when = datetime.fromisoformat(APPLIED_AT)
    broken = [RuntimeError("after the commit, before publishing")]

    def publish(rows: DataFrame) -> None:
        if broken:
            raise broken.pop()
        kafka.published(rows.drop(VERSION)).write.mode("append").parquet(f"{root}/published")

    def run(part: int, name: str, **options) -> None:
        warehouse = Warehouse(spark, f"{root}/warehouse", gather_every=1)
        sink = UpsertSink(warehouse, _references(inputs), name, WHOLE, clock=lambda: when, **options)
        stream = read_landing(spark, f"{root}/topic-{part}", schemas.ORDER_EVENT)
        _run(start_upsert(stream, sink, f"{root}/checkpoint-{part}"))

    log = inputs.order_log.withColumn("part", inputs.part_of(2))
    for part in range(2):
        land(log.filter(F.col("part") == part).drop("part"), f"{root}/topic-{part}")
    try:
        run(0, "one", publish=publish)
    except StreamingQueryException:
        run(1, "other")
    run(0, "one", publish=publish)
    return _told(spark, root)


def bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five tables after every batch of the log was loaded in one commit."""
    inputs = Inputs(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_dir(spark, "load"))
    when = datetime.fromisoformat(APPLIED_AT)
    load_log(warehouse, _references(inputs), inputs.records(), "log", when, SETTINGS)
    return _tables(warehouse)


def _latest_stream(
    spark: SparkSession, log: DataFrame, event: T.StructType, keys: list[str], columns: list[str]
) -> DataFrame:
    """A latest-state table after the parts of its topic have arrived one by one."""
    root = scratch_dir(spark, "latest")
    table = LatestTable(spark, f"{root}/table", event, keys, columns, gather_every=2)
    for part in range(PARTS):
        land(log.filter(F.col("part") == part).drop("part"), f"{root}/topic")
        stream = read_landing(spark, f"{root}/topic", event)
        _run(table.start(stream, f"{root}/checkpoint"))
    return table.current()


def latest_orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    log = inputs.order_log.withColumn("part", inputs.part_of(PARTS))
    return _latest_stream(spark, log, schemas.ORDER_EVENT, ["order_id"], ORDER_COLUMNS)


def latest_customers_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    log = inputs.customer_log
    last = log.agg(F.max("kafka_offset")).first()[0]
    log = log.withColumn("part", F.expr(f"({PARTS} * kafka_offset) div {last + 1}"))
    state = _latest_stream(
        spark, log, schemas.CUSTOMER_EVENT, ["customer_ref"], CUSTOMER_COLUMNS
    )
    return state.drop("op_type")


def latest_order_lines_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines arrive in the order they ship, some three years at a time."""
    inputs = Inputs(spark, sf_dir)
    day = F.date_add(F.to_date(F.lit("1970-01-01")), F.expr("cast(kafka_offset div 100000000000000 as int)"))
    part = F.greatest(F.least(F.floor((F.year(day) - 1995) / 3), F.lit(PARTS - 1)), F.lit(0))
    log = inputs.line_log.withColumn("part", part)
    state = _latest_stream(
        spark, log, schemas.LINE_EVENT, ["order_id", "line_number"], LINE_COLUMNS
    )
    return shown(state.drop("op_type"))


def replay_from_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic applied, then applied again by a job that starts from a fresh checkpoint."""
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "replay")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    sink = UpsertSink(warehouse, _references(inputs), "orders", WHOLE)
    land(inputs.order_log, f"{root}/topic")
    for checkpoint in ("first", "second"):
        stream = read_landing(spark, f"{root}/topic", schemas.ORDER_EVENT)
        _run(start_upsert(stream, sink, f"{root}/{checkpoint}"))
    return _tables(warehouse)


#: Milliseconds a deleted order is remembered.
HORIZON_MS = 30 * 24 * 3600 * 1000


def latest_orders_expiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that keep non-null values, unless they come back long after their delete."""
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "expiring")
    table = ExpiringLatestTable(
        spark, f"{root}/table", schemas.ORDER_EVENT, ["order_id"], ORDER_COLUMNS, HORIZON_MS, gather_every=2
    )
    log = inputs.order_log.withColumn("part", inputs.part_of(PARTS))
    for part in range(PARTS):
        land(log.filter(F.col("part") == part).drop("part"), f"{root}/topic")
        _run(table.start(read_landing(spark, f"{root}/topic", schemas.ORDER_EVENT), f"{root}/checkpoint"))
    return table.current()


def key_order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the order topic would not keep to customers as its key.

    Its last part arrives before the middle one.
    """
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "guard")
    guard = KeyGuard(spark, f"{root}/table", "customer_ref", gather_every=2, buckets=16)
    log = inputs.order_log.withColumn("part", inputs.part_of(PARTS))
    for part in (0, 2, 1):
        land(log.filter(F.col("part") == part).drop("part"), f"{root}/topic")
        _run(guard.start(read_landing(spark, f"{root}/topic", schemas.ORDER_EVENT), f"{root}/checkpoint"))
    return guard.violations()


def _enriched(spark: SparkSession, sf_dir: str, checkpoints: int = 1) -> EnrichedView:
    """The enriched view after its topics have arrived one by one.

    Orders come in two parts around the lines and customers, so every side changes
    under rows the view already holds. With further checkpoints the topics are read again.
    """
    inputs = Inputs(spark, sf_dir)
    root = scratch_dir(spark, "enriched")
    view = EnrichedView(spark, f"{root}/view", gather_every=2, buckets=16)

    def read(checkpoint: str) -> None:
        stream = mixed_topics(
            {name: read_landing(spark, f"{root}/{name}", event) for name, event in TOPICS.items()}
        )
        _run(view.start(stream, checkpoint))

    orders = inputs.order_log.withColumn("part", inputs.part_of(2))
    arrivals = [
        {"orders": orders.filter(F.col("part") == 0).drop("part")},
        {"lines": inputs.line_log, "customers": inputs.customer_log},
        {"orders": orders.filter(F.col("part") == 1).drop("part")},
    ]
    for name, event in TOPICS.items():
        land(_none(spark, event), f"{root}/{name}")
    for arrival in arrivals:
        for name, rows in arrival.items():
            land(rows, f"{root}/{name}")
        read(f"{root}/checkpoint")
    for number in range(1, checkpoints):
        read(f"{root}/checkpoint-{number}")
    return view


def orders_enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_enriched(spark, sf_dir).current())


def orders_enriched_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view after its topics were read from their start once more."""
    return shown(_enriched(spark, sf_dir, checkpoints=2).current())


def lines_by_order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_enriched(spark, sf_dir).lines_by_order())


def order_customer_refs_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_enriched(spark, sf_dir).customer_refs())


def _none(spark: SparkSession, event) -> DataFrame:
    fields = [*schemas.POSITION.fields, *event.fields]
    return spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    )


QUERIES = {
    f.__name__: f
    for f in (
        stream_upsert, redelivery_converges, cdc_republish, bulk_load, latest_orders_stream, latest_customers_stream, latest_order_lines_stream,
        replay_from_zero, orders_enriched_stream, lines_by_order_stream, order_customer_refs_stream,
        orders_enriched_replayed, outbox_delivery, stream_upsert_by_relevance, rejects_stream, stream_counters,
        latest_orders_expiring, key_order_violations,
    )
}

#: Batches of relevant records, as they are read.
BY_RELEVANCE = "(row_number() OVER (ORDER BY kafka_offset, kafka_partition) - 1) // 500"

_PUBLISHED = """
        SELECT order_id AS key, CAST(order_source_id AS VARCHAR) AS order_source_id, order_id, customer_id,
               CASE op_type WHEN 'D' THEN 'CDC_DELETE' ELSE 'CDC_INSERT' END AS audit_action,
               CAST(link_score AS VARCHAR) AS link_score,
               strftime(created_at, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS created_at
        FROM stage"""

#: The last values of the columns since an order was forgotten last.
_EXPIRING = f"""
    WITH ops AS (
        SELECT *, lag(op_type) OVER w AS before, lag(op_ts) OVER w AS before_ts
        FROM order_log WHERE order_id IS NOT NULL
        WINDOW w AS (PARTITION BY order_id ORDER BY kafka_offset)
    ), lives AS (
        SELECT *, sum(CASE WHEN before = 'D' AND op_ts > before_ts + {HORIZON_MS} THEN 1 ELSE 0 END)
                  OVER (PARTITION BY order_id ORDER BY kafka_offset) AS life
        FROM ops
    ), last_life AS (
        SELECT * FROM lives l WHERE life = (SELECT max(life) FROM lives m WHERE m.order_id = l.order_id)
    )
    SELECT order_id, {", ".join(f"arg_max({c}, kafka_offset) FILTER ({c} IS NOT NULL) AS {c}" for c in ORDER_COLUMNS)},
           arg_max(op_type, kafka_offset) AS op_type
    FROM last_life GROUP BY order_id HAVING arg_max(op_type, kafka_offset) <> 'D'"""

_VIOLATIONS = """
    WITH arrived AS (
        SELECT customer_ref AS key, kafka_partition, kafka_offset,
               CASE (3 * kafka_offset) // (SELECT max(event_id) + 1 FROM events)
                    WHEN 0 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS arrival
        FROM order_log WHERE customer_ref IS NOT NULL
    ), homes AS (
        SELECT key, arg_min(kafka_partition, row(arrival, kafka_offset, kafka_partition)) AS home
        FROM arrived GROUP BY key
    ), reached AS (
        SELECT a.key, a.arrival, max(b.kafka_offset) AS reached
        FROM (SELECT DISTINCT key, arrival FROM arrived) a
        JOIN homes h ON h.key = a.key
        JOIN arrived b ON b.key = a.key AND b.arrival < a.arrival AND b.kafka_partition = h.home
        GROUP BY ALL
    )
    SELECT a.key, a.kafka_partition, a.kafka_offset,
           CASE WHEN a.kafka_partition <> h.home THEN 'moved' ELSE 'backwards' END AS violation,
           h.home, r.reached
    FROM arrived a JOIN homes h ON h.key = a.key
    LEFT JOIN reached r ON r.key = a.key AND r.arrival = a.arrival
    WHERE a.kafka_partition <> h.home OR a.kafka_offset <= r.reached"""

ORACLE = {
    "stream_upsert": query(flush_sql(), cut=by_parts(PARTS)),
    "redelivery_converges": query(flush_sql(), cut=by_parts(2)),
    "cdc_republish": query(_PUBLISHED, cut=by_parts(2)),
    "outbox_delivery": query(_PUBLISHED, cut=by_parts(2)),
    "bulk_load": query(flush_sql()),
    "latest_orders_stream": query("SELECT * FROM latest_orders"),
    "latest_customers_stream": query("SELECT * FROM latest_customers"),
    "latest_order_lines_stream": query("""
        SELECT order_id, line_number, product_ref, quantity, CAST(unit_price AS VARCHAR) AS unit_price
        FROM latest_lines"""),
    "replay_from_zero": query(flush_sql("2"), cut=by_parts(1)),
    "orders_enriched_stream": query("SELECT * FROM enriched"),
    "orders_enriched_replayed": query("SELECT * FROM enriched"),
    "stream_upsert_by_relevance": query(flush_sql(), cut=BY_RELEVANCE),
    "rejects_stream": query(f"""
        SELECT kafka_partition, kafka_offset, order_id, op_type, link_origin, reject_reason, true AS counted
        FROM (SELECT *, {REASON} AS reject_reason FROM order_log) WHERE reject_reason IS NOT NULL"""),
    "stream_counters": query(f"""
        SELECT 'read' AS counter, count(*) AS n FROM order_log
        UNION ALL
        SELECT 'skipped', count(*) FROM (SELECT {REASON} AS reason FROM order_log) WHERE reason IS NOT NULL
        UNION ALL
        SELECT 'flushes', CAST(sum(ceil(n / 500.0)) AS BIGINT)
        FROM (SELECT {by_parts(PARTS)} AS part, count(*) AS n FROM relevant GROUP BY part)"""),
    "latest_orders_expiring": query(f"SELECT * FROM ({_EXPIRING})"),
    "key_order_violations": query(f"SELECT * FROM ({_VIOLATIONS})"),
    "lines_by_order_stream": query("SELECT * FROM lines_by_order"),
    "order_customer_refs_stream": query("SELECT * FROM customer_refs"),
}

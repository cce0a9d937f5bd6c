"""The jobs as they are deployed: topics in, tables out, changes published."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow import schemas
from changeflow.operators.events import DECODED
from changeflow.operators.latest import CUSTOMER_COLUMNS, LINE_COLUMNS, ORDER_COLUMNS
from changeflow.session import tune
from changeflow.settings import JobSettings, TopicSettings
from changeflow.sources.clustered import push_lookups
from changeflow.sources.extract import topic_name
from changeflow.sources.kafka import avro_value, decode_avro, decode_json, json_value, publish, read_topic
from changeflow.streaming.enriched import TOPICS, EnrichedView, mixed_topics
from changeflow.streaming.latest import LatestTable
from changeflow.streaming.upsert import References, UpsertSink, Warehouse, start_upsert

#: The next batch starts as soon as one is done, and takes all that has come meanwhile.
AT_ONCE = {"processingTime": "0 seconds"}

#: Of each topic: the table it is extracted from, its schema, and what identifies a row.
LATEST = {
    "orders": ("orders", schemas.ORDER_EVENT, ("order_id",), ORDER_COLUMNS),
    "lines": ("order_lines", schemas.LINE_EVENT, ("order_id", "line_number"), LINE_COLUMNS),
    "customers": ("customers", schemas.CUSTOMER_EVENT, ("customer_ref",), CUSTOMER_COLUMNS),
}


def paused_when_idle(spark: SparkSession, seconds: float) -> None:
    """Wait so long before looking again where nothing was there to read.

    A backlog is worked off without a pause.
    """
    spark.conf.set("spark.sql.streaming.pollingDelay", f"{round(1000 * seconds)}ms")


def encoder(settings: TopicSettings, rows: T.StructType, name: str) -> Callable[[Column], Column]:
    """How published rows are encoded: as Avro where the settings name its schema id, else as JSON."""
    if settings.output_schema_id is None:
        return json_value
    return avro_value(schemas.avro_schema(rows, name, "com.example.cdc"), settings.output_schema_id)


def kept_running(
    start: Callable[[], StreamingQuery], restarts: int | None = None, pause: float = 5.0
) -> None:
    """Run a job, and start it again from its checkpoint each time it fails.

    What was read but not committed is read again. The job ends when its query is stopped,
    or fails once more than so many ``restarts`` in a row; a batch that got through ends the row.
    """
    failed = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return
        except StreamingQueryException:
            done = query.lastProgress
            failed = 1 if done and done["numInputRows"] else failed + 1
            if restarts is not None and failed > restarts:
                raise
            time.sleep(pause)


def decoded(
    topic: DataFrame,
    settings: TopicSettings,
    event: T.StructType,
    schema_ids: dict[int | None, str] | None = None,
) -> DataFrame:
    """The events of a topic with their ``decode_status``."""
    if settings.value_format == "json":
        return decode_json(topic, event)
    schema = schemas.avro_schema(event, "CdcEvent", "com.example.cdc")
    return decode_avro(topic, schema_ids or {None: schema}, event)


def decoded_topic(
    spark: SparkSession, settings: TopicSettings, admitted: int, event: T.StructType, progress: str
) -> DataFrame:
    """The events of a topic; payloads that do not decode are passed over."""
    events = decoded(read_topic(spark, settings, admitted, progress), settings, event)
    return events.filter(F.col("decode_status") == DECODED).drop("decode_status")


def upsert_job(
    spark: SparkSession,
    settings: JobSettings,
    references: References,
    schema_ids: dict[int | None, str] | None = None,
) -> StreamingQuery:
    """Start the job the settings describe.

    A micro-batch takes at most ``admitted`` events, and applies a batch for every
    ``batch_size`` relevant ones. Events that do not decode or are not relevant go to the
    table of rejects. Offsets are recorded below the table root; without them the topic is
    applied from its start again. With an output topic, applied rows are published to it.
    ``schema_ids`` names the writer schema of each id that may occur; the one under None
    stands for all others.
    """
    root = settings.table_root
    paused_when_idle(tune(spark), settings.upsert.idle_seconds)
    push_lookups(spark)
    topic = read_topic(spark, settings.topic, settings.upsert.admitted, f"{root}/orders.offsets")
    writers = schema_ids or {None: schemas.ORDER_EVENT_AVRO}
    events = decoded(topic, settings.topic, schemas.ORDER_EVENT, writers)

    def publish_applied(rows: DataFrame) -> None:
        rows = rows.select(*schemas.LINKS.names)
        publish(rows, settings.topic, value=encoder(settings.topic, schemas.LINKS, "AppliedLink"))

    sink = UpsertSink(
        Warehouse(spark, f"{root}/warehouse"),
        references,
        source="orders",
        settings=settings.upsert,
        publish=publish_applied if settings.topic.output_topic else None,
    )
    return start_upsert(events, sink, f"{root}/checkpoint", **AT_ONCE)


def latest_job(
    spark: SparkSession,
    settings: JobSettings,
    name: str,
    publish_changes: bool = False,
    ignore_nulls: bool = False,
) -> StreamingQuery:
    """Keep the latest state of the orders, lines or customers topic as a table.

    With ``publish_changes`` every changed key goes to the output topic, a deleted one
    with a null value. With ``ignore_nulls`` a column keeps its last non-null value.
    """
    table, event, keys, columns = LATEST[name]
    root = f"{settings.table_root}/latest/{name}"
    paused_when_idle(tune(spark), settings.upsert.idle_seconds)
    topic = replace(settings.topic, topic=topic_name(table, settings.environment))
    stream = decoded_topic(spark, topic, settings.upsert.admitted, event, f"{root}/topic.offsets")
    deliver: Callable[[DataFrame], None] | None = None
    if publish_changes:

        def deliver(changes: DataFrame) -> None:
            rows = state.state_schema
            publish(
                changes.select(*rows.names), settings.topic, key=keys,
                gone=F.col("op_type") == "D", value=encoder(settings.topic, rows, "LatestState"),
            )

    state = LatestTable(spark, f"{root}/table", event, keys, columns, publish=deliver)
    return state.start(stream, f"{root}/checkpoint", ignore_nulls=ignore_nulls, **AT_ONCE)


def enriched_job(spark: SparkSession, settings: JobSettings) -> StreamingQuery:
    """Keep the enriched order view over the three topics."""
    root = f"{settings.table_root}/enriched"
    paused_when_idle(tune(spark), settings.upsert.idle_seconds)
    streams = {}
    for name, event in TOPICS.items():
        topic = replace(settings.topic, topic=topic_name(LATEST[name][0], settings.environment))
        streams[name] = decoded_topic(
            spark, topic, settings.upsert.admitted, event, f"{root}/{name}.offsets"
        )
    view = EnrichedView(spark, f"{root}/view")
    return view.start(mixed_topics(streams), f"{root}/checkpoint", **AT_ONCE)

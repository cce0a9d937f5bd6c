"""Topic directories: offsets, admission, restarts, and the jobs over them from end to end."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F
from test_latest import line, lines_of, order, orders_of
from test_upsert import frame_of, links_of, modelled, random_log, references

from changeflow import schemas
from changeflow.settings import JobSettings
from changeflow.sources import directory
from changeflow.streaming import jobs
from changeflow.streaming.enriched import EnrichedView
from changeflow.streaming.latest import LatestTable
from changeflow.streaming.upsert import References, Warehouse

__all__ = ["references"]


def records_of(frame, key):
    names = [c for c in frame.columns if not c.startswith("kafka_")]
    return frame.select(
        F.col(key).alias("key"), F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"),
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"),
    )


def numbers(spark, *rows):
    return spark.createDataFrame(
        [(None, bytearray(b"x"), p, o) for p, o in rows], directory.SCHEMA
    )


def run(spark, path, checkpoint, out, until=None, **options):
    """Run a stream over a topic until all is read, or so many batches are; returns the batches."""
    batches = []

    def take(batch, number):
        batches.append(sorted((r.partition, r.offset) for r in batch.collect()))

    stream = directory.read_directory(spark, path, progress=f"{out}/progress.json", **options)
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [b for b in batches if b]


def test_offsets_limits_and_restarts(spark, tmp_path):
    path, checkpoint, out = str(tmp_path / "t"), str(tmp_path / "c"), str(tmp_path)
    first = [(p, o) for p in range(2) for o in range(0, 40, 2)]
    directory.append(numbers(spark, *first).repartition(4), path, group_records=5)
    got = run(spark, path, checkpoint, out, maxOffsetsPerTrigger=10)
    assert sorted(x for b in got for x in b) == first
    assert len(got) > 1 and max(map(len, got)) <= 20
    second = [(0, 100), (1, 41), (2, 7), (2, 8)]
    directory.append(numbers(spark, *second), path)
    got = run(spark, path, checkpoint, out, maxOffsetsPerTrigger=10)
    assert sorted(x for b in got for x in b) == sorted(second)
    assert run(spark, path, checkpoint, out) == []


def test_a_restart_goes_on_under_the_limit(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path)
    directory.append(numbers(spark, *[(0, o) for o in range(100)]), path, group_records=10)
    reader = directory.TopicReader({"path": path, "maxOffsetsPerTrigger": "10", "progress": f"{out}/p.json"})
    end = reader.latestOffset()
    start = reader.initialOffset()
    assert (start, end) == ({"0": 0}, {"0": 10})
    reader.partitions(start, end)
    again = directory.TopicReader({"path": path, "maxOffsetsPerTrigger": "10", "progress": f"{out}/p.json"})
    assert again.latestOffset() == {"0": 20}
    unlimited = directory.TopicReader({"path": path, "maxOffsetsPerTrigger": "10"})
    assert unlimited.latestOffset() == {"0": 100}


def test_starting_at_the_latest_and_incomplete_appends(spark, tmp_path):
    path, checkpoint, out = str(tmp_path / "t"), str(tmp_path / "c"), str(tmp_path)
    directory.append(numbers(spark, (0, 0), (0, 1)), path)
    assert run(spark, path, checkpoint, out, startingOffsets="latest") == []
    directory.append(numbers(spark, (0, 2), (1, 0)), path)
    unfinished = tmp_path / "t" / "half"
    (unfinished / "partition=0").mkdir(parents=True)
    (unfinished / "partition=0" / "part.parquet").write_bytes(b"not yet")
    assert run(spark, path, checkpoint, out) == [[(0, 2), (1, 0)]]


def test_an_absent_topic_is_an_empty_one(spark, tmp_path):
    assert run(spark, str(tmp_path / "none"), str(tmp_path / "c"), str(tmp_path)) == []


def settings_at(tmp_path, **more):
    return JobSettings.from_env({
        "WAREHOUSE_ROOT": str(tmp_path / "out"), "CDC_TOPIC_DIRECTORY": str(tmp_path / "topics"),
        "CDC_VALUE_FORMAT": "json", "SLEEP_INTERVAL_SECONDS": "0.1", **more,
    })


def finished(query):
    try:
        query.processAllAvailable()
    finally:
        query.stop()


@pytest.fixture
def polling(spark):
    yield
    spark.conf.unset("spark.sql.streaming.pollingDelay")


def test_the_upsert_job_from_topic_to_topic(spark, references, tmp_path, polling):
    settings = settings_at(tmp_path, SINK_OUTPUT_TOPIC="applied", BATCH_SIZE="1000")
    orders, sources, customers = references
    loaded = References(lambda: orders, lambda: sources, lambda: customers)
    log, topic = random_log(51, 60), str(tmp_path / "topics" / "cdc.dev.orders")
    for number, part in enumerate((log[:30], log[30:])):
        records = records_of(frame_of(spark, part), "order_id")
        if number:
            broken = spark.createDataFrame([("x", bytearray(b"{no json"), 0, 60)], directory.SCHEMA)
            records = records.withColumn("value", F.col("value").cast("binary")).unionByName(broken)
        directory.append(records, topic)
        finished(jobs.upsert_job(spark, settings, loaded))
    warehouse = Warehouse(spark, f"{settings.table_root}/warehouse")
    expected = modelled(log[:30], 30)
    expected.apply(log[30:])
    assert links_of(warehouse.links()) == expected.links
    assert warehouse.counters("orders")["read"] == 61
    assert warehouse.rejects().filter("reject_reason = 'undecodable'").count() == 1
    applied = directory.read_directory(spark, str(tmp_path / "topics" / "applied"))
    seen = []
    query = applied.writeStream.foreachBatch(lambda b, _: seen.extend(b.collect())).start()
    finished(query)
    assert len(seen) == warehouse.links_history().count()
    assert {json.loads(bytes(r.value))["order_id"] for r in seen} == {r.key for r in seen}


def test_the_latest_job_from_its_end(spark, tmp_path, polling):
    settings = settings_at(tmp_path, KAFKA_AUTO_OFFSET_RESET="latest", SINK_OUTPUT_TOPIC="told")
    topic = str(tmp_path / "topics" / "cdc.dev.orders")
    directory.append(records_of(orders_of(spark, order(1, "old", status="A")), "order_id"), topic)
    finished(jobs.latest_job(spark, settings, "orders", publish_changes=True, ignore_nulls=True))
    rows = orders_of(spark, order(2, "a", status="A"), order(3, "b", status="A"), order(4, "b", "D"), order(5, "a"))
    directory.append(records_of(rows, "order_id"), topic)
    finished(jobs.latest_job(spark, settings, "orders", publish_changes=True, ignore_nulls=True))
    _, event, keys, columns = jobs.LATEST["orders"]
    table = LatestTable(spark, f"{settings.table_root}/latest/orders/table", event, keys, columns)
    assert {(r.order_id, r.status) for r in table.current().collect()} == {("a", "A")}
    seen = []
    told = directory.read_directory(spark, str(tmp_path / "topics" / "told"))
    finished(told.writeStream.foreachBatch(lambda b, _: seen.extend(b.collect())).start())
    assert {(r.key, r.value is None) for r in seen} == {("a", False), ("b", True)}


def test_the_enriched_job(spark, tmp_path, polling):
    from test_latest import CUSTOMERS

    settings, topics = settings_at(tmp_path), tmp_path / "topics"
    named = spark.createDataFrame([(0, 1, "C", "Ann", "ES", "S", "I")], CUSTOMERS)
    directory.append(records_of(orders_of(spark, order(1, "a", ref="C")), "order_id"), str(topics / "cdc.dev.orders"))
    finished(jobs.enriched_job(spark, settings))
    directory.append(records_of(lines_of(spark, line(1, "a", 1, 2, "2.50")), "order_id"), str(topics / "cdc.dev.order_lines"))
    directory.append(records_of(named, "customer_ref"), str(topics / "cdc.dev.customers"))
    finished(jobs.enriched_job(spark, settings))
    view = EnrichedView(spark, f"{settings.table_root}/enriched/view")
    assert [(r.order_id, r.customer_name, float(r.order_total)) for r in view.current().collect()] == [("a", "Ann", 5.0)]

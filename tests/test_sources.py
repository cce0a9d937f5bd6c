from __future__ import annotations

from dataclasses import FrozenInstanceError
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changeflow import schemas
from changeflow.settings import (
    VARIABLES, ConfigurationError, JobSettings, TopicSettings, UpsertSettings,
)
from changeflow.sources import extract, generate, kafka, seeds
from changeflow.streaming.extraction import Extraction

TABLES_AT = {"WAREHOUSE_ROOT": "hdfs:///cdc"}
SAMPLES = {str: "x-9", int: "31", float: "0.25"}


def test_unset_and_blank_variables_leave_the_defaults():
    blank = {name: " \t" for name in VARIABLES if name != "WAREHOUSE_ROOT"}
    settings = JobSettings.from_env({**blank, **TABLES_AT})
    assert settings == JobSettings.from_env(TABLES_AT)
    assert (settings.topic, settings.upsert) == (TopicSettings(), UpsertSettings())
    assert settings.table_root == "hdfs:///cdc"


@pytest.mark.parametrize("variable", sorted(VARIABLES))
def test_every_variable_fills_its_setting(variable):
    section, name, kind = VARIABLES[variable]
    settings = JobSettings.from_env({**TABLES_AT, variable: f" {SAMPLES[kind]} "})
    holder = settings if section == "job" else getattr(settings, section)
    expected = SAMPLES[kind].upper() if name == "log_level" else kind(SAMPLES[kind])
    assert getattr(holder, name) == expected


def test_the_topic_follows_the_environment_unless_it_is_named():
    settings = JobSettings.from_env({**TABLES_AT, "ENVIRONMENT": "qa7"})
    assert settings.topic.topic == "cdc.qa7.orders"
    named = JobSettings.from_env({**TABLES_AT, "ENVIRONMENT": "qa7", "CDC_TOPIC": "mine"})
    assert named.topic.topic == "mine"


@pytest.mark.parametrize("variable", sorted(v for v, (_, _, kind) in VARIABLES.items() if kind is not str))
def test_numbers_that_are_none_are_refused(variable):
    with pytest.raises(ConfigurationError, match=variable):
        JobSettings.from_env({**TABLES_AT, variable: "1e"})


def test_the_table_root_is_required():
    with pytest.raises(ConfigurationError, match="WAREHOUSE_ROOT"):
        JobSettings.from_env({"BATCH_SIZE": "8"})


def test_settings_cannot_be_changed():
    with pytest.raises(FrozenInstanceError):
        UpsertSettings().batch_size = 1


def test_topic_options():
    options = kafka.read_options(TopicSettings(), max_offsets=500)
    assert options["subscribe"] == "cdc.dev.orders"
    assert options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "500"
    assert options["kafka.security.protocol"] == "PLAINTEXT"
    assert not any("sasl" in key for key in options)


@pytest.mark.parametrize("protocol", ["SASL_SSL", "sasl_plaintext"])
def test_sasl_options_are_shared_by_both_directions(protocol):
    settings = TopicSettings(
        security_protocol=protocol, sasl_username="me", sasl_password='s"cret', output_topic="out"
    )
    for options in (kafka.read_options(settings), kafka.write_options(settings)):
        assert options["kafka.sasl.mechanism"] == "PLAIN"
        assert 'username="me"' in options["kafka.sasl.jaas.config"]
        assert 'password="s\\"cret"' in options["kafka.sasl.jaas.config"]
    with pytest.raises(ConfigurationError):
        kafka.read_options(TopicSettings(security_protocol=protocol))


def test_publishing_needs_an_output_topic():
    with pytest.raises(ConfigurationError, match="SINK_OUTPUT_TOPIC"):
        kafka.write_options(TopicSettings())
    options = kafka.write_options(TopicSettings(output_topic="out"))
    assert (options["kafka.acks"], options["kafka.enable.idempotence"]) == ("all", "true")


def test_avro_schema_declares_nullable_fields_as_unions():
    import json

    fields = {f["name"]: f for f in json.loads(schemas.ORDER_EVENT_AVRO)["fields"]}
    assert fields["order_id"]["type"] == "string" and fields["op_ts"]["type"] == "long"
    assert fields["status"] == {"name": "status", "type": ["null", "string"], "default": None}


def test_avro_schema_of_lines_holds_decimals():
    import json

    fields = {f["name"]: f["type"] for f in json.loads(schemas.LINE_EVENT_AVRO)["fields"]}
    decimal = {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2}
    assert fields["unit_price"] == ["null", decimal] and fields["quantity"] == ["null", "int"]


def test_frames_are_decoded_by_their_schema_id(spark):
    def text(value):
        return lambda body: F.struct(body.cast("string").alias("order_id"), F.lit(value).alias("op_type"))

    frames = [b"\0\0\0\0\1a", b"\0\0\0\0\2b", b"\0\0\0\0\3c", b"\1\0\0\0\1d", b"\0\0", None]
    topic = spark.createDataFrame([(v and bytearray(v),) for v in frames], "value binary")
    known = kafka.decode_framed(topic, {1: text("I"), 2: text("D")})
    assert [(r.order_id, r.op_type, r.decode_status) for r in known.collect()] == [
        ("a", "I", "decoded"), ("b", "D", "decoded"), (None, None, "unknown_schema"),
        (None, None, "unknown_frame"), (None, None, "unknown_frame"), (None, None, "empty"),
    ]
    rest = kafka.decode_framed(topic, {None: text("I"), 2: text("D")})
    assert [(r.order_id, r.op_type) for r in rest.collect()][:3] == [("a", "I"), ("b", "D"), ("c", "I")]
    assert known.columns[:-1] == schemas.ORDER_EVENT.names


def test_frames_are_made_as_they_are_read(spark):
    row = spark.range(1).select(kafka.framed(F.encode(F.lit("xy"), "UTF-8"), 70000).alias("v"))
    parts = row.select(*kafka.split_frame(F.col("v"))).first()
    assert (parts.marker, parts.schema_id, bytes(parts.body)) == ("00", 70000, b"xy")


def test_changes_are_published_by_key_with_null_for_gone_ones(spark):
    rows = spark.createDataFrame([("O1", 1, "I"), ("O1", 2, "D"), ("O2", 1, None)], "order_id string, line int, op string")
    told = kafka.published(rows, ["order_id", "line"], gone=F.col("op") == "D").collect()
    assert [(r.key, r.value is None) for r in told] == [
        ('{"order_id":"O1","line":1}', False), ('{"order_id":"O1","line":2}', True),
        ('{"order_id":"O2","line":1}', False),
    ]


def test_jobs_start_the_next_batch_at_once_and_pause_only_when_idle(spark, monkeypatch):
    from changeflow.streaming import jobs

    started = {}
    monkeypatch.setattr(jobs, "read_topic", lambda spark, topic, size, progress: started.update(size=size, topic=topic.topic))
    monkeypatch.setattr(jobs, "decode_avro", lambda *args: spark.range(0).selectExpr("'x' decode_status"))
    monkeypatch.setattr(jobs, "start_upsert", lambda stream, sink, at, **trigger: started.update(trigger=trigger, at=at, sink=sink))
    settings = JobSettings.from_env({**TABLES_AT, "SLEEP_INTERVAL_SECONDS": "2.5", "SINK_OUTPUT_TOPIC": "out"})
    jobs.upsert_job(spark, settings, None)
    assert started["trigger"] == {"processingTime": "0 seconds"}
    assert started["size"] == UpsertSettings().admitted == 50_000 and UpsertSettings().batch_size == 500
    assert started["at"] == "hdfs:///cdc/checkpoint" and started["sink"].publish
    assert spark.conf.get("spark.sql.streaming.pollingDelay") == "2500ms"
    spark.conf.unset("spark.sql.streaming.pollingDelay")


@pytest.mark.parametrize("name", ["orders", "lines", "customers"])
def test_latest_jobs_read_their_topic(spark, monkeypatch, name):
    from changeflow.streaming import jobs

    started = {}
    monkeypatch.setattr(jobs, "read_topic", lambda spark, topic, size, progress: started.update(topic=topic.topic))
    monkeypatch.setattr(
        jobs, "decode_avro",
        lambda topic, writers, event: spark.createDataFrame([], event).selectExpr("*", "'decoded' decode_status"),
    )
    monkeypatch.setattr(
        jobs.LatestTable, "start",
        lambda self, stream, at, **trigger: started.update(columns=stream.columns, at=at, publish=self.publish, **trigger),
    )
    settings = JobSettings.from_env({**TABLES_AT, "SINK_OUTPUT_TOPIC": "out"})
    jobs.latest_job(spark, settings, name, publish_changes=True)
    table, event, _, _ = jobs.LATEST[name]
    assert started["topic"] == f"cdc.dev.{table}" and started["columns"] == event.names
    assert started["at"] == f"hdfs:///cdc/latest/{name}/checkpoint" and started["publish"]
    assert started["processingTime"] == "0 seconds"
    spark.conf.unset("spark.sql.streaming.pollingDelay")


def test_frame_is_split_at_its_fixed_positions(spark):
    frame = bytes([0]) + (70000).to_bytes(4, "big") + b"payload"
    row = spark.createDataFrame([(frame,)], "value binary").select(
        *kafka.split_frame(F.col("value"))
    ).first()
    assert (row.marker, row.schema_id, bytes(row.body)) == ("00", 70000, b"payload")


def test_published_rows_keep_nulls(spark):
    frame = spark.createDataFrame([("O1", None)], "order_id string, customer_id string")
    row = kafka.published(frame).first()
    assert (row.key, row.value) == ("O1", '{"order_id":"O1","customer_id":null}')


def test_generated_events_have_the_asked_mix(spark):
    mix = generate.EventMix(delete_ratio=0.3, automatic_ratio=0.5)
    draws = spark.range(0, 20000, 1, 4).withColumnRenamed("id", "draw")
    events = generate.generated_events(draws, 20000, mix).cache()
    rows = events.orderBy("sequence").collect()
    assert [r.sequence for r in rows] == list(range(20000))
    share = lambda test: sum(map(test, rows)) / len(rows)
    assert abs(share(lambda r: r.link_origin == "A") - 0.5) < 0.03
    # Of 100 draws 30 delete, and 21 of the other 70 are pairs: 51 deletes in 121 events.
    assert abs(share(lambda r: r.op_type == "D") - 51 / 121) < 0.02
    steps = [b.op_ts - a.op_ts for a, b in zip(rows, rows[1:])]
    pairs = [
        (a, b) for a, b, step in zip(rows, rows[1:], steps) if step == 1
    ]
    assert pairs and all((a.op_type, b.op_type) == ("D", "I") for a, b in pairs)
    assert all(a.order_id == b.order_id for a, b in pairs)
    assert set(steps) - {1} <= {s * 1000 for s in range(1, 31)} | {s * 1000 - 1 for s in range(1, 31)}
    assert all(5 <= r.current_ts - r.op_ts <= 250 for r in rows)
    assert len({r.order_id for r in rows}) == 20 and len({r.customer_ref for r in rows}) == 8


def test_generation_does_not_depend_on_blocks_or_partitions(spark, monkeypatch):
    def rows(partitions):
        draws = spark.range(0, 500, 1, partitions).withColumnRenamed("id", "draw")
        return sorted(map(tuple, generate.generated_events(draws, 500).collect()))

    expected = rows(1)
    assert len(expected) == 500
    monkeypatch.setattr(generate, "BLOCK", 64)
    assert rows(5) == expected


def test_seeds_are_inserted_once(spark):
    none = spark.createDataFrame([], schemas.ORDERS)
    seeded = seeds.seed_orders(spark, none)
    rows = seeded.orderBy("id").collect()
    assert (rows[0].id, rows[0].external_order_id, len(rows)) == ("ORD-0001", "EXT-000001", 20)
    assert seeds.seed_orders(spark, seeded).count() == 0
    partly = seeds.seed_sources(spark).filter("id <> 2")
    assert [r.id for r in seeds.seed_sources(spark, partly).collect()] == [2]


def test_extraction_continues_after_its_bookmark(spark):
    first, second = datetime(2026, 1, 5), datetime(2026, 1, 6)
    table = spark.createDataFrame(
        [(1, first), (2, first), (3, second), (1, second)], "id bigint, updated_at timestamp"
    )
    mark = extract.Bookmark(first, 1)
    changes = extract.changed_rows(table, mark)
    assert sorted((r.id, r.updated_at) for r in changes.collect()) == [
        (1, second), (2, first), (3, second)
    ]
    assert extract.next_bookmark(changes) == extract.Bookmark(second, 3)
    assert extract.next_bookmark(extract.changed_rows(table, extract.Bookmark(second, 3))) is None
    assert extract.topic_name("orders") == "cdc.dev.orders"
    with pytest.raises(ValueError):
        extract.topic_name("payments")


def test_extraction_runs_resume_from_their_bookmark(spark, tmp_path):
    days = [datetime(2026, 1, d) for d in range(1, 6)]
    delivered, broken = [], []

    def deliver(topic, rows):
        if broken:
            raise RuntimeError(broken.pop())
        delivered.append((topic, sorted(r.id for r in rows.collect())))

    def table(*rows):
        return spark.createDataFrame(list(rows), "id bigint, updated_at timestamp")

    job = Extraction(spark, str(tmp_path), deliver, "test", gather_every=1)
    assert job.run("orders", table((1, days[0]), (2, days[0]))) == extract.Bookmark(days[0], 2)
    assert job.run("orders", table((1, days[0]), (2, days[0]))) is None
    assert job.run("customers", table((7, days[2]))) == extract.Bookmark(days[2], 7)
    rows = table((1, days[3]), (2, days[0]), (3, days[0]))
    broken.append("injected")
    with pytest.raises(RuntimeError, match="injected"):
        job.run("orders", rows)
    assert job.run("orders", rows) == extract.Bookmark(days[3], 1)
    assert job.bookmark("order_lines") is None
    assert delivered == [
        ("cdc.test.orders", [1, 2]), ("cdc.test.customers", [7]), ("cdc.test.orders", [1, 3])
    ]


def test_rows_without_an_update_time_are_delivered_once(spark, tmp_path):
    delivered = []

    def deliver(topic, rows):
        delivered.append(sorted(r.id for r in rows.collect()))

    def table(*rows):
        return spark.createDataFrame(list(rows), "id bigint, updated_at timestamp")

    day = datetime(2026, 1, 5)
    job = Extraction(spark, str(tmp_path), deliver, "test")
    rows = [(1, None), (2, day), (3, None)]
    assert job.run("orders", table(*rows)) == extract.Bookmark(day, 2)
    assert job.run("orders", table(*rows, (4, day))) == extract.Bookmark(day, 4)
    assert job.run("customers", table((1, None), (2, None))) == extract.BEGINNING
    assert job.run("customers", table((1, None), (2, None), (5, day))) == extract.Bookmark(day, 5)
    assert job.run("order_lines", table()) is None
    assert delivered == [[1, 2, 3], [4], [1, 2], [5]]


def test_extraction_pushes_its_bound_into_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.createDataFrame(
        [(1, datetime(2026, 1, 5))], "id bigint, updated_at timestamp"
    ).write.parquet(path)
    changes = extract.changed_rows(
        spark.read.parquet(path), extract.Bookmark(datetime(2026, 1, 5), 0)
    )
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updated_at" in plan.split("PushedFilters:")[1]

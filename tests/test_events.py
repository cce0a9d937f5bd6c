from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from changeflow import schemas
from changeflow.functions.values import trim_controls
from changeflow.operators import events
from changeflow.sources.kafka import decode_json

BASE = {
    "order_id": "o/77", "customer_ref": "c 5", "channel_id": "kiosk",
    "status": "OPEN", "event_date": "2031-07-19", "link_origin": "H", "op_type": "I",
    "op_ts": 1942000000417, "current_ts": 1942000000500,
}
CASES = [
    ({}, None),
    ({"op_type": "D"}, None),
    ({"op_type": "D", "link_origin": "A"}, None),
    ({"link_origin": "A"}, "automatic_insert"),
    ({"op_type": "U"}, "other_operation"),
    ({"op_type": "X"}, "other_operation"),
    ({"op_type": "i"}, "other_operation"),
    ({"op_type": None}, "other_operation"),
    ({"order_id": None}, "no_order"),
    ({"order_id": ""}, None),
    ({"link_origin": None}, None),
    ({"op_ts": None}, "no_timestamp"),
]


@pytest.fixture(scope="module")
def frame(spark):
    nullable = events_schema()
    rows = [
        tuple({**BASE, **change, "kafka_partition": 0, "kafka_offset": i}[n] for n in nullable.names)
        for i, (change, _) in enumerate(CASES)
    ]
    return spark.createDataFrame(rows, nullable)


def events_schema():
    from pyspark.sql import types as T

    fields = [*schemas.POSITION.fields, *schemas.ORDER_EVENT.fields]
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def test_filter_and_reject_reasons_agree_with_the_table(frame):
    reasons = dict(enumerate(reason for _, reason in CASES))
    kept = {r.kafka_offset for r in events.relevant(frame).collect()}
    refused = {r.kafka_offset: r.reject_reason for r in events.rejected(frame).collect()}
    assert kept == {i for i, reason in reasons.items() if reason is None}
    assert refused == {i: reason for i, reason in reasons.items() if reason}


def test_filter_on_a_columnar_log_reaches_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "log")
    frame.write.parquet(path)
    stored = spark.read.schema(events_schema()).parquet(path)
    plan = events.relevant(stored)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "IsNotNull(order_id)" in pushed and "In(op_type, [D,I])" in pushed


@pytest.mark.parametrize(
    "millis, text",
    [
        (1767600000000, "2026-01-05 08:00:00"),
        (1767600000999, "2026-01-05 08:00:00"),
        (-500, "1969-12-31 23:59:59"),
    ],
)
def test_timestamps_are_floored_to_the_second(frame, millis, text):
    record = events.normalised(frame.limit(1).withColumn("op_ts", F.lit(millis)))
    assert record.select(F.col("op_timestamp").cast("string")).first()[0] == text


def test_update_becomes_a_delete_and_an_insert_a_millisecond_apart(spark):
    image = "struct<order_id:string,customer_ref:string>"
    changes = spark.createDataFrame(
        [(1, "U", 10, ("O", "old"), ("O", "new")), (2, "I", 20, None, ("P", "x")),
         (3, "D", 30, ("Q", "y"), None)],
        f"n int, op_type string, op_ts bigint, before {image}, after {image}",
    )
    rows = events.expanded_updates(changes).orderBy("n", "op_ts").collect()
    assert [tuple(r) for r in rows] == [
        (1, "D", 10, "O", "old"), (1, "I", 11, "O", "new"), (2, "I", 20, "P", "x"),
        (3, "D", 30, "Q", "y"),
    ]


def test_json_payloads_are_told_apart(spark):
    minimal = {"order_id": "O", "link_origin": "M", "op_type": "D", "op_ts": 1767600000000}
    payloads = [
        (json.dumps(BASE), events.DECODED), (json.dumps(minimal), events.DECODED),
        (json.dumps({**minimal, "order_id": None}), events.DECODED),
        ("{}", events.EMPTY), ("null", events.EMPTY), (None, events.EMPTY),
        ('{"op_type": "I"}', events.MISSING_FIELD), ("[1]", events.UNDECODABLE),
        ('{"order_id": "O", ', events.UNDECODABLE), ("not json", events.UNDECODABLE),
    ]
    topic = spark.createDataFrame(
        [(0, i, value) for i, (value, _) in enumerate(payloads)],
        "kafka_partition int, kafka_offset bigint, value string",
    )
    rows = decode_json(topic).orderBy("kafka_offset").collect()
    assert [r.decode_status for r in rows] == [status for _, status in payloads]
    assert rows[1].customer_ref is None and rows[1].op_ts == 1767600000000
    counted = {
        r.kafka_offset: r.counted
        for r in events.rejected(decode_json(topic), "decode_status").collect()
    }
    assert counted == {2: True, 3: True, 4: True, 5: True, 6: True, 7: False, 8: False, 9: False}


def test_trim_strips_blanks_and_control_characters(spark):
    rows = spark.createDataFrame([(" \t\n a b \x00\r",), ("\xa0x",)], "t string")
    assert [r[0] for r in rows.select(trim_controls(F.col("t"))).collect()] == ["a b", "\xa0x"]

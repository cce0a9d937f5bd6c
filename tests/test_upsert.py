"""The set-based upsert against a row-by-row model, over random logs."""

from __future__ import annotations

import random

import model
import pytest
from pyspark.sql import functions as F
from test_events import events_schema

from changeflow import schemas
from changeflow.operators import apply, events, resolve
from changeflow.settings import UpsertSettings

SOURCES = {1: "operational-web", 2: "operational-phone", 12: "master-catalog", 7: "Operational"}
ORDERS = [("O1", 1), ("O1", 2), ("O2", 1), ("O3", 12), ("O4", 2), ("O5", 7), ("O6", 1)]
REFS = ["R1", "R2", "R3", "it's", " R1 ", "", None]
CUSTOMERS = [
    (model.key_of("R2"), "R2", 12),
    (model.digest("legacy|R2|"), "R2", 12),
    (model.key_of("R3"), "moved", 12),
    (model.key_of("R1"), "R1", 1),
]


def applied():
    return F.lit("2026-01-06 00:00:00").cast("timestamp")


def random_log(seed: int, size: int = 120) -> list[dict]:
    draw = random.Random(seed)
    return [
        {
            "kafka_partition": 0,
            "kafka_offset": i,
            "order_id": draw.choice(["O1", "O1", "O2", "O3", "O4", "O5", "O6", "unknown", None]),
            "customer_ref": draw.choice(REFS),
            "channel_id": None,
            "status": None,
            "event_date": None,
            "link_origin": draw.choice(["M", "M", "A", None]),
            "op_type": draw.choice(["I", "I", "D", "U"]),
            "op_ts": 1767600000000 + draw.randrange(4) * 500,
            "current_ts": 0,
        }
        for i in range(size)
    ]


@pytest.fixture(scope="module")
def references(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("references")

    def stored(name, frame):
        frame.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    when = "2025-01-01 00:00:00"
    orders = spark.createDataFrame(ORDERS, "id string, source_id int").select(
        "id", F.lit(None).cast("string").alias("external_order_id"), "source_id",
        F.lit("s").alias("source_name"), F.lit("NEW").alias("order_status"),
        F.lit(None).cast("date").alias("order_date"), F.lit(when).cast("timestamp").alias("created_at"),
        F.lit(when).cast("timestamp").alias("updated_at"),
    )
    sources = spark.createDataFrame(
        [(i, "s", kind, None) for i, kind in SOURCES.items()], schemas.SOURCES
    )
    customers = spark.createDataFrame(
        CUSTOMERS, "id string, external_customer_id string, source_id int"
    ).select(
        "id", F.lit("h").alias("customer_hash"), "external_customer_id", "source_id",
        F.lit("catalog").alias("source_name"), F.lit("").alias("customer_name"),
        F.lit("").alias("country_code"), F.lit("RESOLVED").alias("resolution_state"),
        F.lit(when).cast("timestamp").alias("created_at"),
        F.lit(when).cast("timestamp").alias("updated_at"),
    )
    return stored("orders", orders), stored("sources", sources), stored("customers", customers)


def modelled(log: list[dict], batch_size: int) -> model.Model:
    state = model.Model(ORDERS, SOURCES, CUSTOMERS)
    for start in range(0, len(log), batch_size):
        state.apply(log[start : start + batch_size])
    return state


def frame_of(spark, log):
    names = events_schema().names
    return spark.createDataFrame([tuple(e[n] for n in names) for e in log], events_schema())


def seconds(column="created_at"):
    return F.col(column).cast("bigint").alias("second")


def links_of(frame):
    rows = frame.select("order_source_id", "order_id", "customer_id", seconds()).collect()
    links = {(r[0], r[1]): (r[2], r[3]) for r in rows}
    assert len(links) == len(rows)
    return links


def candidate_sets(frame):
    rows = frame.select("order_source_id", "order_id", "customer_id", seconds()).collect()
    return none_first(tuple(r) for r in rows)


def flat(candidates):
    return none_first((*key, *row) for key, rows in candidates.items() for row in rows)


def none_first(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("seed, batch_size", [(1, 10), (2, 25), (3, 40), (4, 120), (5, 7)])
def test_log_forms_equal_the_row_by_row_replay(spark, references, seed, batch_size):
    log = random_log(seed)
    expected = modelled(log, batch_size)
    records = events.numbered_batches(
        events.normalised(events.relevant(frame_of(spark, log))), batch_size
    )
    args = (*references, UpsertSettings(batch_size=batch_size), applied())

    assert links_of(apply.links_from_log(records, *args)) == expected.links
    candidates = apply.candidates_from_log(records, *args)
    assert candidate_sets(candidates) == flat(expected.candidates)
    stage = resolve.staged(records, *args)
    history = apply.link_history_rows(stage).select(
        "order_source_id", "order_id", "customer_id",
        F.substring("audit_action", 5, 1).alias("op"), seconds(),
    )
    assert none_first([tuple(r) for r in history.collect()]) == none_first(expected.links_history)
    missing = resolve.missing_customers(records, references[2], args[3], applied())
    backfilled = {
        r.external_customer_id: (r.id, r.second)
        for r in missing.select("external_customer_id", "id", seconds()).collect()
    }
    assert backfilled == expected.backfilled


def test_incremental_steps_equal_the_row_by_row_replay(spark, references):
    log = random_log(9, 60)
    expected = modelled(log, 20)
    settings = UpsertSettings()
    links = spark.createDataFrame([], schemas.LINKS)
    candidates = spark.createDataFrame([], schemas.CANDIDATES)
    customers = references[2]
    for number, start in enumerate(range(0, 60, 20)):
        batch = frame_of(spark, log[start : start + 20])
        records = events.normalised(events.relevant(batch)).withColumn(
            "batch_no", F.lit(number).cast("bigint")
        )
        args = (references[0], references[1], customers, settings, applied())
        stage = resolve.staged(records, *args, positions=True)
        links = apply.replayed_links(links, stage)
        candidates = apply.refreshed_candidates(candidates, stage)
        missing = resolve.missing_customers(records, customers, settings, applied())
        customers = resolve.with_missing(customers, missing)
    assert links_of(links) == expected.links
    assert candidate_sets(candidates) == flat(expected.candidates)


def test_same_second_insert_then_delete_leaves_the_link_unless_milliseconds_count(
    spark, references
):
    def event(offset, op, ts):
        return {**random_log(0, 1)[0], "kafka_offset": offset, "order_id": "O2", "link_origin": "M",
                "customer_ref": "R1", "op_type": op, "op_ts": ts}

    log = [event(0, "I", 1767600000100), event(1, "D", 1767600000900)]
    records = events.numbered_batches(events.normalised(frame_of(spark, log)), 500)
    args = (*references, UpsertSettings(), applied())
    assert apply.links_from_log(records, *args).count() == 1
    assert apply.links_from_log(records, *args, precision="ms").count() == 0
    with pytest.raises(ValueError):
        apply.links_from_log(records, *args, precision="day")


def test_settings_reach_the_stage(spark, references):
    event = {**random_log(0, 1)[0], "order_id": "O2", "customer_ref": "R9", "op_type": "I",
             "link_origin": "M"}
    records = events.numbered_batches(events.normalised(frame_of(spark, [event])), 500)
    settings = UpsertSettings(catalog_source_id=77, link_score=9)
    row = resolve.staged(records, *references, settings, applied()).first()
    assert (row.link_score, row.customer_source_id, row.customer_id) == (9, 77, model.key_of("R9"))
    assert (row.link_rating, row.link_method, row.order_source_name) == (-1, "manual", "s")


def test_joins_are_never_cross_products(spark, references):
    records = events.numbered_batches(
        events.normalised(events.relevant(frame_of(spark, random_log(1)))), 10
    )
    args = (*references, UpsertSettings(), applied())
    for frame in (apply.links_from_log(records, *args), apply.candidates_from_log(records, *args)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan

"""The streaming jobs: atomic commits, recovery, redelivery, tombstones."""

from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import model
import pytest
from pyspark.sql import functions as F
from test_events import events_schema
from test_latest import line, lines_of, order, orders_of
from test_upsert import (
    candidate_sets, flat, frame_of, links_of, modelled, none_first, random_log, references, seconds,
)

from changeflow import schemas
from changeflow.operators import events
from changeflow.sources import kafka
from changeflow.sources.landing import land, read_landing
from changeflow.streaming.enriched import EnrichedView, mixed_topics
from changeflow.streaming.latest import LatestTable
from changeflow.streaming.load import load_log
from changeflow.streaming import tables as storage
from changeflow.streaming.outbox import Outbox
from changeflow.streaming.tables import GATHER_EVERY, CommitConflict, Head, Table, TableSet
from changeflow.streaming.upsert import (
    References, UpsertSink, Warehouse, bucketed, start_upsert,
)

__all__ = ["references"]


def job(spark, references, root, **options):
    orders, sources, customers = references
    warehouse = Warehouse(spark, f"{root}/warehouse", options.pop("gather_every", GATHER_EVERY))
    loaded = References(lambda: orders, lambda: sources, lambda: customers)
    return warehouse, UpsertSink(warehouse, loaded, "test", **options)


def check(warehouse, expected):
    assert links_of(warehouse.links()) == expected.links
    assert candidate_sets(warehouse.candidates()) == flat(expected.candidates)
    history = warehouse.candidates_history().select(
        "order_source_id", "order_id", "customer_id", seconds()
    )
    assert none_first(tuple(r) for r in history.collect()) == none_first(
        expected.candidates_history
    )
    links = warehouse.links_history().select(
        "order_source_id", "order_id", "customer_id",
        F.substring("audit_action", 5, 1).alias("op"), seconds(),
    )
    assert none_first(tuple(r) for r in links.collect()) == none_first(expected.links_history)
    backfilled = {
        r.external_customer_id: (r.id, r.second)
        for r in warehouse.backfilled_customers()
        .select("external_customer_id", "id", seconds())
        .collect()
    }
    assert backfilled == expected.backfilled


def batches(log, size):
    return [log[i : i + size] for i in range(0, len(log), size)]


def test_batches_equal_the_row_by_row_model_across_gatherings(spark, references, tmp_path):
    log = random_log(11, 80)
    warehouse, sink = job(spark, references, tmp_path, gather_every=2)
    for number, batch in enumerate(batches(log, 16)):
        sink(frame_of(spark, batch), number)
    parts = warehouse.tables.head().parts
    assert set(parts) == set(warehouse.tables.tables)
    assert all(any(p.buckets is not None for p in own) for own in parts.values())
    check(warehouse, modelled(log, 16))


def test_large_batches_take_the_unbroadcast_path(spark, references, tmp_path, monkeypatch):
    from changeflow.streaming import upsert

    monkeypatch.setattr(upsert, "BROADCAST_BYTES", 0)
    log = random_log(12, 40)
    warehouse, sink = job(spark, references, tmp_path)
    for number, batch in enumerate(batches(log, 20)):
        sink(frame_of(spark, batch), number)
    check(warehouse, modelled(log, 20))


@pytest.mark.parametrize("failing", ["write", "commit", "after_commit"])
def test_a_crash_repeats_the_batch_and_changes_nothing_else(
    spark, references, tmp_path, monkeypatch, failing
):
    log = random_log(13, 60)
    parts = batches(log, 20)
    warehouse, sink = job(spark, references, tmp_path)
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")

    def run():
        stream = read_landing(spark, topic, schemas.ORDER_EVENT)
        start_upsert(stream, sink, checkpoint).awaitTermination()

    land(frame_of(spark, parts[0]), topic)
    run()
    before = warehouse.tables.head()

    original = getattr(TableSet, "write" if failing == "write" else "commit")

    def broken(self, *args, **kwargs):
        if failing == "write" and args[0] != "order_customer_links":
            return original(self, *args, **kwargs)
        if failing == "after_commit":
            original(self, *args, **kwargs)
        raise RuntimeError("injected")

    land(frame_of(spark, parts[1]), topic)
    with monkeypatch.context() as patch:
        patch.setattr(TableSet, "write" if failing == "write" else "commit", broken)
        with pytest.raises(Exception, match="injected"):
            run()
    visible = warehouse.tables.head().version
    assert visible == before.version + (1 if failing == "after_commit" else 0)
    if failing != "after_commit":
        check(warehouse, modelled(parts[0], 20))

    run()
    assert warehouse.tables.head().version == before.version + 1
    check(warehouse, modelled(parts[0] + parts[1], 20))
    land(frame_of(spark, parts[2]), topic)
    run()
    check(warehouse, modelled(log, 20))


def test_redelivery_under_the_same_id_changes_nothing(spark, references, tmp_path):
    log = random_log(14, 30)
    warehouse, sink = job(spark, references, tmp_path)
    for _ in range(2):
        sink(frame_of(spark, log), 0)
    check(warehouse, modelled(log, 30))


def test_redelivery_as_a_new_batch_converges_and_grows_the_history(spark, references, tmp_path):
    log = random_log(15, 30)
    warehouse, sink = job(spark, references, tmp_path)
    for number in range(2):
        sink(frame_of(spark, log), number)
    check(warehouse, modelled(log + log, 30))
    assert links_of(warehouse.links()) == modelled(log, 30).links


def test_what_is_broadcast_is_measured_in_bytes(spark):
    from changeflow.streaming.kept import measured

    rows = [("x" * 100, 1), (None, 2), ("é", None)]
    count, size = measured(spark.createDataFrame(rows, "a string, b int"))
    assert count == 3 and size == 3 * 48 + 102
    assert measured(spark.createDataFrame([], "a string")) == (0, 0)


def test_a_batch_without_relevant_events_only_counts_and_rejects(spark, references, tmp_path):
    warehouse, sink = job(spark, references, tmp_path)
    sink(frame_of(spark, []), 0)
    assert warehouse.tables.head() == Head()
    automatic = [{**e, "op_type": "I", "link_origin": "A"} for e in random_log(16, 5)]
    sink(frame_of(spark, automatic), 1)
    assert set(warehouse.tables.head().parts) == {"rejects"}
    assert warehouse.counters("test") == {"read": 5, "skipped": 5, "flushes": 0}


def sources_frame(spark, *ids):
    return spark.createDataFrame([(i, "s", "t", None) for i in ids], schemas.SOURCES)


def test_of_two_writers_one_fails_and_neither_loses_rows(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path), {"t": Table(schemas.SOURCES)})
    first, second = tables.begin(), tables.begin()
    tables.write("t", sources_frame(spark, 1, 2, 3), first)
    tables.write("t", sources_frame(spark, 7, 8), second)
    tables.commit(first, "a", 0)
    with pytest.raises(CommitConflict):
        tables.commit(second, "b", 0)
    assert tables.head().applied == {"a": 0}
    assert sorted(r.id for r in tables.appended("t").collect()) == [1, 2, 3]
    again = tables.begin()
    tables.write("t", sources_frame(spark, 7, 8), again)
    tables.commit(again, "b", 0)
    assert sorted(r.id for r in tables.appended("t").collect()) == [1, 2, 3, 7, 8]


def test_what_a_version_opens_does_not_grow_with_their_number(spark, tmp_path):
    kinds = {"t": Table(schemas.SOURCES, ("id",)), "all": Table(schemas.SOURCES)}
    tables = TableSet(spark, str(tmp_path), kinds, gather_every=4)
    opened = []
    for number in range(60):
        attempt = tables.begin()
        rows = sources_frame(spark, number % 7, 100 + number)
        tables.write_all({"t": rows, "all": rows}, attempt)
        tables.gather(attempt)
        head = tables.commit(attempt, "a", number)
        opened.append({name: len(parts) for name, parts in head.parts.items()})
    assert max(o["t"] for o in opened) <= 4 and max(o["all"] for o in opened) <= 4 + 4
    written = sorted([n % 7 for n in range(60)] + list(range(100, 160)))
    assert sorted(r.id for r in tables.appended("all").collect()) == written
    assert sorted(r.id for r in tables.current("t").collect()) == [*range(7), *range(100, 160)]
    versions = {r.commit_version for r in tables.versions("all").collect()}
    assert versions == set(range(1, 61))
    late = {r.commit_version for r in tables.versions("all", after=57).collect()}
    assert late == {58, 59, 60}


def test_a_note_is_committed_beside_the_batches_of_others(spark, tmp_path, monkeypatch):
    tables = TableSet(spark, str(tmp_path), {"t": Table(schemas.SOURCES)})
    original, rival = TableSet.commit, [True]

    def raced(self, attempt, *args, **notes):
        if rival and notes:
            rival.pop()
            original(self, self.begin(), "rival", 0)
        return original(self, attempt, *args, **notes)

    monkeypatch.setattr(TableSet, "commit", raced)
    head = tables.noted("cursors", lambda kept: kept | {"x": 1})
    assert head.version == 2 and head.note("cursors") == {"x": 1} and head.holds("rival", 0)


def test_a_fresh_checkpoint_replays_the_topic(spark, references, tmp_path):
    log = random_log(23, 30)
    warehouse, sink = job(spark, references, tmp_path)
    topic = str(tmp_path / "topic")
    land(frame_of(spark, log), topic)
    for checkpoint in ("first", "first", "second"):
        stream = read_landing(spark, topic, schemas.ORDER_EVENT)
        start_upsert(stream, sink, str(tmp_path / checkpoint)).awaitTermination()
    assert warehouse.tables.head().version == 2
    check(warehouse, modelled(log + log, 30))
    assert links_of(warehouse.links()) == modelled(log, 30).links


def test_a_reader_pinned_to_a_version_sees_just_that(spark, references, tmp_path):
    log = random_log(17, 40)
    warehouse, sink = job(spark, references, tmp_path)
    sink(frame_of(spark, log[:20]), 0)
    pinned = warehouse.tables.head()
    sink(frame_of(spark, log[20:]), 1)
    assert links_of(warehouse.links(pinned)) == modelled(log[:20], 20).links
    assert links_of(warehouse.links()) == modelled(log, 20).links


def test_bucketed_orders_are_pruned_to_the_batch(spark, references, tmp_path):
    orders, sources, customers = references
    path = f"{tmp_path}/orders"
    bucketed(orders, 16).write.partitionBy("id_bucket").parquet(path)
    stored = References(
        lambda: spark.read.parquet(path), lambda: sources, lambda: customers, order_buckets=16
    )
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    sink = UpsertSink(warehouse, stored, "test")
    log = [{**e, "order_id": "O1"} for e in random_log(18, 10)]
    sink(frame_of(spark, log), 0)
    check(warehouse, modelled(log, 10))
    pruned = sink._orders(frame_of(spark, log))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "id_bucket" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert pruned.count() < orders.count()


def test_folders_go_once_no_kept_version_names_them(spark, references, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "KEPT_MANIFESTS", 2)
    log = random_log(19, 50)
    warehouse, sink = job(spark, references, tmp_path, gather_every=1)
    pinned = []
    for number, batch in enumerate(batches(log, 10)):
        sink(frame_of(spark, batch), number)
        pinned.append(warehouse.tables.head())
    check(warehouse, modelled(log, 10))
    assert links_of(warehouse.links(pinned[-2])) == modelled(log[:40], 10).links
    there = {p.name for p in (tmp_path / "warehouse/order_customer_links").iterdir()}
    named = {folder for head in pinned[-3:] for name, folder in head.folders() if name == "order_customer_links"}
    assert named <= there
    gone = {folder for name, folder in pinned[0].folders() if name == "order_customer_links"}
    assert not gone & there


def test_applied_rows_are_published_after_the_commit_and_again_if_that_failed(
    spark, references, tmp_path
):
    published, broken = [], [True]

    def publish(rows):
        if broken.pop():
            raise RuntimeError("injected")
        broken.append(False)
        published.append((warehouse.tables.head().version, rows.count()))

    warehouse, sink = job(spark, references, tmp_path, publish=publish)
    with pytest.raises(RuntimeError, match="injected"):
        sink(frame_of(spark, random_log(20, 20)), 0)
    broken.append(False)
    sink(frame_of(spark, random_log(20, 20)), 0)
    sink(frame_of(spark, []), 1)
    assert published == [(1, warehouse.links_history().count())]


def test_loading_a_log_continues_where_the_stream_stopped(spark, references, tmp_path):
    log = random_log(22, 60)
    warehouse, sink = job(spark, references, tmp_path)
    sink(frame_of(spark, log[:20]), 0)
    rest = events.numbered_batches(
        events.normalised(events.relevant(frame_of(spark, log[20:]))), 10
    )
    for _ in range(2):
        load_log(warehouse, sink.references, rest, "rest", datetime(2026, 1, 6))
    expected = modelled(log[:20], 20)
    for batch in batches(log[20:], 10):
        expected.apply(batch)
    check(warehouse, expected)


def test_skipped_events_are_counted_in_the_progress(spark, references, tmp_path):
    log = random_log(21, 30)
    warehouse, sink = job(spark, references, tmp_path)
    land(frame_of(spark, log), str(tmp_path / "topic"))
    stream = read_landing(spark, str(tmp_path / "topic"), schemas.ORDER_EVENT)
    query = start_upsert(stream, sink, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    counts = query.lastProgress["observedMetrics"]["events"]
    skipped = sum(not model.is_relevant(e) for e in log)
    assert (counts["read"], counts["skipped"]) == (30, skipped)


def test_latest_stream_emits_tombstones(spark, tmp_path):
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    table = LatestTable(
        spark, str(tmp_path / "table"), schemas.ORDER_EVENT, ["order_id"], ["status"], gather_every=2
    )
    arrivals = [
        [order(1, "a", status="NEW"), order(2, "b", status="NEW")],
        [order(3, "a", "D")],
        [order(4, "b", status="SHIPPED"), order(5, "c")],
        [order(6, "a", status="BACK")],
    ]
    seen = []
    for rows in arrivals:
        land(orders_of(spark, *rows), topic)
        table.start(read_landing(spark, topic, schemas.ORDER_EVENT), checkpoint).awaitTermination()
        seen.append({r.order_id: r.status for r in table.current().collect()})
        if len(seen) == 2:
            last = table.changes().filter("commit_version = 2").collect()
            assert [(r.order_id, r.op_type) for r in last] == [("a", "D")]
    changes = [(r.commit_version, r.order_id, r.op_type) for r in table.changes().collect()]
    assert sorted(changes) == [
        (1, "a", "I"), (1, "b", "I"), (2, "a", "D"), (3, "b", "I"), (3, "c", "I"), (4, "a", "I")
    ]
    assert seen == [
        {"a": "NEW", "b": "NEW"}, {"b": "NEW"}, {"b": "SHIPPED", "c": None},
        {"a": "BACK", "b": "SHIPPED", "c": None},
    ]


def test_latest_changes_are_published_after_the_commit(spark, tmp_path):
    published = []
    table = LatestTable(
        spark, str(tmp_path / "t"), schemas.ORDER_EVENT, ["order_id"], ["status"],
        publish=lambda rows: published.append(sorted((r.order_id, r.op_type) for r in rows.collect())),
    )
    for number, rows in enumerate(([order(1, "a"), order(2, "b")], [order(3, "a", "D")])):
        table.apply(table.changelog(orders_of(spark, *rows)), number, "test")
    table.apply(table.changelog(orders_of(spark, order(3, "a", "D"))), 1, "test")
    assert published == [[("a", "I"), ("b", "I")], [("a", "D")]]


def test_enriched_view_follows_a_change_on_any_side(spark, tmp_path):
    from test_latest import CUSTOMERS

    view = EnrichedView(spark, str(tmp_path / "view"), gather_every=2, buckets=4)
    customers = lambda *rows: spark.createDataFrame(list(rows), CUSTOMERS)
    empty = {"orders": orders_of(spark), "lines": lines_of(spark), "customers": customers()}

    def arrive(batch_id, **events):
        batch = mixed_topics({**empty, **events})
        view.apply(batch, batch_id, "test")
        changed = view.changes().groupBy().agg(F.max("commit_version")).first()[0]
        emitted = [r for r in view.changes().collect() if r.commit_version == changed]
        rows = {
            r.order_id: (r.customer_name, r.order_total and float(r.order_total))
            for r in view.current().collect()
        }
        return rows, {(r.order_key, r.deleted) for r in emitted}

    assert arrive(0, orders=orders_of(spark, order(1, "a", ref="C"), order(2, "b", ref="D"))) == (
        {"a": (None, None), "b": (None, None)}, {("a", False), ("b", False)},
    )
    assert arrive(1, customers=customers((0, 1, "C", "Ann", "ES", "S", "I"))) == (
        {"a": ("Ann", None), "b": (None, None)}, {("a", False)},
    )
    assert arrive(2, lines=lines_of(spark, line(1, "b", 1, 2, "2.00"))) == (
        {"a": ("Ann", None), "b": (None, 4.0)}, {("b", False)},
    )
    assert arrive(3, orders=orders_of(spark, order(9, "b", "D"))) == (
        {"a": ("Ann", None)}, {("b", True)},
    )
    assert arrive(4, customers=customers((0, 2, "C", "Ann", "ES", "S", "D"))) == (
        {"a": (None, None)}, {("a", False)},
    )
    assert arrive(5, orders=orders_of(spark, order(10, "b", ref="C"))) == (
        {"a": (None, None), "b": (None, 4.0)}, {("b", False)},
    )


def test_gathered_rows_are_kept_whole_and_read_by_bucket(spark, tmp_path):
    kinds = {"t": Table(schemas.SOURCES, lookup="id", buckets=8), "s": Table(schemas.SOURCES, ("id",), lookup="id", buckets=8)}
    tables = TableSet(spark, str(tmp_path), kinds, gather_every=2)
    for number in range(5):
        attempt = tables.begin()
        rows = [(i, "s", f"t{number}", None) for i in range(number * 10, number * 10 + 15)]
        tables.write_all(dict.fromkeys(kinds, spark.createDataFrame(rows, schemas.SOURCES)), attempt)
        tables.gather(attempt)
        tables.commit(attempt, "a", number)
    head = tables.head()
    assert sorted(r.id for r in tables.appended("t").collect()) == sorted(i for n in range(5) for i in range(n * 10, n * 10 + 15))
    state = {r.id: r.source_type for r in tables.current("s").collect()}
    assert state == {i: f"t{min(i // 10, 4)}" for i in range(55)}
    keys = spark.createDataFrame([(3,)], "id int")
    few = tables.current("s", head, tables.touched("s", keys, head))
    ids = [r.id for r in few.collect()]
    assert 3 in ids and len(ids) < 40
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "id_bucket" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_a_crash_and_another_writer_lose_nothing_of_the_outbox(spark, references, tmp_path):
    """One commits and crashes before publishing; another commits and gathers; one comes back."""
    log, published, broken = random_log(31, 60), [], [True]

    def publish(rows):
        if broken:
            broken.pop()
            raise RuntimeError("injected")
        published.extend(r.commit_version for r in rows.collect())

    warehouse, sink = job(spark, references, tmp_path, publish=publish)
    with pytest.raises(RuntimeError, match="injected"):
        sink(frame_of(spark, log[:20]), 0)
    orders, sources, customers = references
    other_tables = Warehouse(spark, f"{tmp_path}/warehouse", gather_every=1)
    other = UpsertSink(other_tables, References(lambda: orders, lambda: sources, lambda: customers), "other")
    other(frame_of(spark, log[20:40]), 0)
    sink(frame_of(spark, log[:20]), 0)
    assert len(published) == warehouse.links_history().count() and set(published) == {1, 2}
    sink(frame_of(spark, log[:20]), 0)
    sink(frame_of(spark, log[40:]), 1)
    assert len(published) == warehouse.links_history().count()


def test_consumers_read_on_from_cursors_of_their_own(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path), {"t": Table(schemas.SOURCES)}, gather_every=2)

    def add(number):
        attempt = tables.begin()
        tables.write("t", sources_frame(spark, number), attempt)
        tables.gather(attempt)
        tables.commit(attempt, "a", number)

    early, late, seen = Outbox(tables, "t", "early"), Outbox(tables, "t", "late"), []
    collect = lambda rows: seen.append(sorted(r.id for r in rows.collect()))
    assert early.deliver(collect) is None
    add(0)
    early.deliver(collect)
    late.start_here()
    add(1), add(2)
    late.deliver(collect), early.deliver(collect), early.deliver(collect), late.deliver(collect)
    assert seen == [[0], [1, 2], [1, 2]]


def test_batches_of_relevant_records_within_a_micro_batch(spark, references, tmp_path):
    from changeflow.settings import UpsertSettings

    log = random_log(32, 90)
    warehouse, sink = job(spark, references, tmp_path, settings=UpsertSettings(batch_size=7))
    kept = [e for e in log if model.is_relevant(e)]
    sink(frame_of(spark, log), 0)
    check(warehouse, modelled(kept, 7))
    assert warehouse.counters("test") == {
        "read": 90, "skipped": 90 - len(kept), "flushes": -(-len(kept) // 7)
    }


@pytest.mark.parametrize("ranges", [1, 3, 1000])
def test_relevance_cuts_number_the_records_in_topic_order(spark, ranges):
    rows = [(p, o) for o in (5, 6, 7, 1000, 1_000_000) for p in (0, 1, 2)] + [(0, 0), (4, 2**40)]
    frame = spark.createDataFrame(rows, "kafka_partition int, kafka_offset long").repartition(3)
    cut = events.batches_by_relevance(frame, 4, ranges).collect()
    expected = {(p, o): n // 4 for n, (o, p) in enumerate(sorted((o, p) for p, o in rows))}
    assert {(r.kafka_partition, r.kafka_offset): r.batch_no for r in cut} == expected
    nothing = events.batches_by_relevance(frame.limit(0), 4)
    assert nothing.columns[-1] == "batch_no" and nothing.count() == 0


def test_rejects_are_committed_with_the_batch(spark, references, tmp_path):
    log = random_log(33, 40)
    warehouse, sink = job(spark, references, tmp_path)
    undecoded = {**log[0], "kafka_offset": 99, "order_id": None, "op_type": None, "link_origin": None}
    decoded = frame_of(spark, log).withColumn("decode_status", F.lit("decoded"))
    broken = frame_of(spark, log[:1]).select(
        *[F.lit(undecoded[c]).cast(t).alias(c) for c, t in decoded.dtypes[:-1]], F.lit("undecodable").alias("decode_status")
    )
    for _ in range(2):
        sink(decoded.unionByName(broken), 0)
    check(warehouse, modelled(log, 40))
    rejects = {r.kafka_offset: (r.reject_reason, r.counted) for r in warehouse.rejects().collect()}
    assert set(rejects) == {e["kafka_offset"] for e in log if not model.is_relevant(e)} | {99}
    assert rejects[99] == ("undecodable", False) and warehouse.rejects().count() == len(rejects)
    assert warehouse.counters("test")["skipped"] == len(rejects) - 1


def test_the_view_reads_no_history_and_ignores_replays(spark, tmp_path, monkeypatch):
    """What a batch reads of an order is the same after ten lines and after a thousand."""
    from test_latest import CUSTOMERS

    found = {}
    stored = EnrichedView._stored

    def counted(self, name, *args):
        rows = stored(self, name, *args)
        found[name] = found.get(name, 0) + rows.count()
        return rows

    chunks = EnrichedView._chunks

    def counted_chunks(self, name, *args):
        rows = chunks(self, name, *args)
        found[name] = found.get(name, 0) + rows.count()
        return rows

    monkeypatch.setattr(EnrichedView, "_stored", counted)
    monkeypatch.setattr(EnrichedView, "_chunks", counted_chunks)
    read, batch_of = {}, {}
    for history in (10, 1000):
        view = EnrichedView(spark, str(tmp_path / f"view{history}"), gather_every=2, buckets=4, chunk=8)
        empty = {"orders": orders_of(spark), "lines": lines_of(spark), "customers": spark.createDataFrame([], CUSTOMERS)}
        first = mixed_topics({**empty, "orders": orders_of(spark, order(1, "a", ref="C"))})
        view.apply(first, 0, "t")
        many = [line(i, "a", i, 1, "2.00") for i in range(history)]
        view.apply(mixed_topics({**empty, "lines": lines_of(spark, *many)}), 1, "t")
        found.clear()
        more = mixed_topics({**empty, "lines": lines_of(spark, *[line(history + i, "a", history + i, 1, "2.00") for i in range(3)])})
        view.apply(more, 2, "t")
        read[history] = dict(found)
        shown = {r.lines_part: r for r in view.current().collect()}
        assert sorted(shown) == list(range(-(-(history + 3) // 8)))
        assert float(shown[0].order_total) == 2.0 * (history + 3)
        assert [x.line_number for p in sorted(shown) for x in shown[p].lines] == list(range(history + 3))
        # the same events under other checkpoints change nothing
        before = sorted(map(str, view.current().collect())), view.changes().count()
        for name, again in (("u", first), ("v", more)):
            view.apply(again, 0, name)
        assert (sorted(map(str, view.current().collect())), view.changes().count()) == before
    assert read[10] == read[1000]


def test_the_view_in_small_chunks_equals_the_whole_log(spark, tmp_path):
    """Random batches over few orders: lists of several parts, deletes, revivals, moved customers."""
    import random

    from test_latest import CUSTOMERS

    from changeflow.operators.enrich import enriched_from_logs

    draw, chunk = random.Random(41), 3
    view = EnrichedView(spark, str(tmp_path / "view"), gather_every=2, buckets=4, chunk=chunk)
    logs = {"orders": [], "lines": [], "customers": []}
    offset = 0
    for batch_id in range(4):
        new = {name: [] for name in logs}
        for _ in range(20):
            offset += 1
            op = draw.choice(["I", "I", "I", "I", "D", None])
            kind = draw.choice(["orders", "lines", "lines", "customers"])
            who = draw.choice(["a", "b", "c", None])
            if kind == "orders":
                new[kind].append(order(offset, who, op, draw.choice(["C", "D", " C ", "E", None]), f"s{offset}"))
            elif kind == "lines":
                new[kind].append(line(offset, who, offset % 5, draw.choice([1, 2, None]), "1.50", op))
            else:
                new[kind].append((0, offset, draw.choice(["C", "D", None]), f"n{offset}", "ES", "S", op))
        for name, rows in new.items():
            logs[name] += rows
        frames = {"orders": orders_of(spark, *new["orders"]), "lines": lines_of(spark, *new["lines"]),
                  "customers": spark.createDataFrame(new["customers"], CUSTOMERS)}
        view.apply(mixed_topics(frames), batch_id, "t")
        whole = enriched_from_logs(
            orders_of(spark, *logs["orders"]), spark.createDataFrame(logs["customers"], CUSTOMERS),
            lines_of(spark, *logs["lines"]), chunk=chunk,
        ).collect()
        got = view.current().collect()
        flat_lines = lambda rows: {o: [x for r in sorted((r for r in rows if r.order_id == o and r.lines is not None), key=lambda r: r.lines_part) for x in r.lines] for o in {r.order_id for r in rows}}
        flat_refs = lambda rows: {o: sorted(x for r in rows if r.order_id == o and r.customer_refs for x in r.customer_refs) for o in {r.order_id for r in rows}}
        head = lambda rows: sorted({(r.order_key, r.status, r.customer_ref, r.customer_name, r.customer_segment) for r in rows}, key=str)
        total = lambda rows: sorted(((r.order_id, r.order_total) for r in rows if r.order_total is not None), key=str)
        assert head(got) == head(whole) and total(got) == total(whole)
        assert flat_lines(got) == flat_lines(whole) and flat_refs(got) == flat_refs(whole)
        assert len({(r.order_id, r.lines_part, r.refs_part) for r in got}) == len(got)
    # a reader that follows the changes comes to the same view
    followed = {}
    for r in sorted(view.changes().collect(), key=lambda r: r.commit_version):
        followed.pop((r.order_key, r.part), None)
        if not r.deleted:
            followed[r.order_key, r.part] = (r.order_key, r.status, r.customer_name, r.lines, r.order_total)
    assert sorted(followed.values(), key=str) == sorted(
        ((r.order_key, r.status, r.customer_name, r.lines, r.order_total) for r in got), key=str
    )


def test_compaction_of_a_changelog_keeps_what_readers_need(spark, tmp_path):
    seen = []
    table = LatestTable(
        spark, str(tmp_path / "t"), schemas.ORDER_EVENT, ["order_id"], ["status"], gather_every=3,
        publish=lambda rows: seen.append(rows.count()),
    )
    arrivals = [
        [order(1, "a", status="1"), order(2, "b", status="1")], [order(3, "a", "D")], [order(4, "b", status="2")],
        [order(5, "c", status="1"), order(6, "b", "D")], [order(7, "c", status="2")],
    ]
    log = []
    for number, rows in enumerate(arrivals):
        log += rows
        keys = {r[2] for r in rows}
        state = table.changelog(orders_of(spark, *log)).filter(F.col("order_id").isin(*keys))
        table.apply(state, number, "test")

    def replayed():
        rows = sorted((r.commit_version, r.order_id, r.status, r.op_type) for r in table.changes().collect())
        last = {key: (status, op) for _, key, status, op in rows}
        return {key: value for key, value in last.items() if value[1] != "D"}, len(rows)

    state, before = replayed()
    versions = {r.commit_version for r in table.changes().collect()}
    clean = table.compact(horizon=3)
    # all versions but the newest are below the clean point; the delete of a is over, that of b not
    assert before == 7 and clean >= max(versions)
    assert replayed() == (state, 2)
    told = {(r.order_id, r.op_type): r.commit_version for r in table.changes().collect()}
    assert set(told) == {("b", "D"), ("c", "I")} and set(told.values()) <= versions
    table.apply(table.changelog(orders_of(spark, order(8, "a", status="9"))), 9, "test")
    assert seen[-1] == 1 and replayed()[0] == {**state, "a": ("9", "I")}


def test_a_revived_order_shows_older_values_only_within_the_horizon(spark, tmp_path):
    from changeflow.streaming.expiring import ExpiringLatestTable

    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    table = ExpiringLatestTable(
        spark, str(tmp_path / "t"), schemas.ORDER_EVENT, ["order_id"], ["customer_ref", "status"], 1000
    )

    def at(offset, order_id, when, op="I", ref=None, status=None):
        row = list(order(offset, order_id, op, ref, status))
        row[9] = when
        return tuple(row)

    arrivals = [
        [at(1, "soon", 0, ref="r", status="s"), at(2, "late", 0, ref="r", status="s"), at(3, "kept", 0, ref="r")],
        [at(4, "soon", 10, "D"), at(5, "late", 10, "D"), at(6, None, 0, ref="x")],
        [at(8, "soon", 1010, status="new"), at(9, "late", 1011, status="new"), at(10, "kept", 9000, status="t")],
    ]
    for rows in arrivals:
        land(orders_of(spark, *rows), topic)
        table.start(read_landing(spark, topic, schemas.ORDER_EVENT), checkpoint).awaitTermination()
    shown = {r.order_id: (r.customer_ref, r.status, r.op_type) for r in table.current().collect()}
    assert shown == {"soon": ("r", "new", "I"), "late": (None, "new", "I"), "kept": ("r", "t", "I")}


def test_key_order_is_watched_across_batches(spark, tmp_path):
    from changeflow.streaming.guard import KeyGuard

    guard = KeyGuard(spark, str(tmp_path / "g"), "k", gather_every=2, buckets=4)
    batch = lambda *rows: spark.createDataFrame(list(rows), "k string, kafka_partition int, kafka_offset long")
    arrivals = [
        batch((None, 0, 1), ("a", 0, 2), ("b", 1, 3), ("b", 2, 9)),
        batch(("a", 0, 3), ("a", 0, 2), ("b", 1, 4), ("c", 2, 1)),
        batch(("a", 1, 50), ("c", 2, 1), ("c", 2, 2)),
        batch(),
    ]
    for number, rows in enumerate(arrivals):
        guard.apply(rows, number, "t")
        guard.apply(rows, number, "t")
    found = sorted((r.key, r.kafka_partition, r.kafka_offset, r.violation) for r in guard.violations().collect())
    assert found == [("a", 0, 2, "backwards"), ("a", 1, 50, "moved"), ("b", 2, 9, "moved"), ("c", 2, 1, "backwards")]


def test_a_job_is_started_again_after_failures(spark, tmp_path, references):
    from pyspark.errors import StreamingQueryException

    from changeflow.streaming.jobs import kept_running

    log, broken = random_log(34, 20), [1, 2]
    warehouse, sink = job(spark, references, tmp_path)
    land(frame_of(spark, log), str(tmp_path / "topic"))

    def fragile(batch, batch_id):
        if broken:
            broken.pop()
            raise RuntimeError("injected")
        sink(batch, batch_id)

    def start():
        stream = read_landing(spark, str(tmp_path / "topic"), schemas.ORDER_EVENT)
        return start_upsert(stream, fragile, str(tmp_path / "checkpoint"))

    kept_running(start, restarts=2, pause=0)
    check(warehouse, modelled(log, 20))
    broken += [1, 2, 3]
    land(frame_of(spark, random_log(35, 5)), str(tmp_path / "topic"))
    with pytest.raises(StreamingQueryException):
        kept_running(start, restarts=1, pause=0)


def scanned_rows(frame):
    """Rows the file scans of a frame read."""
    execution = frame._jdf.queryExecution()
    execution.toRdd().count()
    leaves = execution.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_batch_reads_as_much_of_a_large_catalog_as_of_a_small_one(spark, references, tmp_path):
    """Row groups that hold none of a batch's references are skipped, at ten times the rows too."""
    from changeflow.sources.clustered import PUSHED, push_lookups, write_clustered

    orders, sources, _ = references
    push_lookups(spark)
    read = {}
    for times in (1, 10):
        number = F.col("id")
        made = spark.range(20_000 * times, numPartitions=4).select(
            F.md5(F.concat(F.lit("catalog|"), F.format_string("R%08d", number), F.lit("|"))).alias("id"),
            F.lit("h").alias("customer_hash"), F.format_string("R%08d", number).alias("external_customer_id"),
            F.lit(12).alias("source_id"), F.lit("catalog").alias("source_name"), F.lit("").alias("customer_name"),
            F.lit("").alias("country_code"), F.lit("RESOLVED").alias("resolution_state"),
            F.lit("2025-01-01").cast("timestamp").alias("created_at"), F.lit("2025-01-01").cast("timestamp").alias("updated_at"),
        )
        path = str(tmp_path / f"customers{times}")
        write_clustered(made, path, "external_customer_id", ("external_customer_id", "id"), group_rows=500)
        catalog = spark.read.parquet(path)
        log = [{**e, "order_id": "O1", "customer_ref": f"R{i * 7 % 3500:08d}"} for i, e in enumerate(random_log(61, 500))]
        log += [{**log[0], "customer_ref": "unheard of", "kafka_offset": 500}]
        loaded = References(lambda: orders, lambda: sources, lambda catalog=catalog: catalog)
        warehouse = Warehouse(spark, str(tmp_path / f"w{times}"))
        sink = UpsertSink(warehouse, loaded, "t")
        refs = frame_of(spark, log).select("customer_ref").distinct()
        near = sink._near(catalog, refs)
        read[times] = scanned_rows(near)
        assert near.count() == 500
        sink(frame_of(spark, log), 0)
        assert warehouse.backfilled_customers().select("external_customer_id").collect() == [("unheard of",)]
    spark.conf.unset(PUSHED)
    assert read[1] == read[10] < 10_000


def test_landing_keeps_the_fixed_schema(spark, tmp_path):
    land(frame_of(spark, random_log(1, 3)), str(tmp_path / "t"))
    stream = read_landing(spark, str(tmp_path / "t"), schemas.ORDER_EVENT, max_files=1)
    assert stream.isStreaming
    assert stream.columns == events_schema().names


def test_the_view_lists_crowded_orders_as_others(spark, tmp_path, monkeypatch):
    """Orders with more events in a batch than a task takes at once, before, after and beside others."""
    from changeflow.operators import latest
    from changeflow.streaming import enriched

    def events(number):
        at = 100 * number
        lines = [(0, at + i, f"o{i % 4 // 2 * (i % 3)}", i, "p", i, Decimal("2.00"), "I") for i in range(14)]
        orders = [(0, at + i, f"o{i % 3}", f"C{(number * i) % 7}", None, None, None, "A", "I", i, i) for i in range(12)]
        return mixed_topics({
            "lines": spark.createDataFrame(lines, schemas.positioned(schemas.LINE_EVENT)),
            "orders": spark.createDataFrame(orders, schemas.positioned(schemas.ORDER_EVENT)),
            "customers": spark.createDataFrame([], schemas.positioned(schemas.CUSTOMER_EVENT)),
        })

    def seen(name):
        view = EnrichedView(spark, str(tmp_path / name), gather_every=2, buckets=4, chunk=5)
        for number in range(2):
            view.apply(events(number), number, name)
        frames = (view.current(), view.lines_by_order(), view.customer_refs())
        return [sorted(tuple(map(str, r)) for r in f.collect()) for f in frames]

    def refused(*_):
        raise AssertionError("numbered line by line")

    with monkeypatch.context() as patch:
        patch.setattr(enriched, "numbered_in_order", refused)
        whole = seen("whole")
    monkeypatch.setattr(latest, "CROWDED", 2)
    assert seen("crowded") == whole


def one_by_one(state, events, horizon):
    """The state of an order after its events, applied in turn: two columns, operation, delete."""
    for _, _, at, op, *values in sorted(events, key=lambda e: (e[0], e[1])):
        if state[3] is not None and at is not None and at > state[3] + horizon:
            state = [None] * 4
        state = [old if new is None else new for old, new in zip(state[:2], values, strict=True)] + state[2:]
        if op is not None:
            state[2:] = [op, at if op == "D" else None]
    return state


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_expiring_states_of_all_keys_are_told_by_plans_as_event_by_event(spark):
    from changeflow.streaming.expiring import folded

    rng, offset = random.Random(5), 0
    schema = "order_id string, customer_ref string, status string, op_type string, deleted_at long"
    events_of = (
        "kafka_offset long, kafka_partition int, op_ts long, op_type string, "
        "customer_ref string, status string, order_id string"
    )
    states = {}
    for _ in range(3):
        arrived = []
        for _ in range(600):
            offset += rng.randint(0, 1)
            key = rng.choice([None, *"abcdefghijklmnopqrstuvwxyz"])
            pick = lambda *of: rng.choice(of)
            arrived.append((
                offset, len(arrived), pick(None, *[offset + rng.randint(0, 60)] * 8), pick(None, "I", "D", "D"),
                pick(None, None, f"r{offset}"), pick(None, None, None, f"s{offset}"), key,
            ))
        before = [(key, *state) for key, state in states.items()]
        now = folded(
            spark.createDataFrame(before, schema), spark.createDataFrame(arrived, events_of),
            ["order_id"], ["customer_ref", "status"], 25,
        )
        assert "Python" not in plan_of(now) and "Pandas" not in plan_of(now)
        for key in {e[-1] for e in arrived}:
            own = [e[:-1] for e in arrived if e[-1] == key]
            states[key] = one_by_one(states.get(key, [None] * 4), own, 25)
        assert {r[0]: list(r[1:]) for r in now.collect()} == {k: states[k] for k in {e[-1] for e in arrived}}
    assert any(s[3] is not None for s in states.values())


def test_deleted_keys_leave_the_state_a_horizon_after_they_arrived(spark, tmp_path):
    from changeflow.streaming.expiring import ExpiringLatestTable

    clock = [0.0]
    table = ExpiringLatestTable(
        spark, str(tmp_path / "t"), schemas.ORDER_EVENT, ["order_id"], ["customer_ref", "status"], 1000,
        gather_every=1, buckets=2, clock=lambda: clock[0],
    )

    def at(offset, order_id, when, op="I", ref=None, status=None):
        row = list(order(offset, order_id, op, ref, status))
        row[9] = when
        return tuple(row)

    def kept():
        return {r.order_id for r in table.tables.current("state").collect()}

    arrivals = [
        (0, [at(1, "gone", 0, ref="r"), at(2, "gone", 1, "D"), at(3, "soon", 0, ref="q"), at(4, "soon", 1, "D")]),
        (0.9, [at(5, "soon", 2, status="s"), at(6, "other", 0, ref="o")]),
        (1.5, [at(7, "other", 3, "D")]),
        (1.6, [at(n, f"k{n}", 3) for n in range(8, 16)]),
    ]
    for number, (second, rows) in enumerate(arrivals):
        clock[0] = second
        for _ in range(2):  # a batch delivered again changes nothing
            table.apply(orders_of(spark, *rows), number, "test")
        assert ("gone" in kept()) == (number < 3)
    assert {"soon", "other"} <= kept()
    clock[0] = 1.7
    table.apply(orders_of(spark, at(16, "gone", 4, status="n"), at(17, "other", 4, status="n")), 4, "test")
    shown = {r.order_id: (r.customer_ref, r.status) for r in table.current().collect() if r.order_id[0] != "k"}
    assert shown == {"gone": (None, "n"), "soon": ("q", "s"), "other": ("o", "n")}


def test_a_published_record_is_parsed_once(spark, tmp_path):
    from changeflow.plans.streams import _told

    told = ("order_source_id", "order_id", "customer_id", "audit_action", "link_score", "created_at")
    rows = [("2", 'a"\\b', None, "CDC_INSERT", 0.75, "x\ny"), ("1", "ö", "c", "CDC_DELETE", 1e-9, "")]
    applied = spark.createDataFrame(rows, ", ".join(f"{c} {'double' if c == 'link_score' else 'string'}" for c in told))
    records = kafka.published(applied)
    records.write.parquet(str(tmp_path / "published"))
    frame = _told(spark, str(tmp_path))
    alone = records.select("key", *[F.get_json_object("value", f"$.{c}").alias(c) for c in told])
    assert frame.columns == alone.columns and sorted(map(str, frame.collect())) == sorted(map(str, alone.collect()))
    assert plan_of(frame).count("json") == 1


def test_a_gathered_table_is_written_by_several_tasks(spark, tmp_path):
    schema = schemas.struct(a=schemas.LONG, b=schemas.LONG)
    tables = TableSet(spark, str(tmp_path / "t"), {"log": Table(schema)}, 1)
    attempt = tables.begin()
    rows = spark.range(3_000_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"))
    tables.write("log", rows, attempt)
    tables.gather(attempt)
    tables.commit(attempt)
    files = list((tmp_path / "t" / "log").glob("*-gathered/*/*.parquet"))
    assert len(files) > 1 and tables.appended("log").count() == 3_000_000


@pytest.mark.parametrize("failing", [1, 2, 4])
def test_only_the_planned_failure_is_passed_over(spark, monkeypatch, failing):
    from changeflow.plans import streams

    runs = []

    def start(stream, sink, checkpoint):
        runs.append(sink)

        def broken(batch, batch_id):
            raise RuntimeError("not planned")

        return start_upsert(stream, broken if len(runs) == failing else sink, checkpoint)

    monkeypatch.setattr(streams, "start_upsert", start)
    with pytest.raises(Exception, match="not planned"):
        streams.rejects_stream(spark, "/root/testdata/sf0.001")
    assert len(runs) == failing


def held_bytes(spark):
    """What persisted frames take in memory and on the executors' disks."""
    return sum(i.memSize() + i.diskSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())


def test_the_view_persists_nothing_that_grows_with_a_batch(spark, tmp_path, monkeypatch):
    from test_latest import CUSTOMERS

    held, gather = [], TableSet.gather

    def watched(self, attempt):
        held.append(held_bytes(spark))
        gather(self, attempt)

    monkeypatch.setattr(TableSet, "gather", watched)
    view = EnrichedView(spark, str(tmp_path / "view"), buckets=4)
    empty = {"orders": orders_of(spark), "lines": lines_of(spark), "customers": spark.createDataFrame([], CUSTOMERS)}
    arrivals = [
        {"orders": orders_of(spark, *[order(n, f"o{n}", ref=f"c{n % 300}") for n in range(2000)])},
        {"lines": lines_of(spark, *[line(n, f"o{n % 2000}", n) for n in range(6000)])},
        {"orders": orders_of(spark, *[order(2000 + n, f"o{n}", ref=f"c{n % 7}") for n in range(2000)])},
    ]
    before = held_bytes(spark)
    for number, arrival in enumerate(arrivals):
        view.apply(mixed_topics({**empty, **arrival}), number, "t")
    assert len(held) == 3 and max(held) - before < 4096
    assert view.lines_by_order().count() == 2000


def test_one_version_of_a_table_is_its_state(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path), {"t": Table(schemas.SOURCES, ("id",))}, gather_every=2)

    def write(number, *ids):
        attempt = tables.begin()
        tables.write("t", sources_frame(spark, *ids), attempt)
        tables.gather(attempt)
        tables.commit(attempt, "a", number)
        return sorted(r.id for r in tables.current("t").collect())

    assert write(0, 1, 2, 2) == [1, 2, 2]
    assert "Join" not in plan_of(tables.current("t")) and "Aggregate" not in plan_of(tables.current("t"))
    assert write(1, 2, 3) == [1, 2, 3]
    assert all(p.buckets is not None for p in tables.head().parts["t"])
    assert write(2, 3, 3, 4) == [1, 2, 3, 3, 4]


def test_sorted_keys_are_not_broadcast_for_their_small_files(spark, tmp_path):
    def keys(name):
        rows = spark.range(0, 1_500_000, 1, 1).select(F.format_string("ORD-%012d", "id").alias("order_id"))
        rows.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    a, b = keys("a"), keys("b")
    size = sum(f.stat().st_size for f in (tmp_path / "a").glob("*.parquet"))
    plan = a.join(b, "order_id")._jdf.queryExecution().executedPlan().toString()
    assert size < 10 << 20 and "SortMergeJoin" in plan


def test_reading_a_large_row_group_takes_no_direct_memory_of_its_size(spark, tmp_path):
    management = spark.sparkContext._jvm.java.lang.management
    pools = management.ManagementFactory.getPlatformMXBeans(spark.sparkContext._jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean"))

    def direct():
        return sum(p.getMemoryUsed() for p in pools if p.getName() == "direct")

    # one file of one row group, and one task that reads it
    spark.range(0, 5_000_000, 1, 1).select(F.xxhash64("id").alias("a")).write.parquet(str(tmp_path / "t"))
    assert sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet")) > 32 << 20
    before = direct()
    spark.read.parquet(str(tmp_path / "t")).agg(F.sum(F.col("a") % 7)).collect()
    assert direct() - before < 16 << 20

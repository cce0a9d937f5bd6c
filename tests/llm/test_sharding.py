"""Virtual slots and the edited slot-to-shard map."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from changeflow.llm import queries, sharding

SF_DIR = "/root/testdata/sf0.001"


def test_query_places_every_document(spark):
    documents = {
        r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    }
    rows = queries.op2_virtual_slot_sharding(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    slots, load = defaultdict(list), defaultdict(int)
    for r in rows:
        data = documents[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 24
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len(t.encode()) + 8 for t in documents.values())
    assert max(load.values()) - min(load[s] for s in range(24)) <= largest


def test_nulls_ties_and_clashing_names(spark, tmp_path):
    rows = [(1, "a", 5, 9), (1, "a", 6, 9), (1, "b", 7, 9), (None, None, 8, 9), (None, "", 9, 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, slot int, size int")
    got = sharding.sharded(frame, 3, f"{tmp_path}/some", 16).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t, _, _ in rows
    )
    for shard in {r["shard"] for r in got}:
        own = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert own == list(range(len(own)))
    assert sharding.sharded(frame.limit(0), 3, f"{tmp_path}/none", 16).collect() == []


def test_equal_rows_are_spread(spark, tmp_path):
    """A third of the rows equal, a sixth with null ids: shards still get equal bytes."""
    frame = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 6 = 1 THEN NULL ELSE id END AS doc_id",
        "CASE WHEN id % 3 = 0 OR id % 6 = 1 THEN repeat('x', 100) ELSE concat('text ', id) END AS text",
    )
    rows = sharding.sharded(frame, 24, str(tmp_path)).collect()
    assert len(rows) == 9000
    load, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(load) == 24 and max(load.values()) - min(load.values()) <= 2 * 108
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.SlotMap.load(spark, f"{tmp_path}/map").version == 1


def test_rebalancing_edits_and_stores_versions(spark, tmp_path):
    weights = np.arange(1, 101)
    first = sharding.SlotMap.balanced(weights, 4)
    first.store(spark, f"{tmp_path}/map")
    grown = first.rebalanced(weights, 5)
    load = np.bincount(grown.shard_of, weights, 5)
    assert grown.version == 1 and load.max() - load.min() <= 10
    moved = first.shard_of != grown.shard_of
    assert moved.sum() <= 25  # a fifth of the slots and little more
    grown.store(spark, f"{tmp_path}/map")
    shrunk = grown.rebalanced(weights, 3)
    assert set(shrunk.shard_of) == {0, 1, 2}
    assert sharding.SlotMap.load(spark, f"{tmp_path}/map").version == 1
    loaded = sharding.SlotMap.load(spark, f"{tmp_path}/map", 0)
    assert loaded.shards == 4 and (loaded.shard_of == first.shard_of).all()

"""SimHash classes against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from changeflow.llm import queries, simhash

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(values, ids, distance=2):
    """Per row, the least id that links lead to, by comparing all pairs."""
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [least.get(root(i)) for i in range(len(values))]


@pytest.mark.parametrize("text", ["", "  \t", "One", "One TWO", "a b c", "a b c a b c a b c ÄB é", "x " * 70000])
def test_fingerprint_of_a_text(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_query_agrees_with_all_pairs(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    ids, values = [d.doc_id for d in documents], [plain_fingerprint(d.text) for d in documents]
    least = least_reachable(values, ids)
    found = queries.op11_pigeonring_simhash(spark, SF_DIR).collect()
    assert sorted(map(tuple, found)) == sorted(zip(ids, [f"{v:016x}" for v in values], least, strict=True))


def clustered(rng, centres, members, bits):
    """Fingerprints around centres, and some of any place."""
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(members):
            flips = rng.sample(range(64), rng.randrange(bits + 1))
            out.add(centre ^ sum(1 << f for f in flips))
    return sorted(out | {rng.getrandbits(64) for _ in range(50)} | {0, 1, (1 << 64) - 1})


def labels_of(values, edges):
    label = {v: v for v in values}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for a, b in edges:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(v) for v in values]


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_connect_what_all_pairs_do(spark, distance):
    values = clustered(random.Random(distance), 12, 25, 5)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(frame, distance).collect()]
    brute = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= distance]
    assert labels_of(values, found) == labels_of(values, brute)


def test_dense_key_links_without_pairs(monkeypatch):
    """Thousands of fingerprints that agree in two segments: looked up, linked, one edge each."""
    ring, rng = simhash.Ring(2), random.Random(5)
    index = {rng.getrandbits(12) for _ in range(900)} | {1 << 20, (1 << 20) + 3}
    place = ring.places[2][0]
    index = np.array([v << place for v in index], np.uint64)
    bit = np.uint64(1 << ring.places[1][3])
    probes = np.array([rng.getrandbits(14) << place for _ in range(200)], np.uint64)
    probes = np.unique(probes)
    index = index | bit
    edges = {}
    for dense in (1, 1 << 30):
        monkeypatch.setattr(simhash, "DENSE", dense)
        one, other = simhash.linked(ring, 0, index, probes)
        assert len(one) < len(index) + len(probes)
        edges[dense] = list(zip(one.tolist(), other.tolist(), strict=True))
    nodes = sorted({*index.tolist(), *probes.tolist()})
    brute = [(a, b) for a in index.tolist() for b in nodes if (a ^ b).bit_count() <= 2]
    assert labels_of(nodes, edges[1]) == labels_of(nodes, edges[1 << 30]) == labels_of(nodes, brute)


@pytest.mark.parametrize("seed", range(5))
def test_every_close_pair_has_a_viable_chain(seed):
    rng = random.Random(seed)
    for distance in (1, 2, 3, 5):
        ring = simhash.Ring(distance)
        for _ in range(200):
            x = sum(1 << b for b in rng.sample(range(64), rng.randrange(distance + 1)))
            assert any(ring.viable(p, np.array([x], np.uint64))[0] for p in range(ring.parts))
        beyond = np.array([sum(1 << b for b in rng.sample(range(64), distance + 1))], np.uint64)
        assert not any(ring.viable(p, beyond)[0] for p in range(ring.parts))


def test_keys_meet_in_one_way():
    """Of two values that differ by one bit in the second segment, one finds the other, once."""
    ring = simhash.Ring(2)
    a = np.uint64(0x123456789ABCDEF0)
    b = a ^ np.uint64(1 << ring.places[1][2])
    rows = [(p, int(k), probe, int(v)) for p, ks, probe, vs in ring.keys(np.array([a, b], np.uint64)) for k, v in zip(ks, vs, strict=True)]
    own = {(p, k): v for p, k, probe, v in rows if not probe and p == 0}
    hits = [(v, own[p, k]) for p, k, probe, v in rows if probe and (p, k) in own and own[p, k] != v]
    assert len(hits) == 1


def test_edges_of_keys_cut_by_batches(spark):
    values = np.arange(3000, dtype=np.int64) << 45
    frame = spark.createDataFrame(pa.table({"fingerprint": values}).to_pandas())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        labels = {r.node: r.label for r in simhash.components(simhash.links(frame, 2)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert set(labels.values()) == {0} and len(labels) == 3000


def test_nulls_repeats_and_other_columns(spark):
    long = "word " * 30
    rows = [(5, None, 1), (4, "", 1), (None, "   ", 2), (7, long, 3), (7, long, 3), (None, long + "x", 4), (9, "other text altogether", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    found = sorted(map(tuple, simhash.classes(frame).select("doc_id", "component_id").collect()), key=str)
    values = [plain_fingerprint(t) for _, t, _ in rows]
    expected = list(zip([r[0] for r in rows], least_reachable(values, [r[0] for r in rows]), strict=True))
    assert found == sorted(expected, key=str)
    only_null = spark.createDataFrame([(None, "a b c")], "doc_id long, text string")
    assert simhash.classes(only_null).first().component_id is None


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, label string")
    assert simhash.classes(frame).collect() == []

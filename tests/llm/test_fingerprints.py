"""Multiset fingerprints."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from changeflow.llm import fingerprints, queries
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


def expected(rows):
    """Edited texts by the rule of the contract, without Spark."""
    ordered = sorted(
        ((i, t or "") for i, t in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
        reverse=True,
    )
    out = []
    for at, (doc_id, text) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        third = len(text) // 3
        out.append((doc_id, text, text[: len(text) - third] + following[:third], following))
    return out


def exact_likeness(one, other):
    a, b = (Counter(p for p in re.split(r"\n|(?<=[.!?])\s+", t) if p) for t in (one, other))
    size = sum(v * v for v in a.values()) + sum(v * v for v in b.values())
    return 1.0 if not size else 1 - sum((a[p] - b[p]) ** 2 for p in a | b) / size


def check(got, rows):
    wanted = expected(rows)
    key = lambda r: (r[0] is None, r[0], r[1], r[2])
    assert sorted(
        ((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=key
    ) == sorted(((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in wanted), key=key)
    prints = {}
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, text, edited, following in wanted:
        r = by_id[doc_id]
        for t, p in ((text, r["fingerprint"]), (edited, r["edited_fingerprint"])):
            assert prints.setdefault(t, p) == p
        assert abs(r["near_edited"] - exact_likeness(text, edited)) < 0.6
        assert abs(r["near_next"] - exact_likeness(text, following)) < 0.6
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if text == edited:
            assert r["near_edited"] == 1
    assert len(set(prints.values())) == len({tuple(sorted(re.split(r"\n|(?<=[.!?])\s+", t))) for t in prints})


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_every_document_meets_its_next(spark, ranges):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    check(fingerprints.with_edits(documents, ranges).collect(), rows)


def test_odd_rows(spark):
    rows = [(5, "One. Two.\nThree"), (None, None), (-(1 << 40), ""), (1 << 60, "Ünï cødé. " * 3000), (7, "x")]
    frame = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, n_chars int, vector string")
    for ranges in (1, 2, 8):
        check(fingerprints.with_edits(frame, ranges).collect(), rows)
        check(fingerprints.with_edits(frame.limit(1), ranges).collect(), rows[:1])
    assert fingerprints.with_edits(frame.limit(0), 4).collect() == []
    twice = frame.union(frame)
    assert fingerprints.with_edits(twice, 4).count() == 2 * len(rows)
    assert fingerprints.with_edits(twice.withColumn("doc_id", F.lit(None).cast("long")), 4).count() == 10


def test_paragraphs_are_inserted_and_deleted(spark):
    parts = [f"Paragraph {i % 7} of it." for i in range(20)]
    shuffled = random.Random(3).sample(parts, 20)
    frame = spark.createDataFrame(
        [(1, "\n".join(parts)), (2, "\n".join(shuffled)), (3, "\n".join(parts[:12])), (4, "\n".join(parts[12:]))],
        "k int, text string",
    )
    vectors = fingerprints.fingerprints(frame, "k")
    one, two, three, four = (r["vector"] for r in vectors.orderBy("k").collect())
    assert one == two
    row = spark.range(1).select(
        fingerprints.inserted(F.lit(three), F.lit(four)).alias("sum"),
        fingerprints.deleted(F.lit(one), F.lit(four)).alias("rest"),
        fingerprints.likeness(F.lit(one), F.lit(two)).alias("same"),
    ).first()
    assert row["sum"] == one and row["rest"] == three and row["same"] == 1.0


def test_query_stays_in_the_jvm(spark):
    plan = queries.op1_multiset_fingerprints(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))

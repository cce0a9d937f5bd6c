"""Repeated passages against a count of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from changeflow.llm import queries, substrings
from compare import differences, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


def brute_force(texts, window):
    """(words, kept words) of each text."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[s : s + window]) for w in words for s in range(len(w) - window + 1))
    out = []
    for w in words:
        stays = np.ones(len(w), bool)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] > 1:
                stays[s : s + window] = False
        out.append((len(w), [x for x, y in zip(w, stays, strict=True) if y]))
    return out


def digest(words):
    return hashlib.sha256(b" ".join(words)).hexdigest()


def test_query_removes_what_stands_elsewhere(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    found = brute_force([r["text"] for r in rows], 35)
    wanted = {
        r["doc_id"]: (n, n - len(kept), digest(kept)) for r, (n, kept) in zip(rows, found, strict=True)
    }
    got = queries.op5_repeated_passages(spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == wanted
    assert len(got) == len(rows)


def test_query_matches_its_oracle(spark):
    frame = queries.op5_repeated_passages(spark, SF_DIR)
    sql = queries.ORACLE["op5_repeated_passages"]
    assert differences(frame, oracle_connection(SF_DIR), sql) == ""


def test_search_matches_its_oracle(spark):
    frame = queries.op6_segment_search(spark, SF_DIR)
    sql = queries.ORACLE["op6_segment_search"]
    assert differences(frame, oracle_connection(SF_DIR), sql) == ""


@pytest.mark.parametrize("seed", range(6))
def test_small_windows_of_few_words(spark, seed):
    rng = random.Random(seed)
    window, size = rng.choice([(4, 2), (5, 3), (9, 4), (6, 6), (7, 1)])
    vocabulary = [f"w{i}" for i in range(rng.choice([2, 5, 30, 300]))]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(40))) for _ in range(60)]
    for _ in range(30):  # passages that several texts share
        part = rng.choice(texts)[rng.randrange(20) :]
        at = rng.randrange(len(texts))
        texts[at] = f"{part} {texts[at]}" if rng.random() < 0.5 else f"{texts[at]}\n{part}"
    texts += [texts[3], None, "", " \t", "no break space " * 20, "a " * 200]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)] + [(3, texts[3], 9, "same row")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start int, anchor string")
    wanted = brute_force([r[1] for r in rows], window)
    got = substrings.without_repeats(frame, window, size).collect()
    key = lambda r: (r[0], r[1], r[2])
    assert sorted(
        ((r["doc_id"], r["_n_words"], r["_n_removed"], r["_kept"]) for r in got), key=key
    ) == sorted(
        ((r[0], n, n - len(k), b" ".join(k).decode()) for r, (n, k) in zip(rows, wanted, strict=True)),
        key=key,
    )


def test_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(50))
    frame = spark.createDataFrame([(None, text), (None, text), (1, None)], "doc_id long, text string")
    got = substrings.without_repeats(frame).collect()
    assert sorted((r["_n_words"], r["_n_removed"]) for r in got) == [(0, 0), (50, 50), (50, 50)]
    assert substrings.without_repeats(frame.limit(0)).collect() == []

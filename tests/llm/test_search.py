"""Exact top-k search."""

from __future__ import annotations

import numpy as np
from changeflow.llm import queries, search

SF_DIR = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, score string"


def brute_force(rows, every, k):
    usable = {}
    for vec_id, vector in rows:
        if vec_id is None or vector is None or not all(x is not None and np.isfinite(x) for x in vector):
            continue
        if any(abs(x) * 256 >= search.WHOLE for x in vector):
            continue
        usable.setdefault(vec_id, []).append(np.floor(256 * np.array(vector, np.float64)).astype(int))
    out = []
    for query in sorted(i for i in usable if i % every == 0):
        own = min(usable[query], key=tuple)
        found = []
        for other, copies in usable.items():
            for v in copies if other != query else ():
                n = min(len(own), len(v))
                found.append((-int(own[:n] @ v[:n]), other))
        out += [(query, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return out


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("query_id", "rank", "vec_id", "score").collect())


def test_query_is_exact(spark):
    rows = [
        (r["vec_id"], r["embedding"])
        for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ]
    assert rows_of(queries.op6_segment_search(spark, SF_DIR)) == brute_force(rows, 50, 5)


def test_odd_vectors_ties_and_blocks(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=6).round(2).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(40)]  # copies that tie
    rows += [(None, [1.0] * 6), (1000, None), (1002, [1.0, None]), (1004, [float("nan")] * 6), (1006, [float("inf")])]
    rows += [(1016, [1e30] * 6), (1020, [-600000.0]), (4, rows[9][1]), (7, rows[11][1]), (8, rows[8][1])]  # too large, repeated ids
    rows += [(1008, [3.0]), (1010, []), (1012, [-9.0] * 6), (1014, [50000.0] * 6)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS)
    vectors = search.whole_vectors(frame, 256).repartition(5)
    wanted = brute_force(rows, 4, 3)
    asked = vectors.where("vec_id % 4 = 0")
    for block, sample, tile in ((8192, 16384, (1024, 512)), (10, 20, (7, 3)), (1000, 2, (64, 64))):
        monkeypatch.setattr(search, "QUERY_BLOCK", block)
        monkeypatch.setattr(search, "SAMPLE", sample)
        monkeypatch.setattr(search, "TILE", tile)
        assert rows_of(search.top_k(vectors, asked, 3, f"{tmp_path}/{block}")) == wanted
    for i, (some, own) in enumerate([(0, 0), (9, 0)]):
        assert search.top_k(vectors.limit(some), asked.limit(own), 3, f"{tmp_path}/none{i}").collect() == []
    one = vectors.where("vec_id = 12")
    assert search.top_k(one, one, 3, f"{tmp_path}/one").collect() == []


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(-300, 300, (50, 37)) for _ in range(2))
    exact = a @ b.T
    last = None
    for parts in search.RESOLUTIONS:
        bound = search._statistics(a, parts) @ search._statistics(b, parts).T
        assert (bound >= exact - 1e-6).all()
        assert last is None or bound.mean() <= last
        last = bound.mean()

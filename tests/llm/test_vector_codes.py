"""Vector codes against a plain Lloyd's, and their SQL."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from changeflow.llm import queries, vector_codes
from compare import differences, oracle_connection
from hypothesis import given, settings
from hypothesis import strategies as st

SF_DIR = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<double>, label string, code int"


def plain(rows, parts, entries, rounds, scale):
    """(vec_id, code, error, label_error) of every usable row, and all entries, by full scans."""
    kept = [
        (i, label, [math.floor(scale * x) for x in v])
        for i, v, label, *_ in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = max(1, -(-max((len(v) for *_, v in kept), default=0) // parts))
    kept = [(i, label, v + [0] * (parts * width - len(v))) for i, label, v in kept]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for *_, v in kept]
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][2]))[:entries]
    books = [[cut[r][p] for r in first] for p in range(parts)]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p])) for p, x in enumerate(row)]
            for row in cut
        ]

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [row[p] for row, code in zip(cut, codes, strict=True) if code[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    codes = assign()
    errors = [sum(d for d, _ in code) for code in codes]
    by_label = {}
    for (_, label, _), error in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + error
    told = [
        (i, "".join(f"{e:02x}" for _, e in code), error, by_label[label])
        for (i, label, _), code, error in zip(kept, codes, errors, strict=True)
    ]
    return told, books


def rows_of(frame):
    return sorted((tuple(r)[:4] for r in frame.collect()), key=str)


def test_query_matches_its_sql(spark):
    name = "op12_active_entry_lloyd"
    connection = oracle_connection(SF_DIR)
    assert differences(queries.QUERIES[name](spark, SF_DIR), connection, queries.ORACLE[name]) == ""


@pytest.mark.parametrize("parts, entries, rounds", [(4, 5, 3), (3, 256, 2), (16, 64, 2), (2, 1, 1), (4, 8, 0)])
def test_nulls_ties_repeats_and_short_vectors(spark, parts, entries, rounds):
    rng = random.Random(parts)
    rows = [(rng.randrange(60), [rng.choice([-1.0, 0.0, 0.5, 1.25]) for _ in range(rng.choice([8, 8, 7, 3]))], rng.choice(["a", None, ""]), 1) for _ in range(120)]
    rows += [rows[0], rows[0], (None, [0.5] * 8, "a", 2), (None, [-0.003] * 8, None, 2), (7, [], "a", 0)]
    rows += [(1, None, "a", 1), (2, [1.0, None], "a", 1), (3, [float("nan")], "b", 1), (4, [float("-inf")], None, 1)]
    frame = spark.createDataFrame(rows, ROWS).repartition(5)
    found = vector_codes.with_errors(*vector_codes.compressed(frame, parts, entries, rounds))
    told, books = plain(rows, parts, entries, rounds, 256)
    assert rows_of(found) == sorted(told, key=str)
    numbers = ",".join(str(x) for book in books for c in book for x in c)
    assert found.first().codebooks_sha256 == hashlib.sha256(numbers.encode()).hexdigest()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.sampled_from([3, 1000, (1 << 25) - 1]))
def test_active_entries_give_what_a_full_scan_gives(seed, count, peak):
    """Also with repeated entries, ties, and components as large as they may be."""
    rng = np.random.default_rng(seed)
    rows = rng.integers(-peak, peak, (40, 3), endpoint=True)
    before = vector_codes.Codebooks(rng.integers(-peak, peak, (1, count, 3), endpoint=True))
    entries = before.entries.copy()
    for e in rng.integers(0, count, 2):
        entries[0, e] = rows[rng.integers(40)] if rng.random() < 0.7 else entries[0, rng.integers(count)]
    after = vector_codes.Codebooks(entries, (entries != before.entries).any(2))
    codes, distances = after.reassigned(0, rows, *before.assigned(0, rows))
    full = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c, strict=True)) for c in entries[0]] for x in rows]
    assert codes.tolist() == [d.index(min(d)) for d in full]
    assert distances.tolist() == [min(d) for d in full]


def test_components_too_large_take_no_part(spark):
    rows = [(1, [1e30], "a", 0), (2, [-131072.0], "a", 0), (3, [131071.0], "a", 0), (4, [0.0], "a", 0)]
    state, books = vector_codes.compressed(spark.createDataFrame(rows, ROWS), 1, 1, 1)
    assert {r.vec_id for r in state.collect()} == {3, 4}
    assert books.entries.tolist() == [[[131071 * 256 // 2]]]


def test_codes_decode_to_their_entries(spark):
    rows = [(i, [float(i % 5), 1.0, -2.0, float(i)], None, 0) for i in range(30)]
    state, books = vector_codes.compressed(spark.createDataFrame(rows, ROWS), 2, 8, 2)
    state = state.cache()
    vectors = {r.vec_id: (r.vector, sum(r.distances)) for r in state.collect()}
    for row in vector_codes.decoded(state, books).collect():
        vector, error = vectors[row.vec_id]
        assert sum((a - b) ** 2 for a, b in zip(vector, row.vector, strict=True)) == error


def test_empty_tables(spark):
    for rows in ([], [(1, None, "a", 1)]):
        frame = spark.createDataFrame(rows, ROWS)
        found = vector_codes.with_errors(*vector_codes.compressed(frame))
        assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert found.collect() == []
    with pytest.raises(ValueError):
        vector_codes.compressed(frame, entries=257)

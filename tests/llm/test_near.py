"""Near duplicates against all pairs."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from changeflow.llm import near, queries
from hypothesis import given, settings
from hypothesis import strategies as st

SF_DIR = "/root/testdata/sf0.001"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30), st.integers(0, 30))
def test_alignment_is_the_edit_distance(one, other, most):
    a, b = (np.array(x, np.uint64) + np.uint64(10) for x in (one, other))
    distance = edit_distance(one, other)
    assert near.edits_within(a, b, most) == (distance if distance <= most else None)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(0, 3), max_size=40),
    st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=40), st.integers(0, 12)), min_size=1, max_size=5),
)
def test_partners_within_the_band_are_those_within_the_distance(one, others):
    a = np.array(one, np.int64) + 1
    texts = [np.array(other, np.int64) + 1 for other, _ in others]
    got = near.within_band(a, texts, np.array([most for _, most in others]))
    assert got.tolist() == [edit_distance(one, other) <= most for other, most in others]


def test_marks_and_counts_keep_every_near_pair():
    rng = random.Random(12)
    source, texts = near.WordHashes(), []
    for size in [3, 9, 20, 60, 150, 600, 1500]:
        base = [f"w{rng.randrange(size)}" for _ in range(size)]
        for _ in range(4):
            other = list(base)
            for _ in range(rng.randrange(1 + size // 4)):
                other[rng.randrange(size)] = f"v{rng.randrange(50)}"
            texts.append(source.of(" ".join(other)))
    sizes = np.array([len(t) for t in texts], np.int32)
    marks = np.array([near.marks_of(t) for t in texts])
    every = np.arange(len(texts))
    allowed = near.marked_alike(sizes, marks, every, every, 0.8)
    close = np.array(
        [[near.edits_within(a, b, int(0.2 * max(len(a), len(b)) + 1e-9)) is not None for b in texts] for a in texts]
    )
    assert not (close & ~allowed).any()
    assert close.sum() > len(texts) and not allowed.all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40), st.lists(st.tuples(st.integers(0, 40), st.integers(-1, 5)), max_size=6))
def test_alignment_along_runs_is_possible(one, changes):
    other = list(one)
    for at, value in changes:
        other[at : at + (value % 2)] = [value] if value >= 0 else []
    if not one or not other:
        return
    a, b = (np.array(x, np.uint64) + np.uint64(10) for x in (one, other))
    runs = near.labelled_runs(a, 5), near.labelled_runs(b, 5)
    bound = near.edits_at_most(a, b, runs, 5)
    assert edit_distance(one, other) <= bound <= max(len(one), len(other))


def test_alignment_of_long_texts():
    rng = random.Random(4)
    one = [rng.randrange(10, 9000) for _ in range(3000)]
    other = list(one)
    for _ in range(40):
        at = rng.randrange(len(other))
        rng.choice([lambda: other.pop(at), lambda: other.insert(at, 5), lambda: other.__setitem__(at, 6)])()
    a, b = np.array(one, np.uint64), np.array(other, np.uint64)
    assert near.edits_within(a, b, 100) == edit_distance(one, other)


def classes_by_all_pairs(rows, similarity=0.8):
    """Components over all pairs that align well enough."""
    words = [(t or "").split() for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for j in range(len(rows)):
        for i in range(j):
            if not words[i] or not words[j] or root(i) == root(j):
                continue
            size = max(len(words[i]), len(words[j]))
            most = int((1 - similarity) * size + 1e-9)
            if abs(len(words[i]) - len(words[j])) > most:
                continue
            a, b = (np.array([hash(w) & (2**63 - 1) for w in words[k]], np.uint64) for k in (i, j))
            if near.edits_within(a, b, most) is not None:
                parent[root(i)] = root(j)
    groups = defaultdict(set)
    for i, (doc_id, _) in enumerate(rows):
        groups[root(i)].add(doc_id)
    return {frozenset(g) for g in groups.values()}


def classes_of(frame):
    groups = defaultdict(set)
    for r in frame.collect():
        groups[r["class_id"]].add(r["doc_id"])
    assert all(k == min(g) for k, g in groups.items())
    return {frozenset(g) for g in groups.values()}


def test_query_finds_the_classes(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = queries.op7_order_minhash(spark, SF_DIR)
    assert got.count() == len(rows)
    assert classes_of(got) == classes_by_all_pairs(rows)


def test_groups_copies_and_odd_rows(spark):
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(4000)]
    boiler = rng.choices(vocabulary, k=40)
    texts = []
    for group in range(6):
        base = rng.choices(vocabulary, k=rng.randrange(60, 400))
        for _ in range(rng.choice([1, 2, 30])):
            copy = list(base)
            for _ in range(len(copy) // 25):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [" ".join(rng.choices(vocabulary, k=100) + boiler) for _ in range(40)]  # only share a passage
    moved = texts[0].split()
    texts.append(" ".join(moved[len(moved) // 2 :] + moved[: len(moved) // 2]))  # same words, other order
    texts += [texts[1], texts[1], "one two", "one  two", "one three", None, None, "", "", " "]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, node int, a int")
    got = near.classes(frame)
    assert classes_of(got) == classes_by_all_pairs(rows)
    assert {r["n_copies"] for r in got.collect() if r["doc_id"] in (1, len(texts) - 10)} == {3}
    nulls = frame.limit(2).selectExpr("cast(null as long) doc_id", "text", "node", "a")
    assert near.classes(nulls).where("class_id is null").count() == 2
    assert near.classes(frame.limit(0)).collect() == []


def test_long_chains_become_one_class(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in near.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def template_crowd(rng, texts=600, pairs=40):
    """Texts of one template with bodies of their own, and pairs of them that are near: rows, pairs."""
    vocabulary = [f"w{i}" for i in range(5000)]
    template = rng.choices(vocabulary, k=80)
    rows = [template + rng.choices(vocabulary, k=30) for _ in range(texts)]
    planted = []
    for i in range(pairs):
        copy = list(rows[i])
        for at in rng.sample(range(80, 110), 6):
            copy[at] = rng.choice(vocabulary)
        planted.append((i, len(rows)))
        rows.append(copy)
    return [" ".join(r) for r in rows], planted


def test_near_texts_in_a_template_crowd(spark):
    texts, planted = template_crowd(random.Random(11))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    of = {r["doc_id"]: r["class_id"] for r in near.classes(frame).collect()}
    assert [p for p in planted if of[p[0]] != of[p[1]]] == []
    assert len(set(of.values())) == len(texts) - len(planted)


@pytest.mark.parametrize("block, size", [(7, 1 << 20), (1000, 60), (1000, 1 << 20)])
def test_blocks_of_a_bucket_all_meet(spark, monkeypatch, block, size):
    """Whatever the blocks, links connect what all pairs would; a group has fewer than members."""
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "BLOCK_BYTES", size)
    words = [f"a b c d e{i % 5} f{i % 5} g{i % 5}" for i in range(40)]
    texts = spark.createDataFrame(list(enumerate(words)), "node long, text string")
    first = texts.selectExpr("5L as bucket", "node", "least(node, 30) as label", "40L as size")
    second = texts.where("node < 20").selectExpr("9L as bucket", "node", "node as label", "20L as size")
    got = [tuple(r) for r in near.links_within(first.union(second), texts).collect()]
    assert all(a % 5 == b % 5 for a, b in got)
    if block > 60 and size > 10_000:
        assert len(got) < 60
    label = list(range(30)) + [30] * 10

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in got:
        label[root(a)] = root(b)
    # 30 to 39 are one component from the start, and have texts of every kind
    assert len({root(i) for i in range(40)}) == 1


def test_the_largest_component_meets_the_rest_only(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 4)
    rng = random.Random(12)
    vocabulary = [f"v{i}" for i in range(400)]
    base = rng.choices(vocabulary, k=50)
    rows = [(i, " ".join(base[:40] + rng.choices(vocabulary, k=10))) for i in range(30)]
    texts = spark.createDataFrame(rows, "node long, text string")
    members = texts.selectExpr("5L as bucket", "node", "if(node < 20, 0L, node) as label", "30L as size")
    got = {tuple(r) for r in near.links_within(members, texts).collect()}
    label = {i: 0 if i < 20 else i for i in range(30)}

    def apart():
        return {i: label[i] for i in label}

    def merge(a, b):
        old, new = label[a], label[b]
        for i in label:
            label[i] = new if label[i] == old else label[i]

    for a, b in got:
        merge(a, b)
    found = apart()
    label = {i: 0 if i < 20 else i for i in range(30)}
    for a in range(30):
        for b in range(a):
            one, other = (np.array([hash(w) & (2**63 - 1) for w in rows[k][1].split()], np.uint64) for k in (a, b))
            if near.edits_within(one, other, 10) is not None:
                merge(a, b)
    groups = lambda labels: {frozenset(i for i in labels if labels[i] == x) for x in labels.values()}
    assert groups(found) == groups(label)


def test_short_texts_with_one_changed_word(spark):
    texts = ["a b c d e", "a b X d e", "p q r s t u v w x", "p q r s Y u v w x", "p q r s t u w x", "k l m n", "k l m N"]
    texts += ["k l m n o", "g", "h"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert classes_of(near.classes(frame)) == {frozenset(g) for g in ({0, 1}, {2, 3, 4}, {5, 7}, {6}, {8}, {9})}


def test_pairs_at_the_similarity_share_a_bucket():
    rng = random.Random(3)
    seeds = {size: near.sketch_seeds(near.SKETCHES, size) for size, *_ in near.RUNS}
    missed, lengths = 0, [*range(5, 60), *range(60, 400, 10)]
    for length in lengths:
        for _ in range(10):
            one = [rng.getrandbits(63) for _ in range(length)]
            other = list(one)
            for at in sorted(rng.sample(range(length), length // 5), reverse=True):
                other[at : at + 1] = rng.choice([[], [rng.getrandbits(63)]])
            a, b = (near.text_buckets(np.array(x, np.uint64), seeds) for x in (one, other))
            missed += not len(np.intersect1d(a, b))
    assert missed <= 0.01 * 10 * len(lengths)  # 0.1 to 0.4% is measured, see the README


def test_members_too_unlike_in_length_are_not_counted():
    import pyarrow as pa

    texts = ["a b c d e f g h i j", "a b c d e"]
    rows = pa.table({
        "node": [1, 2], "side": [2, 2], "bucket": [7, 7], "text": texts, "buckets": [[7], [7]], "label": [1, 2],
    })
    group = near.Members(rows, near.WordHashes())
    alike = near.sized_alike(group.sizes, [0, 1], [0, 1], 0.8)
    assert alike.tolist() == [[True, False], [False, True]]
    assert not {"marks", "counts", "numbered"} & set(vars(group))


def test_marks_keep_every_wanted_key_and_few_others(spark):
    keys = spark.range(20_000).selectExpr("xxhash64(id) AS node", "id")
    for wanted in (keys.where("id < 3000"), keys.limit(0)):
        count = wanted.count()
        got = near.likely_among(keys, wanted.select("node"), "node", count)
        assert got.columns == keys.columns
        found = {r["id"] for r in got.collect()}
        assert found >= {r["id"] for r in wanted.collect()}
        assert len(found) <= count + 0.15 * 20_000 * bool(count)


def test_shuffle_files_of_a_written_frame_go_at_once(spark, tmp_path):
    import time

    from changeflow.llm.tables import Written

    def shuffled():
        tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
        return tracker.shuffleStatuses().size()

    written = Written(spark)
    written(spark.range(10))
    before = shuffled()
    halves = [spark.range(1000).where(f"id % 2 = {i}").repartition(3, "id") for i in range(2)]
    kept = written(*halves)
    del halves
    written(spark.range(10))
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert sorted(r["id"] for r in kept.collect()) == list(range(1000))


def test_slices_hold_every_shared_bucket_once(spark):
    rows = [(b, n) for b in range(-40, 40) for n in range(1 + b % 4)]
    found = spark.createDataFrame(rows, "bucket long, node long")
    whole = [tuple(r) for r in near.in_shared_buckets(found)[0].collect()]
    parts = [[tuple(r) for r in f.collect()] for f in near.in_shared_buckets(found, 3)]
    assert sorted(r for p in parts for r in p) == sorted(whole)
    assert all(len(p) < len(whole) / 2 for p in parts)

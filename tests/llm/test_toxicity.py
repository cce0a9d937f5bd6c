"""Toxic segments."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from changeflow.llm import queries, toxicity
from changeflow.llm.tables import least_hashed
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"


def maximal_segments(scores):
    """By definition: the best stretch, then the same to its left and to its right."""

    def within(low, high):
        best = max(
            ((sum(scores[a:b]), a - b, a, b) for a in range(low, high) for b in range(a + 1, high + 1)),
            default=(0,),
        )
        if best[0] <= 0:
            return []
        _, _, a, b = best
        return [*within(low, a), (a, b), *within(b, high)]

    return within(0, len(scores))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-40, 40).map(lambda x: x * 1.0009765625 + x * x / 1024), max_size=14))
def test_segments_are_the_maximal_ones(scores):
    # sums that tie may be cut in several ways; what remains is compared by total score
    got = toxicity.segments(np.array(scores))
    wanted = maximal_segments(scores)
    assert abs(sum(s for *_, s in got) - sum(sum(scores[a:b]) for a, b in wanted)) < 1e-6
    assert all(abs(sum(scores[a:b]) - s) < 1e-9 and s > 0 for a, b, s in got)
    sums = [sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1)]
    if len(set(sums)) > len(sums) - len(scores):
        assert [(a, b) for a, b, _ in got] == wanted


def test_words_lose_case_and_punctuation():
    tokens = toxicity.Tokens()
    a, b, c, none, *_ = tokens.of("Idiot, idiot (IDIOT) -- other").tolist()
    assert a == b == c != 0 and none == 0
    assert len(tokens.of(None)) == len(tokens.of(" ")) == 0


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_query_tells_held_out_documents_apart(spark):
    got = queries.op3_toxic_segments(spark, SF_DIR).toPandas()
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert len(got) == documents == got["doc_id"].nunique()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    assert got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    both = got[got["held_out"]].merge(labels, on="doc_id")
    assert auc(both["score"].to_numpy(), both["toxic"].to_numpy()) > 0.8
    assert ((both["predicted"] == both["toxic"]).mean()) > 0.9


def planted(spark, n=400):
    rng = np.random.default_rng(3)
    common = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choice(common, size=rng.integers(20, 120)).tolist()
        if i % 4 == 0:
            at = int(rng.integers(0, len(words)))
            words[at:at] = rng.choice(["vile,", "Awful", "scum."], size=4).tolist()
        rows.append((i, " ".join(words), 0, "x"))
        labels.append((i, int(i % 4 == 0), "noise"))
    rows += [(n, None, 0, "x"), (None, "vile awful scum vile", 0, "x"), (n + 1, "", 0, "x"), (0, rows[0][1], 0, "x")]
    labels += [(None, 1, "x"), (5, None, "x"), (10**6, 1, "x"), (0, 1, "again")]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string"),
        spark.createDataFrame(labels, "doc_id long, toxic int, text string"),
    )


def test_planted_passages_are_found(spark):
    documents, labels = planted(spark)
    model = toxicity.fit(documents, labels)
    got = toxicity.with_scores(documents, model).collect()
    assert len(got) == documents.count()
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 400:
            assert (r["toxic_score"] >= 0.5) == (r["doc_id"] % 4 == 0)
            words = (r["text"] or "").lower().split()
            for p in r["toxic_passages"]:
                assert {"vile,", "awful", "scum."} & set(words[p["start"] : p["end"]])
            assert bool(r["toxic_passages"]) == (r["doc_id"] % 4 == 0)
        elif r["doc_id"] is None:
            assert r["toxic_score"] >= 0.5
        else:
            assert r["toxic_score"] < 0.5 and not r["toxic_passages"]


def test_scores_are_the_plain_log_odds(spark):
    documents, labels = planted(spark)
    counts = toxicity.token_counts(documents, toxicity.fit_labels(labels))
    vocabulary, (*_, whole) = toxicity.scorers(counts)
    label = defaultdict(int)
    for r in labels.collect():
        if r["doc_id"] is not None and r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            label[r["doc_id"]] |= r["toxic"]
    texts, times, held = Counter(), Counter(), (Counter(), Counter())
    for r in documents.collect():
        words = [w.strip(".,").lower() for w in (r["text"] or "").split()]
        times.update(words)
        texts.update(set(words))
        if r["doc_id"] in label:
            held[label[r["doc_id"]]].update(set(words))
    totals = [sum(h.values()) for h in held]
    weight = max(toxicity.LEAST_PRIOR, toxicity.PRIOR_SHARE * sum(totals))
    wanted = {}
    for word, n in texts.items():
        prior = weight * n / sum(texts.values())
        odds = [math.log((h[word] + prior) / (t + weight - h[word] - prior)) for h, t in zip(held, totals)]
        error = math.sqrt(sum(1 / (h[word] + prior) for h in held))
        if held[1][word] and odds[1] - odds[0] > toxicity.SIGNIFICANT * error:
            wanted[word] = odds[1] - odds[0]
    assert set(wanted) >= {"vile", "awful", "scum"}
    place = {word: int(toxicity.Tokens(vocabulary).of(word)[0]) for word in times}
    for word, p in place.items():
        assert abs(whole.scores[p] + toxicity.DRIFT - wanted.get(word, 0.0)) < 1e-9
    # lambda is the root of the moment equation over the whole corpus
    moment = sum(n * math.exp(whole.lambda_ * whole.scores[place[w]]) for w, n in times.items()) / times.total()
    assert abs(moment - 1) < 1e-6


def test_tokens_never_share_a_count(spark):
    """A million distinct words, each told apart."""
    documents = spark.range(200).selectExpr(
        "id AS doc_id", "array_join(transform(sequence(0, 4999), i -> concat('w', id * 5000 + i)), ' ') AS text"
    )
    labels = spark.range(200).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    counts = toxicity.token_counts(documents, toxicity.fit_labels(labels))
    got = counts.selectExpr("count(*)", "max(occurrences)", "max(texts)", "max(f0c0 + f0c1)").first()
    assert tuple(got) == (1_000_000, 1, 1, 1)


def test_rows_of_least_hash(spark):
    ids = spark.range(20000).withColumnRenamed("id", "_id")
    wanted = [r[0] for r in ids.orderBy(F.xxhash64("_id"), "_id").limit(300).collect()]
    got = least_hashed(ids, "_id", 300, 20000)
    assert [r[0] for r in got.collect()] == wanted
    assert least_hashed(ids.limit(5), "_id", 300, 5).count() == 5


def test_few_or_no_labels(spark):
    documents, labels = planted(spark)
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        model = toxicity.fit(documents, some)
        scores = {r["toxic_score"] for r in toxicity.with_scores(documents, model).collect()}
        assert len(scores) == 1 and 0 <= min(scores) <= 1
    empty = documents.limit(0)
    assert toxicity.with_scores(empty, toxicity.fit(empty, labels)).collect() == []

"""Toxic passages: maximum-scoring segments over token log-odds.

*Tokens.* A text's words, in small letters and without punctuation around them, are told
apart by whole 64-bit hashes, however many there are. They are counted by a grouped sum, and
only tokens that score leave the executors: at most those of the fitted toxic texts.

*Log-odds.* The numbers of toxic and of clean labelled texts that hold a token are compared
under a Dirichlet prior, tokens spread as they are over the texts of the whole corpus.
(Texts are counted, not occurrences: a word repeated through one text says little.) Tokens
whose log-odds lie less than SIGNIFICANT standard deviations above zero, and those that no
fitted toxic text holds, score nothing.
Every token also costs DRIFT, so a random stretch of text loses.

*Segments.* One scan over a text finds all maximal segments: those that cannot be
lengthened, or shortened, without losing score. Its time is linear in the tokens.

*Calibration.* The best segment of n random tokens follows an extreme-value law: above a
score of S lie ``K n exp(-lambda S)`` segments on average. ``lambda`` follows from the
corpus frequencies of the scores, K from clean texts. ``evidence`` sums up the strongest
segments under that law, which makes texts of all lengths comparable; a logistic curve
fitted to labelled texts turns it into a probability. That fit scores each labelled text
with log-odds from the other folds.

The classifier is fitted on at most FIT_ROWS labelled rows (of smallest hash of the id);
corpus frequencies are counted over all documents. Where one class has no labels all
texts get the share of toxic labels, or 0.5 without labels.

Null, empty and word-less texts have no segment and evidence of zero tokens. Null ids are
never labelled. An id labelled more than once is toxic if any of its labels says so.
Repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.encoding import Values
from changeflow.llm.tables import Written, importable, least_hashed

#: The prior's weight: a share of the counts of the fitted texts, and so much at least.
PRIOR_SHARE = 0.2
LEAST_PRIOR = 10_000.0
SIGNIFICANT = 3.0
DRIFT = 0.1
FIT_ROWS = 1 << 17
FOLDS = 4
#: Characters of words whose tokens a worker keeps.
KEPT_CHARS = 1 << 21
#: A segment is significant if fewer than so many such are expected in a random text.
EXPECTED = 0.05


class Tokens:
    """Tokens of a text's words; 0 stands for what has no letter or digit.

    With a vocabulary, they are the words' places in it, from 1; 0 stands for all others.
    """

    def __init__(self, vocabulary: np.ndarray | None = None) -> None:
        if vocabulary is None:
            self._tokens = Values(_token, np.int64, KEPT_CHARS)
        else:
            places = {token: place for place, token in enumerate(vocabulary.tolist(), 1)}
            self._tokens = Values(lambda word: places.get(_token(word), 0), np.int32, KEPT_CHARS)

    def of(self, text: str | None) -> np.ndarray:
        return self._tokens.of((text or "").split())


def _token(word: str) -> int:
    """The signed 64-bit hash of a word, never 0."""
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    if start == end:
        return 0
    token = xxhash.xxh3_64_intdigest(word[start:end].lower().encode())
    return (token - (1 << 64) if token >= 1 << 63 else token) or 1


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order.

    Only positive tokens can begin or end one, so the scan visits these and takes what
    lies between from running sums. A segment that ends higher than it began swallows the
    stack back to the last one that began lower.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, below, above, lower one
    for at in positive.tolist():
        start, below, above = at, float(total[at]), float(total[at + 1])
        while True:
            lower = len(stack) - 1
            while lower >= 0 and stack[lower][2] >= below:
                lower = stack[lower][4]
            if lower < 0 or stack[lower][3] >= above:
                stack.append((start, at + 1, below, above, lower))
                break
            start, below = stack[lower][0], stack[lower][2]
            del stack[lower:]
    return [(a, b, above - below) for a, b, below, above, _ in stack]


@dataclass(frozen=True)
class Scorer:
    """Scores by place in the vocabulary, and the constants of their extreme-value law."""

    scores: np.ndarray
    lambda_: float
    log_k: float = 0.0

    def evidence(self, places: np.ndarray) -> float:
        """How unlikely the best segments are together: minus the log of the p-value.

        Of r segments, T is the sum of the normalised scores; a random text reaches it
        with probability ``exp(-T) T**(r-1) / (r! (r-1)!)``. The best r counts, at the
        price of a factor of two for each more.
        """
        allowance = self.log_k + math.log(len(places) + 1)
        found = sorted((s for *_, s in segments(self.scores[places])), reverse=True)
        total = self.lambda_ * (found[0] if found else 0.0) - allowance
        best, ways = total, 0.0
        for r, score in enumerate(found[1:], 2):
            total += self.lambda_ * score - allowance
            ways += math.log(r) + math.log(r - 1)
            value = total + ways - (r - 1) * (math.log(max(total, 1.0)) + math.log(2))
            best = max(best, value)
        return best

    def passages(self, places: np.ndarray) -> list[tuple[int, int, float]]:
        """Significant segments: first word, word after the last, expected number."""
        n = len(places) + 1
        found = (
            (a, b, n * math.exp(self.log_k - self.lambda_ * s))
            for a, b, s in segments(self.scores[places])
        )
        return [(a, b, e) for a, b, e in found if e <= EXPECTED]


@dataclass(frozen=True)
class Model:
    vocabulary: np.ndarray
    scorer: Scorer
    slope: float
    intercept: float

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, self.slope * evidence + self.intercept))))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def fit_labels(labels: DataFrame) -> DataFrame:
    """The bounded set of labelled rows that the model is fitted on: doc_id, toxic, fold."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    ids = (
        usable.where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg((F.max("toxic") != 0).cast("int").alias("_toxic"))
    )
    return least_hashed(ids, "_id", FIT_ROWS, ids.count()).withColumn(
        "_fold", F.pmod(F.xxhash64(F.lit("fold"), "_id"), F.lit(FOLDS)).cast("int")
    )


def _labelled(documents: DataFrame, fit: DataFrame, how: str) -> DataFrame:
    ids = documents.select(F.col("doc_id").cast("long").alias("_id"), "text")
    return ids.join(F.broadcast(fit), "_id", how).select("text", "_toxic", "_fold")


KINDS = [f"f{fold}c{toxic}" for fold in range(FOLDS) for toxic in (0, 1)]


def token_counts(documents: DataFrame, fit: DataFrame) -> DataFrame:
    """Of every token its occurrences and texts in the corpus, and the fitted texts of each
    fold and class that hold it: (token, occurrences, texts, f0c0, f0c1, ...)."""
    columns = ["token", "occurrences", "texts", *KINDS]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            held, times, kinds = [], [], []
            for text, toxic, fold in zip(*batch.columns, strict=True):
                at, found = np.unique(tokens.of(text.as_py()), return_counts=True)
                held.append(at)
                times.append(found)
                kinds.append(2 * fold.as_py() + toxic.as_py() if toxic.is_valid else -1)
            if not held:
                continue
            kind = np.repeat(kinds, [len(h) for h in held])
            at, inverse = np.unique(np.concatenate(held), return_inverse=True)
            sums = [np.bincount(inverse, np.concatenate(times), len(at)), np.bincount(inverse, minlength=len(at))]
            sums += [np.bincount(inverse[kind == k], minlength=len(at)) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), *(pa.array(s.astype(np.int64)) for s in sums)], columns
            )

    schema = ", ".join(f"{c} long" for c in columns)
    rows = _labelled(documents, fit, "left").mapInArrow(added, schema)
    return rows.groupBy("token").agg(*(F.sum(c).alias(c) for c in columns[1:]))


def scorers(counts: DataFrame) -> tuple[np.ndarray, list[Scorer]]:
    """The tokens that score, sorted, and the scorers without each fold and of all folds.

    Scores are log-odds under the corpus prior.
    """
    sums = counts.agg(*(F.sum(c).alias(c) for c in counts.columns[1:])).first().asDict()
    sums = {c: n or 0 for c, n in sums.items()}
    scores = []
    for left_out in range(FOLDS + 1):
        clean, toxic = ([f"f{f}c{c}" for f in range(FOLDS) if f != left_out] for c in (0, 1))
        scores.append(_score(clean, toxic, sums).alias(f"s{left_out}"))
    scored = counts.select("token", "occurrences", *scores)
    some = F.greatest(*(F.col(f"s{i}") for i in range(FOLDS + 1))) > 0
    rows = scored.where(some).toArrow().sort_by("token")
    occurrences = rows["occurrences"].to_numpy()
    share = np.concatenate([[sums["occurrences"] - occurrences.sum()], occurrences])
    share = share / max(sums["occurrences"], 1)
    found = []
    for i in range(FOLDS + 1):
        own = np.concatenate([[0.0], rows[f"s{i}"].to_numpy()]) - DRIFT
        found.append(Scorer(own, _lambda(own, share)))
    return rows["token"].to_numpy(), found


def _score(clean: list[str], toxic: list[str], sums: dict[str, int]) -> Column:
    """The log-odds of a token where they are significant, else 0."""
    totals = [sum(sums[c] for c in columns) for columns in (clean, toxic)]
    weight = max(LEAST_PRIOR, PRIOR_SHARE * sum(totals))
    prior = F.col("texts") * F.lit(weight / max(sums["texts"], 1))
    held = [sum((F.col(c) for c in columns), F.lit(0)) for columns in (clean, toxic)]

    def log_odds(count: Column, total: int) -> Column:
        others = F.greatest(F.lit(total + weight) - count - prior, F.lit(1e-9))
        return F.log(count + prior) - F.log(others)

    odds = log_odds(held[1], totals[1]) - log_odds(held[0], totals[0])
    error = F.sqrt(1 / (held[1] + prior) + 1 / (held[0] + prior))
    kept = (F.col("token") != 0) & (held[1] > 0) & (odds > SIGNIFICANT * error)
    return F.when(kept, odds).otherwise(F.lit(0.0))


def _lambda(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum(share * exp(lambda * score)) = 1."""
    if not ((scores > 0) & (share > 0)).any():
        return 1.0
    if float((share * scores).sum()) >= 0:  # as in a corpus that is toxic throughout
        return 0.05
    low, high = 0.0, 1.0
    moment = lambda x: float((share * np.exp(np.minimum(x * scores, 500.0))).sum())
    while moment(high) < 1.0 and high < 100:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if moment(middle) < 1.0 else (low, middle)
    return max(high, 0.05)


def _evidence(scored: DataFrame, share: Callable[[], tuple[np.ndarray, list[Scorer]]]) -> DataFrame:
    """Evidence of labelled texts under the scorer of their fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, scorers = share()
        tokens = Tokens(vocabulary)
        for batch in batches:
            found = [
                scorers[fold.as_py()].evidence(tokens.of(text.as_py()))
                for text, fold in zip(batch.column(0), batch.column(2), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found, pa.float64())], ["toxic", "evidence"]
            )

    return scored.mapInArrow(run, "toxic int, evidence double")


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of a corpus and its labels; of the tokens only those that score, and of the
    labelled texts only their evidence, reach the driver."""
    spark = documents.sparkSession
    importable(spark)
    written = Written(spark)
    chosen = written(fit_labels(labels))
    counts = written(token_counts(documents, chosen))
    vocabulary, (*parts, whole) = scorers(counts)
    shared = spark.sparkContext.broadcast((vocabulary, parts))
    rows = _evidence(_labelled(documents, chosen, "inner"), lambda: shared.value).toArrow()
    written.drop(counts, chosen)
    toxic, evidence = rows["toxic"].to_numpy(), rows["evidence"].to_numpy()
    if not len(toxic) or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(toxic) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(vocabulary, whole, 0.0, math.log(share / (1 - share)))
    # the mean of the law's maximum is Euler's constant above ln K
    clean = evidence[(toxic == 0) & (evidence > np.quantile(evidence, 0.05))]
    log_k = float(np.clip(clean.mean() - 0.5772, -10.0, 10.0)) if len(clean) else 0.0
    slope, intercept = _logistic(evidence - log_k, toxic)
    return Model(vocabulary, Scorer(whole.scores, whole.lambda_, log_k), slope, intercept)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one feature, slightly held back, by Newton's steps."""
    middle, spread = float(x.mean()), float(x.std()) or 1.0
    inputs = np.stack([(x - middle) / spread, np.ones(len(x))])
    weights = np.array([0.0, math.log(y.mean() / (1 - y.mean()))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(weights @ inputs, -30, 30)))
        gradient = inputs @ (y - p) - np.array([0.1, 0.0]) * weights
        curvature = (inputs * (p * (1 - p))) @ inputs.T + np.diag([0.1, 1e-9])
        step = np.linalg.solve(curvature, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    slope = max(float(weights[0]) / spread, 0.0)
    return slope, float(weights[1]) - slope * middle


def with_scores(documents: DataFrame, model: Model) -> DataFrame:
    """Documents with ``toxic_score``, ``toxic_evidence`` and ``toxic_passages`` (of words)."""
    importable(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = "struct<score: double, evidence: double, passages: array<struct<start: int, end: int, expected: double>>>"
    arrow = pa.struct(
        [
            ("score", pa.float64()),
            ("evidence", pa.float64()),
            ("passages", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("expected", pa.float64())]))),
        ]
    )
    columns = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        tokens = Tokens(own.vocabulary)
        for batch in batches:
            found = []
            for text in batch.column(columns.index("text")):
                places = tokens.of(text.as_py())
                evidence = own.scorer.evidence(places)
                passages = [
                    {"start": a, "end": b, "expected": e} for a, b, e in own.scorer.passages(places)
                ]
                found.append(
                    {"score": own.probability(evidence), "evidence": evidence, "passages": passages}
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, arrow)], [*columns, "_toxicity"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    scored = documents.mapInArrow(run, f"{fields}, _toxicity {kind}")
    return scored.select(
        *(f"`{c}`" for c in columns),
        F.col("_toxicity.score").alias("toxic_score"),
        F.col("_toxicity.evidence").alias("toxic_evidence"),
        F.col("_toxicity.passages").alias("toxic_passages"),
    )

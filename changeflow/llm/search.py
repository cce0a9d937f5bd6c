"""Exact top-k by inner product, pruned by segment statistics from coarse to fine.

A vector is cut into segments. From a segment's mean m and deviation s (of n parts) the
inner product of two segments is at most ``n (m m' + s s')``; equally, their squared
distance is at least ``n ((m - m')**2 + (s - s')**2)``. Summed over segments this bounds
a candidate's score, the more tightly the finer the segments. A query's threshold is the
k-th best score among SAMPLE candidates, so it never exceeds the true k-th best. At each
resolution, from one segment up, the candidates whose bound stays below the threshold
are dropped; the survivors' scores are computed exactly.

Tasks find the thresholds of the queries against the broadcast sample. Queries then go out in
blocks of about QUERY_BLOCK, one after another, each against all candidates in one pass; a
task keeps k rows per query, what a block found is written, and a window keeps the best k of
all tasks. The driver holds the sample and one block.

Vectors become whole numbers, ``floor(scale * x)``. Null vectors, those that hold null or
non-finite parts, and rows without an id take no part; shorter vectors count as followed
by zeros. Nor do vectors of a whole number of WHOLE or more, as scores of up to 512 such parts
would not fit 64 bits. Rows of one id are one row's copies: none is a candidate of another, the
least vector asks, and all are candidates of others. Ties go to the smaller id. An empty table,
or a single row, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.tables import importable, least_hashed

#: Whole numbers from which, above or below zero, vectors take no part.
WHOLE = 1 << 27
#: Queries sent to the executors at a time, and candidates that set the thresholds.
QUERY_BLOCK = 8192
SAMPLE = 16384
#: Segments per vector, coarse to fine.
RESOLUTIONS = (1, 4, 16)
#: Candidates and queries compared at a time, which bounds a task's memory.
TILE = 1024, 512

ASKED = "vec_id long, vector array<long>, threshold long"
FOUND = "query_id long, vec_id long, score long"


def whole_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """Usable rows: vec_id, and the vector as whole numbers."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < F.lit(float(WHOLE))),
    )
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(finite)
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector"))
    )


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _statistics(matrix: np.ndarray, parts: int) -> np.ndarray:
    """Means and deviations of the segments, times the root of the segment's size.

    The inner product of two rows of statistics bounds that of their vectors.
    """
    width = matrix.shape[1]
    cuts = np.unique(np.linspace(0, width, parts + 1).astype(int))[:-1]
    sizes = np.diff(np.append(cuts, width))
    values = matrix.astype(np.float64)
    mean = np.add.reduceat(values, cuts, axis=1) / sizes
    square = np.add.reduceat(values * values, cuts, axis=1) / sizes
    deviation = np.sqrt(np.maximum(square - mean * mean, 0.0))
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.tile(sizes, 2))


class Block:
    """A block of queries with their statistics and thresholds."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int) -> None:
        self.ids, self.matrix, self.k = ids, matrix, k
        self.threshold = np.full(len(ids), np.iinfo(np.int64).min, np.int64)
        self.finer = [_statistics(matrix, p) for p in RESOLUTIONS if p <= matrix.shape[1]]

    def scores(self, queries: np.ndarray, matrix: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products of pairs (query, row)."""
        return np.einsum("ij,ij->i", self.matrix[queries], matrix[rows])

    def best(self, ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of these candidates, each query's k best that reach its threshold."""
        finer = [_statistics(matrix, p) for p in RESOLUTIONS if p <= matrix.shape[1]]
        kept: list[tuple[np.ndarray, ...]] = []
        for at in range(0, len(self.ids), TILE[1]):
            own = slice(at, at + TILE[1])
            # whole scores are compared, so what floating sums lose is allowed for
            least = self.threshold[own, None] - 0.5 - 1e-9 * np.abs(self.threshold[own, None])
            query, row = np.nonzero(self.finer[0][own] @ finer[0].T >= least)
            query = query + at
            for coarse, fine in zip(self.finer[1:], finer[1:], strict=True):
                bound = np.einsum("ij,ij->i", coarse[query], fine[row])
                keep = bound >= self.threshold[query] * (1 - 1e-9 * np.sign(self.threshold[query])) - 0.5
                query, row = query[keep], row[keep]
            score = self.scores(query, matrix, row)
            keep = (score >= self.threshold[query]) & (ids[row] != self.ids[query])
            kept.append((query[keep], ids[row[keep]], score[keep]))
        return self.top(*(np.concatenate(c) for c in zip(*kept, strict=True)))

    def top(self, query: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, ...]:
        """The first k of each query by falling score, then rising id; one row of an id."""
        order = np.lexsort((vec_id, -score, query))
        query, vec_id, score = query[order], vec_id[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query, "left")
        keep = rank < self.k
        return query[keep], vec_id[keep], score[keep]


def _searched(candidates: DataFrame, shared: Broadcast, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        held = tuple(np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            for at in range(0, batch.num_rows, TILE[0]):
                part = batch.slice(at, TILE[0])
                ids = part.column(0).to_numpy()
                found = own.best(ids, _matrix(part.column(1), width))
                held = own.top(*(np.concatenate(c) for c in zip(held, found, strict=True)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.ids[held[0]]), pa.array(held[1]), pa.array(held[2])],
            ["query_id", "vec_id", "score"],
        )

    return candidates.mapInArrow(run, FOUND)


def top_k(candidates: DataFrame, queries: DataFrame, k: int, path: str) -> DataFrame:
    """Each query's k best candidates but itself: query_id, rank, vec_id, score.

    Both frames come from ``whole_vectors``. Queries and what each block finds are written
    below ``path``, a new folder that all executors share.
    """
    spark = candidates.sparkSession
    importable(spark)
    width, rows = candidates.agg(F.max(F.size("vector")), F.count("*")).first()
    asked = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    count = asked.count()
    if not width or not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = -(-count // QUERY_BLOCK)
    sample = least_hashed(candidates, "vec_id", SAMPLE, rows).toArrow().combine_chunks()
    seeds = sample["vec_id"].to_numpy(), _matrix(_one_chunk(sample["vector"]), width)
    number = F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(blocks)).alias("block")
    _with_thresholds(asked, seeds, width, k).select("*", number).write.partitionBy("block").parquet(
        f"{path}/queries"
    )
    ready = spark.read.schema(f"{ASKED}, block long").parquet(f"{path}/queries")
    for at in range(blocks):
        own = ready.where(F.col("block") == at).drop("block").toArrow().combine_chunks()
        if not own.num_rows:
            continue
        block = Block(own["vec_id"].to_numpy(), _matrix(_one_chunk(own["vector"]), width), k)
        block.threshold = own["threshold"].to_numpy().copy()
        shared = spark.sparkContext.broadcast(block)
        _searched(candidates, shared, width).write.parquet(f"{path}/found/block={at}")
        shared.destroy()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        spark.read.schema(f"{FOUND}, block long")
        .parquet(f"{path}/found")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _with_thresholds(queries: DataFrame, seeds: tuple[np.ndarray, np.ndarray], width: int, k: int) -> DataFrame:
    """Queries with the k-th best score that each has among the sample: (vec_id, vector, threshold)."""
    shared = queries.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                block = Block(batch.column(0).to_numpy(), _matrix(batch.column(1), width), k)
                _raise_thresholds(block, *shared.value)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(block.threshold)], ["vec_id", "vector", "threshold"]
                )

    return queries.select("vec_id", "vector").mapInArrow(run, ASKED)


def _one_chunk(column: pa.ChunkedArray) -> pa.ListArray:
    joined = column.combine_chunks()
    return joined.chunk(0) if isinstance(joined, pa.ChunkedArray) else joined


def _raise_thresholds(block: Block, ids: np.ndarray, matrix: np.ndarray) -> None:
    """Set each query's threshold to its k-th best score among the sample."""
    held = tuple(np.zeros(0, np.int64) for _ in range(3))
    for at in range(0, len(ids), TILE[0]):
        part = slice(at, at + TILE[0])
        found = block.best(ids[part], matrix[part])
        held = block.top(*(np.concatenate(c) for c in zip(held, found, strict=True)))
        query, first, count = np.unique(held[0], return_index=True, return_counts=True)
        full = count >= block.k
        block.threshold[query[full]] = held[2][first[full] + block.k - 1]

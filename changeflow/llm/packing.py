"""Best-two-fit packing of token pieces into sequences of fixed length.

Only lengths matter to packing, and there are no more lengths than tokens in a sequence.
So pieces are counted by length, the counts are packed on the driver, and every piece
then finds its place by its length and its rank among pieces of that length. Nothing
that grows with the documents leaves the executors.

A sequence is filled greedily, longest piece that fits first. Then its smallest piece is
taken out again if two unpacked pieces fit the widened gap more tightly. The sequence so
found is made as often as the counts allow at once, which uses up at least one length.

Null and empty texts are a single end token. Repeated rows are packed each by itself.
An empty table gives no pieces. Null ids are kept and come first among equal lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.encoding import word_encoder
from changeflow.llm.tables import cut

CAPACITY = 4096
END_ID = 1
#: Pieces of one length are numbered in groups of about so many, but 64 groups at least.
GROUP_ROWS = 1 << 17

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACE = "sequence_id long, offset long"


def pieces(documents: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """Every document's ids and the end token, cut where longer than a sequence."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_encoder(vocabulary), np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            found = encoder.all_ids(batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                ids = np.append(ids, end).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut_up, PIECES)


@dataclass(frozen=True)
class Plan:
    """Where pieces go: entry i takes ranks from ``first[i]`` of length ``length[i]``.

    Each of its sequences, numbered from ``sequence[i]``, takes ``copies[i]`` of them in
    turn, from ``offset[i]`` on. Entries are ordered by length and rank.
    """

    length: np.ndarray
    first: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # lengths come first in the order, ranks second: search within a length's entries
        low = np.searchsorted(self.length, length, "left")
        high = np.searchsorted(self.length, length, "right")
        while (high - low > 1).any():
            middle = (low + high) // 2
            up = (self.first[middle] <= rank) & (high - low > 1)
            low, high = np.where(up, middle, low), np.where(up | (high - low <= 1), high, middle)
        turn = rank - self.first[low]
        copies = self.copies[low]
        return self.sequence[low] + turn // copies, self.offset[low] + turn % copies * length


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack a histogram of lengths: at most a few sequences patterns for each length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    used = np.zeros(capacity + 1, np.int64)
    entries: list[tuple[int, int, int, int, int]] = []
    made = 0
    while left.any():
        pattern = _tightened(_filled(left, capacity), left, capacity)
        times = min(int(left[n]) // k for n, k in pattern.items())
        offset = 0
        for n in sorted(pattern, reverse=True):
            k = pattern[n]
            entries.append((n, int(used[n]), k, made, offset))
            offset += n * k
            used[n] += k * times
            left[n] -= k * times
        made += times
    table = np.array(sorted(entries), np.int64).reshape(-1, 5)
    return Plan(*(np.ascontiguousarray(c) for c in table.T), sequences=made)


def _longest(left: np.ndarray, without: dict[int, int]) -> np.ndarray:
    """For every gap, the longest length that fits it and is left; 0 if there is none."""
    free = left.copy()
    for n, k in without.items():
        free[n] -= k
    lengths = np.where(free > 0, np.arange(len(free)), 0)
    return np.maximum.accumulate(lengths)


def _filled(left: np.ndarray, capacity: int) -> dict[int, int]:
    """Greedy filling: again and again the longest piece that fits."""
    fits = _longest(left, {})
    pattern: dict[int, int] = {}
    gap = capacity
    while gap and (n := int(fits[gap])):
        pattern[n] = min(int(left[n]), gap // n)
        gap -= n * pattern[n]
        if pattern[n] == left[n]:
            fits = _longest(left, pattern)
    return pattern


def _tightened(pattern: dict[int, int], left: np.ndarray, capacity: int) -> dict[int, int]:
    """The smallest piece replaced by two unpacked ones that fit more tightly, if any do."""
    gap = capacity - sum(n * k for n, k in pattern.items())
    smallest = min(pattern)
    if not gap or smallest == max(pattern) and pattern[smallest] == 1:
        return pattern
    room = gap + smallest
    rest = {**pattern, smallest: pattern[smallest] - 1}
    free = left.copy()
    for n, k in rest.items():
        free[n] -= k
    fits = _longest(free, {})
    first = np.flatnonzero(free[: room + 1] > 0)
    first = first[first > 0]
    second = fits[room - first]
    alone = (second == first) & (free[first] < 2)
    second = np.where(alone, np.where(first > 0, fits[first - 1], 0), second)
    total = np.where(second > 0, first + second, 0)
    if not len(total) or total.max() <= smallest:
        return pattern
    best = int(total.argmax())
    changed = {n: k for n, k in rest.items() if k}
    for n in (int(first[best]), int(second[best])):
        changed[n] = changed.get(n, 0) + 1
    return changed


def ranked(found: DataFrame, total: int) -> DataFrame:
    """Number the pieces of each length from 0 (``rank``), a frequent length in groups."""
    groups = max(64, total // GROUP_ROWS)
    dealt = found.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    earlier = Window.partitionBy("length").orderBy("_group").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = (
        dealt.groupBy("length", "_group")
        .agg(F.count("*").alias("_rows"))
        .select("length", "_group", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_at"))
    )
    within = Window.partitionBy("length", "_group").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.withColumn("_row", F.row_number().over(within) - 1)
        .join(before, ["length", "_group"])
        .withColumn("rank", F.col("_at") + F.col("_row"))
        .drop("_group", "_row", "_at")
    )


def packed(
    documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """All documents' pieces with their sequence and place: PIECES and PLACE."""
    spark = documents.sparkSession
    found = cut(pieces(documents, vocabulary, capacity, end_id))
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(plan(counts, capacity))

    @F.pandas_udf(PLACE)
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = shared.value.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked(found, sum(counts.values())).select(
        "doc_id", "piece", "start", "length", "ids_crc32", place("length", "rank").alias("_place")
    ).select("doc_id", "piece", "start", "length", "ids_crc32", "_place.*")

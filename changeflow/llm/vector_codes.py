"""Vectors compressed to one code per part, with codebooks from a few rounds of Lloyd's.

Vectors become whole numbers, ``floor(scale * x)``, and are cut into equal consecutive
parts. Every part position has a codebook of entries, which starts as that part of the
vectors of smallest ids. A round assigns each part to its nearest entry, then moves every
entry to the componentwise floor of its parts' mean; unused entries stay. Parts are
assigned once more at the end. All arithmetic is on whole numbers, and ties go to the
lower entry, so results do not depend on how the rows are dealt out.

*Active entries.* A row keeps the entry and the exact distance of each of its parts. After
a round only some entries have moved. Where a part's own entry stayed, its distance still
holds, and no entry that stayed can have become nearer: only the moved ones are compared.
Where it moved, all entries are. The rows with that state are written to the checkpoint
folder once a round; a lost executor repeats its tasks of one round.

Codebooks, and the sums that move them, have as many numbers as a vector has components
times entries, whatever the number of rows; only they reach the driver.

Vectors take no part if they are null or hold null or non-finite components, or components
so large that squared distances would not fit 64 bits (LARGEST after scaling). Shorter
vectors count as followed by zeros up to the longest, and all up to a multiple of the
parts. Rows that share an id are rows of their own, ordered by their vectors where the
first codebook is taken; rows without an id come last there. Labels may be null: nulls are
one label. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.tables import cut, importable

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Whole components are smaller than this.
LARGEST = 1 << 25
#: Rows compared with the codebooks at a time.
TILE = 2048

STATE = "vec_id long, _label string, vector array<int>, codes binary, distances array<long>"
SUMS = "part int, entry int, n long, sums array<long>"


def whole_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """Usable rows: vec_id, _label (a text, also for the null label), vector as whole numbers."""
    bound = F.lit(LARGEST / scale - 1)
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= bound))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("int"))
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    return embeddings.where(F.col("embedding").isNotNull() & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("_label"), whole.alias("vector")
    )


def first_vectors(rows: DataFrame, count: int) -> list[list[int]]:
    """The vectors of the smallest ids.

    Ids alone are ordered first, so that few whole vectors are.
    """
    ids = [r.vec_id for r in rows.select("vec_id").where("vec_id IS NOT NULL").orderBy("vec_id").limit(count).collect()]
    wanted = F.col("vec_id") <= ids[-1] if ids else F.lit(False)
    if len(ids) < count:
        wanted = wanted | F.col("vec_id").isNull()
    first = rows.where(wanted).orderBy(F.asc_nulls_last("vec_id"), "vector").limit(count)
    return [r.vector for r in first.collect()]


class Codebooks:
    """The entries of every part position, and which of them moved last."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray | None = None) -> None:
        self.entries = entries
        self.moved = np.ones(entries.shape[:2], bool) if moved is None else moved

    @classmethod
    def of(cls, vectors: list[list[int]], parts: int, width: int) -> Codebooks:
        filled = matrix(pa.array(vectors, pa.list_(pa.int32())), parts * width)
        return cls(filled.reshape(len(vectors), parts, width).swapaxes(0, 1).copy())

    def distances(self, part: int, rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Exact squared distances of a part's rows to some of its entries."""
        own = self.entries[part][entries]
        peak = int(max(np.abs(rows).max(initial=0), np.abs(own).max(initial=0)))
        # floating sums are exact as long as every partial sum fits their 53 bits
        kind = np.float64 if 4 * rows.shape[1] * peak * peak < 1 << 53 else np.int64
        a, b = rows.astype(kind), own.astype(kind)
        out = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        return out.astype(np.int64)

    def nearest(self, part: int, rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest of some entries (ascending), the lowest of equals, and its distance."""
        found = self.distances(part, rows, entries)
        best = found.argmin(1)
        return entries[best], found[np.arange(len(rows)), best]

    def assigned(self, part: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries and distances from a scan of all entries."""
        return self.nearest(part, rows, np.arange(self.entries.shape[1]))

    def reassigned(
        self, part: int, rows: np.ndarray, codes: np.ndarray, distances: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The same from the entries and distances that held before the last move."""
        codes, distances = codes.astype(np.int64), distances.copy()
        moved = np.flatnonzero(self.moved[part])
        stale = self.moved[part][codes]
        if stale.any():
            codes[stale], distances[stale] = self.assigned(part, rows[stale])
        fixed = np.flatnonzero(~stale)
        if len(moved) and len(fixed):
            entry, found = self.nearest(part, rows[fixed], moved)
            own, kept = codes[fixed], distances[fixed]
            better = (found < kept) | ((found == kept) & (entry < own))
            codes[fixed] = np.where(better, entry, own)
            distances[fixed] = np.where(better, found, kept)
        return codes, distances

    def after(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """The codebooks whose used entries are the floors of their parts' means."""
        entries = self.entries.copy()
        for (part, entry), (count, total) in sums.items():
            entries[part, entry] = [t // count for t in total]
        return Codebooks(entries, (entries != self.entries).any(2))

    def digest(self) -> str:
        """SHA-256 of all components as decimals, by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Vectors of one length as rows of 64-bit numbers."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def assigned(rows: DataFrame, books: Codebooks) -> DataFrame:
    """Rows with the codes and distances of their parts.

    Rows that have some already, from before the last move, are only looked at again where
    an entry that moved may matter.
    """
    parts, _, width = books.entries.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)
    known = "codes" in rows.columns
    columns = ["vec_id", "_label", "vector"] + ["codes", "distances"] * known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, TILE):
                batch = whole.slice(at, TILE)
                n = batch.num_rows
                values = matrix(batch.column(2), parts * width).reshape(n, parts, width)
                codes, distances = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64)
                if known:
                    codes[:] = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, parts)
                    distances[:] = batch.column(4).flatten().to_numpy().reshape(n, parts)
                for part in range(parts):
                    if known:
                        found = own.reassigned(part, values[:, part], codes[:, part], distances[:, part])
                    else:
                        found = own.assigned(part, values[:, part])
                    codes[:, part], distances[:, part] = found
                ends = np.arange(0, n * parts + 1, parts, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:3],
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(distances.ravel())),
                    ],
                    ["vec_id", "_label", "vector", "codes", "distances"],
                )

    return rows.select(*columns).mapInArrow(run, STATE)


def summed(state: DataFrame, books: Codebooks) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Of every used entry, how many parts it has and their componentwise sum.

    Tasks add up their own rows; at most one row an entry leaves each, and reaches the driver.
    """
    parts, entries, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        place = np.arange(parts)
        for whole in batches:
            for at in range(0, whole.num_rows, TILE):
                batch = whole.slice(at, TILE)
                n = batch.num_rows
                values = matrix(batch.column(0), parts * width).reshape(n, parts, width)
                codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, parts)
                np.add.at(sums, (place, codes), values)
                np.add.at(counts, (place, codes), 1)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(counts[part, entry]),
                pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "sums"],
        )

    found = state.select("vector", "codes").mapInArrow(run, SUMS)
    total = [F.sum(F.col("sums")[i]).alias(f"_{i}") for i in range(width)]
    grouped = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total)
    return {
        (r.part, r.entry): (r.n, [r[f"_{i}"] for i in range(width)]) for r in grouped.collect()
    }


def compressed(
    embeddings: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """Every usable row's codes and distances, and the codebooks they refer to.

    The rows have vec_id, _label, vector, codes (a byte a part) and distances; there may be
    256 entries at most.
    """
    if not 1 <= entries <= 256:
        raise ValueError(f"a codebook has 1 to 256 entries, not {entries}")
    importable(embeddings.sparkSession)
    rows = whole_vectors(embeddings, scale)
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return embeddings.sparkSession.createDataFrame([], STATE), None
    width = max(1, -(-longest // parts))
    zeros = F.array_repeat(F.lit(0), F.lit(parts * width) - F.size("vector"))
    rows = rows.withColumn("vector", F.concat("vector", zeros))
    books = Codebooks.of(first_vectors(rows, entries), parts, width)
    state = cut(assigned(rows, books))
    for number in range(rounds):
        books = books.after(summed(state, books))
        state = assigned(state, books)
        if number + 1 < rounds:
            state = cut(state)
    return state, books


def decoded(state: DataFrame, books: Codebooks) -> DataFrame:
    """The vectors that codes stand for, their entries one after the other: vec_id, vector."""
    shared = state.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value.entries
        for batch in batches:
            codes = [np.frombuffer(c.as_py(), np.uint8) for c in batch.column(1)]
            vectors = [entries[np.arange(len(c)), c].ravel() for c in codes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(vectors, pa.list_(pa.int64()))], ["vec_id", "vector"]
            )

    return state.select("vec_id", "codes").mapInArrow(run, "vec_id long, vector array<long>")


def with_errors(state: DataFrame, books: Codebooks | None) -> DataFrame:
    """Codes as text with their errors: vec_id, code, error, label_error, codebooks_sha256.

    Errors are added up by label before they meet the rows again, and both sides of that
    join are dealt out by it, so that it can be split where a label is frequent.
    """
    told = state.select(
        "vec_id",
        "_label",
        F.lower(F.hex("codes")).alias("code"),
        F.aggregate("distances", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"),
    )
    told = cut(told)
    by_label = told.groupBy("_label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")
    )
    by_label = by_label.withColumn("_label", F.concat("_label", F.lit("")))
    return told.join(by_label, "_label").select(
        "vec_id",
        "code",
        "error",
        "label_error",
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"),
    )

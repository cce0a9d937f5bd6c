"""Token files with directly addressable codes.

Ids are split into chunks of eight bits. Level 0 holds every id's low chunk and a bitmap
that says which ids go on; level 1 holds the next chunks of those that do, and so on. A
rank directory counts the bitmap's ones before each block of 512 bits. The chunk of an id
on the next level lies at the rank of its bit, so any id, or run of ids, is read without
decoding what precedes it.

A segment holds the ids of consecutive documents and is one binary value of a Parquet
row; a folder of segments in ascending id order is the token file. Every segment knows
its part (the task that wrote it) and the ids before it in that part, so the place of a
document in the whole stream needs the totals of the parts only. Row groups are small, so
a task that reads a large file decodes a few megabytes of it at a time.

Null and empty texts have the end token alone. Null ids come first; equal ids are ordered
by their texts. An empty table gives an empty folder that reads back as no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.encoding import word_encoder

END_ID = 2
#: Ids after which a segment is closed; a document is never split over two.
SEGMENT_IDS = 1 << 16
#: Parquet's row groups and pages are closed by bytes, looked at every few segments (its own
#: defaults let a page grow to 100 segments and a row group to 128 MB). Codes do not repeat.
FILE_OPTIONS = {
    "parquet.block.size": 8 << 20,
    "parquet.block.size.row.check.min": 4,
    "parquet.page.size": 1 << 20,
    "parquet.page.size.row.check.min": 4,
    "parquet.enable.dictionary": "false",
}
RANK_BITS = 512
#: Characters of chunks a worker keeps: this job does nothing else, so it may keep more.
KEPT_CHARS = 1 << 23

SEGMENTS = (
    "part int, segment int, first_id long, n_ids long, doc_ids array<long>, "
    "doc_lengths array<long>, codes binary"
)
DOCUMENTS = "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long"


def encode(ids: np.ndarray) -> bytes:
    """The codes of a run of ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(rest) // RANK_BITS) * RANK_BITS // 8, np.uint8)
        padded[: len(bits)] = bits
        ones = np.bitwise_count(padded).reshape(-1, RANK_BITS // 8).sum(1, dtype=np.uint32)
        ranks = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])
        levels.append(
            struct.pack("<Q", len(rest))
            + (rest & 0xFF).astype(np.uint8).tobytes()
            + padded.tobytes()
            + ranks.astype("<u4").tobytes()
        )
        if not more.any():
            return struct.pack("<B", len(levels)) + b"".join(levels)
        rest = rest[more] >> np.uint32(8)


class Codes:
    """Random access to encoded ids."""

    def __init__(self, data: bytes) -> None:
        self._levels = []
        at = 1
        for _ in range(data[0]):
            (n,) = struct.unpack_from("<Q", data, at)
            blocks = -(-n // RANK_BITS)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bits = np.frombuffer(data, np.uint8, blocks * RANK_BITS // 8, at + 8 + n)
            ranks = np.frombuffer(data, "<u4", blocks + 1, at + 8 + n + len(bits))
            at += 8 + n + len(bits) + 4 * len(ranks)
            self._levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self._levels[0][0])

    def _rank(self, level: int, position: int) -> int:
        """Ones of the level's bitmap before a position."""
        _, bits, ranks = self._levels[level]
        block, byte = position // RANK_BITS, position // 8
        ones = int(np.bitwise_count(bits[block * RANK_BITS // 8 : byte]).sum())
        if position % 8:
            ones += int(bits[byte] & ((1 << position % 8) - 1)).bit_count()
        return int(ranks[block]) + ones

    def __getitem__(self, position: int) -> int:
        value, shift = 0, 0
        for level, (chunks, bits, _) in enumerate(self._levels):
            value |= int(chunks[position]) << shift
            if not bits[position // 8] >> position % 8 & 1:
                break
            position, shift = self._rank(level, position), shift + 8
        return value

    def run(self, start: int, end: int) -> np.ndarray:
        """Ids from start to end, read from the chunks of that run alone."""
        out = np.zeros(end - start, np.uint32)
        at = np.arange(end - start)
        for level, (chunks, bits, _) in enumerate(self._levels):
            out[at] |= chunks[start:end].astype(np.uint32) << np.uint32(8 * level)
            held = np.unpackbits(bits[start // 8 : -(-end // 8)], bitorder="little")
            more = held[start % 8 : start % 8 + end - start].astype(bool)
            if not more.any():
                break
            at = at[more]
            start = self._rank(level, start)
            end = start + len(at)
        return out


def write(documents: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents, in ascending doc_id order, as segments below path."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_encoder(vocabulary, KEPT_CHARS), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        held: list[tuple[int | None, np.ndarray]] = []
        first = size = number = 0

        def closed() -> pa.RecordBatch:
            row = {
                "part": part,
                "segment": number,
                "first_id": first,
                "n_ids": size,
                "doc_ids": [d for d, _ in held],
                "doc_lengths": [len(i) for _, i in held],
                "codes": encode(np.concatenate([i for _, i in held])),
            }
            return pa.RecordBatch.from_pylist([row], _SEGMENT_SCHEMA)

        for batch in batches:
            found = encoder.all_ids(batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                held.append((doc_id, np.append(ids, end)))
                size += len(ids) + 1
                if size >= SEGMENT_IDS:
                    yield closed()
                    first, size, number, held = first + size, 0, number + 1, []
        if held:
            yield closed()

    ordered = documents.select(F.col("doc_id").cast("long"), "text").repartitionByRange(
        "doc_id", F.xxhash64("text")
    )
    ordered.sortWithinPartitions("doc_id", F.xxhash64("text"), "text").mapInArrow(
        segments, SEGMENTS
    ).write.options(**FILE_OPTIONS).parquet(path)


_SEGMENT_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("first_id", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_lengths", pa.list_(pa.int64())),
        ("codes", pa.binary()),
    ]
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a token file: doc_id, start, n_tokens and the CRC of its ids."""
    stored = spark.read.schema(SEGMENTS).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, ids, sizes, data = (
                    batch.column(c)[row].as_py()
                    for c in ("part", "first_id", "doc_ids", "doc_lengths", "codes")
                )
                starts = np.concatenate([[0], np.cumsum(sizes)])
                codes = Codes(data)
                read_back = codes.run(0, len(codes)).astype("<u4")
                crc = [zlib.crc32(part) for part in np.split(read_back, starts[1:-1])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(ids, pa.int64()),
                        pa.array(first + starts[:-1], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"],
                )

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        stored.groupBy("part")
        .agg(F.sum("n_ids").alias("_ids"))
        .select("part", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        stored.mapInArrow(documents, DOCUMENTS)
        .join(F.broadcast(parts), "part")  # one row for each task that wrote
        .select(
            "doc_id",
            (F.col("_before") + F.col("start_in_part")).alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )

"""Frames a micro-batch uses more than once, and the bound on what it broadcasts."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.session import remove, scratch_dir

#: Frames of at most so many bytes are broadcast; they are measured first.
BROADCAST_BYTES = 64 << 20


def measured(frame: DataFrame) -> tuple[int, int]:
    """Rows of a frame, and about how many bytes they take once broadcast."""
    texts = [f.name for f in frame.schema if isinstance(f.dataType, T.StringType)]
    row_bytes = F.lit(16 * (len(frame.columns) + 1))
    for name in texts:
        row_bytes = row_bytes + F.coalesce(F.octet_length(name), F.lit(0))
    rows, size = frame.agg(F.count("*"), F.sum(row_bytes)).first()
    return rows, size or 0


class Kept:
    """Keeps frames in memory or on disk for as long as a batch uses them.

    A lost executor costs a recomputation, nothing else: every frame follows from
    the batch and the pinned version of the tables.
    """

    def __enter__(self) -> Kept:
        self._frames: list[DataFrame] = []
        self._paths: list[tuple[SparkSession, str]] = []
        return self

    def __call__(self, frame: DataFrame) -> DataFrame:
        self._frames.append(frame.persist(StorageLevel.MEMORY_AND_DISK))
        return frame

    def written(self, frame: DataFrame) -> DataFrame:
        """The frame written to the shared folder, for as long as the batch needs it.

        What follows from it is planned from there, not from all that led to it.
        """
        path = scratch_dir(frame.sparkSession, "batch")
        self._paths.append((frame.sparkSession, path))
        frame.write.parquet(path)
        return frame.sparkSession.read.schema(frame.schema).parquet(path)

    def __exit__(self, *_) -> None:
        for spark, path in self._paths:
            remove(spark, path)
        for frame in self._frames:
            frame.unpersist()

"""Reading the test tables and cutting lineage, for the modules of this folder."""

from __future__ import annotations

import gc
import math
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import checkpoint_root, remove, scratch_dir


#: Rows sent to a Python worker at a time: texts are long, and a worker holds a batch whole.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Batches sent to them are made fit for texts. On a cluster that does not hold the package
    at the same place, submit it with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    if spark.conf.get(BATCH_ROWS) == "10000":  # Spark's own default, meant for short rows
        spark.conf.set(BATCH_ROWS, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(documents: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """Documents whose columns but ``used`` have names no operator gives, and the way back.

    Selecting the second from a frame made of the first restores the names.
    """
    names = [c if c in used else f"extra {i}" for i, c in enumerate(documents.columns)]
    back = [F.col(f"`{n}`").alias(c) for n, c in zip(names, documents.columns, strict=True)]
    return documents.toDF(*names), back


def cut(frame: DataFrame) -> DataFrame:
    """The frame computed once into the shared checkpoint folder, lineage cut.

    The files go when Spark's cleaner finds the frame unused, if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    spark = frame.sparkSession
    root = checkpoint_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return frame.checkpoint(eager=True)


class Written:
    """Frames written as Parquet to the shared folder, removed as soon as they have served.

    Like :func:`cut` this ends a lineage, with less on disk and nothing left behind: what was
    shuffled for a frame goes once it is written. Several frames are one after another written
    as one, so that only one of them at a time has shuffle files.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def __call__(self, *frames: DataFrame) -> DataFrame:
        path, schema, frames = scratch_dir(self.spark, "written"), frames[0].schema, list(frames)
        while frames:
            frames.pop(0).write.mode("append").parquet(path)
            self._forget()
        kept = self.spark.read.schema(schema).parquet(path)
        self.paths[id(kept)] = (kept, path)
        return kept

    def drop(self, *frames: DataFrame) -> None:
        """Remove frames that nothing is computed from any more, and what was shuffled for them."""
        for frame in frames:
            _, path = self.paths.pop(id(frame))
            remove(self.spark, path)
        self._forget()

    def _forget(self) -> None:
        """Shuffle files go when the driver has collected the plans they belong to."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rekeyed(frame: DataFrame, *keys: str) -> DataFrame:
    """The frame with its (whole-number) keys computed anew.

    A sum by key is already dealt out by that key, so a join on it would read it in place,
    and a join without an exchange of its own on either side cannot be split where a key is
    frequent. The computed key makes the join deal out its sides itself.
    """
    return frame.withColumns({k: F.col(k).bitwiseXOR(F.lit(0)) for k in keys})


def least_hashed(frame: DataFrame, key: str, most: int, rows: int) -> DataFrame:
    """The ``most`` rows of least hash of a whole-number key, ties by the key, of ``rows`` in all.

    Of a large frame only about so many rows are below the hash that is looked at, so the
    task that puts them in order does not receive as many from every partition.
    """
    if rows > most:
        share = (most + 8 * math.sqrt(most)) / rows
        if share < 1:
            frame = frame.where(F.xxhash64(key) <= F.lit(int(share * 2.0**64) - (1 << 63)))
    return frame.orderBy(F.xxhash64(key), key).limit(most)

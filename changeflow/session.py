"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SESSION_CONF = {
    # Timestamps are naive UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    # One key may hold a third of all rows: let the skew-join rule split it even
    # where that costs the operator above one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Gathering a table writes partitions of about this size, one task each: at 64 MB,
    # the default, a table of millions of rows is written by one task while others wait.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # What is broadcast unasked is told by the size of its files. Sorted keys take three bytes
    # a row there, and more than a hundred in the table that every executor holds.
    "spark.sql.sources.fileCompressionFactor": "8",
    # Parquet's reader else asks for a row group at once, and on a local file system the thread
    # that reads it keeps as much memory outside the heap, 134 MB, for as long as it lives.
    "parquet.hadoop.vectored.io.enabled": "false",
}

_local_roots: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings above to an existing session."""
    for key, value in _SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster that does not hold the package at the same place, submit it with
    ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder stands in for it only in local mode; on a cluster the
    executors could not see it, so an unset folder is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="changeflow-")
        context.setCheckpointDir(_local_roots[context.applicationId])
    return _local_roots[context.applicationId]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder on whatever file system it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stored(frame: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back: lineage cut, size known."""
    path = scratch_dir(frame.sparkSession, "stored")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)

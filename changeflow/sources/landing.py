"""Topic directories: Parquet folders that stand in for topics in file streams.

Each row carries its ``kafka_partition`` and ``kafka_offset``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from changeflow import schemas


def land(events: DataFrame, path: str) -> None:
    """Append events to a topic directory."""
    events.write.mode("append").parquet(path)


def read_landing(
    spark: SparkSession, path: str, event: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Stream a topic directory under the fixed schema of its events."""
    schema = T.StructType(schemas.POSITION.fields + event.fields)
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)

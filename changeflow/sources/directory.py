"""Topics as directories: a streaming source and a writer with the columns of a topic.

Every append is a folder of its own, complete once it holds ``_SUCCESS``: Parquet files of
key and value by offset, below a folder for each partition. The source keeps one offset a
partition, the next it will read, and reads row groups as Arrow batches. It starts at the
earliest or at the latest offsets, and takes about so many records a micro-batch:
whole row groups, until they reach the limit.

The limit counts from where the last micro-batch ended. So that it does after a restart too,
that place is noted in the file named by ``progress``; without one, the first micro-batch
after a restart takes all there is.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from changeflow.session import importable

FORMAT = "topic_directory"
SCHEMA = "key string, value binary, partition int, offset long"
#: Records of a row group: the step of the admission limit, and the least a task reads.
GROUP_RECORDS = 10_000
#: Partitions of a topic that is written here.
PARTITIONS = 3


def append(records: DataFrame, path: str, group_records: int = GROUP_RECORDS) -> None:
    """Append records (key, value, partition, offset) to a topic.

    Offsets of a partition rise from one append to the next.
    """
    ordered = records.select("key", F.col("value").cast("binary").alias("value"), "partition", "offset")
    ordered = ordered.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset")
    writer = ordered.write.option("parquet.block.row.count.limit", group_records)
    writer.partitionBy("partition").parquet(f"{path}/{uuid4().hex}")


def append_keyed(records: DataFrame, path: str, partitions: int = PARTITIONS) -> None:
    """Append records (key, value) behind those a topic has, each key to a partition of its own.

    One writer at a time. Records of a key keep no order among themselves: a batch has the
    last of each, or rows that stand side by side.
    """
    reader = TopicReader({"path": path})
    reader._look()
    ends = F.create_map(*[F.lit(x) for p in range(partitions) for x in (p, reader._ends().get(str(p), 0))])
    placed = records.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int"))
    number = F.row_number().over(Window.partitionBy("partition").orderBy("key", "value")) - 1
    append(placed.withColumn("offset", (ends[F.col("partition")] + number).cast("long")), path)


def read_directory(spark: SparkSession, path: str, **options) -> DataFrame:
    """A topic as a stream; ``options`` are startingOffsets, maxOffsetsPerTrigger, progress."""
    importable(spark)
    spark.dataSource.register(TopicDirectory)
    named = {k: str(v) for k, v in options.items() if v is not None}
    return spark.readStream.format(FORMAT).options(**named).load(path)


@dataclass(frozen=True)
class Group:
    """A row group: where it is, and the offsets in it."""

    file: str
    number: int
    first: int
    last: int
    records: int


class Range(InputPartition):
    """Row groups of a topic partition, of which offsets from one up to another are read."""

    def __init__(self, partition: int, start: int, end: int, groups: list[Group]) -> None:
        self.partition, self.start, self.end, self.groups = partition, start, end, groups


class TopicDirectory(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> TopicReader:
        return TopicReader(dict(self.options))


class TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        options = {name.lower(): value for name, value in options.items()}
        self.path = options["path"]
        self.latest = options.get("startingoffsets", "earliest") == "latest"
        self.limit = int(options.get("maxoffsetspertrigger", 0))
        self.progress = options.get("progress")
        self.groups: dict[int, list[Group]] = {}
        self.folders: set[str] = set()
        self.initial: dict[str, int] | None = None
        self.planned: dict[str, int] | None = None

    # --- offsets --------------------------------------------------------------------

    def initialOffset(self) -> dict:
        """Where a query without a checkpoint starts: found once, before anything is read."""
        if self.initial is None:
            self._look()
            self.initial = self._ends() if self.latest else {str(p): own[0].first for p, own in self.groups.items()}
        return self.initial

    def latestOffset(self) -> dict:
        self._look()
        if self.planned is None:
            initial = self.initialOffset()
            # without a note, a restart cannot be told from a start: nothing is held back
            self.planned = self._noted() or (initial if self.progress else None)
        if self.limit and self.planned is not None:
            self.planned = self._admitted(self.planned)
        else:
            self.planned = {**(self.planned or {}), **self._ends()}
        return self.planned

    def _ends(self) -> dict[str, int]:
        return {str(p): own[-1].last + 1 for p, own in self.groups.items()}

    def _admitted(self, start: dict[str, int]) -> dict[str, int]:
        """Offsets after the row groups that follow ``start``, a share of the limit each partition."""
        end, share = dict(start), max(1, self.limit // max(1, len(self.groups)))
        for partition, own in self.groups.items():
            taken, key = 0, str(partition)
            for group in own:
                if taken < share and group.last >= end.get(key, 0):
                    taken, end[key] = taken + group.records, group.last + 1
        return end

    # --- the directory --------------------------------------------------------------

    def _look(self) -> None:
        """Take up the complete appends that have come."""
        files, root = fs.FileSystem.from_uri(self.path)
        for folder in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if folder.type != fs.FileType.Directory or folder.path in self.folders:
                continue
            found = files.get_file_info(fs.FileSelector(folder.path, recursive=True))
            if not any(f.base_name == "_SUCCESS" for f in found):
                continue
            self.folders.add(folder.path)
            for file in found:
                if file.extension == "parquet" and not file.base_name.startswith((".", "_")):
                    partition = int(file.path.split("/")[-2].partition("=")[2])
                    self.groups.setdefault(partition, []).extend(_groups(files, file.path))
        for own in self.groups.values():
            own.sort(key=lambda g: g.first)

    def _noted(self) -> dict[str, int] | None:
        if self.progress is None:
            return None
        files, path = fs.FileSystem.from_uri(self.progress)
        if files.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with files.open_input_stream(path) as stream:
            return json.loads(stream.read())

    # --- reading --------------------------------------------------------------------

    def partitions(self, start: dict, end: dict) -> list[Range]:
        """The row groups between two offsets, each a task of its own."""
        self._look()
        self.planned = {p: max(at, (self.planned or {}).get(p, 0)) for p, at in end.items()}
        if self.progress is not None:
            files, path = fs.FileSystem.from_uri(self.progress)
            with files.open_output_stream(path) as stream:
                stream.write(json.dumps(self.planned).encode())
        return [
            Range(partition, start.get(str(partition), 0), end.get(str(partition), 0), [group])
            for partition, own in self.groups.items()
            for group in own
            if group.last >= start.get(str(partition), 0) and group.first < end.get(str(partition), 0)
        ]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        for group in partition.groups:
            files, path = fs.FileSystem.from_uri(group.file)
            with files.open_input_file(path) as file:
                table = pq.ParquetFile(file).read_row_group(group.number, columns=["key", "value", "offset"])
            for batch in table.to_batches():
                offsets = batch["offset"].to_numpy()
                batch = batch.filter(pa.array((offsets >= partition.start) & (offsets < partition.end)))
                number = pa.array([partition.partition] * batch.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch["key"], batch["value"], number, batch["offset"]], ["key", "value", "partition", "offset"]
                )


def _groups(files: fs.FileSystem, path: str) -> list[Group]:
    """The row groups of a file, from its footer."""
    with files.open_input_file(path) as file:
        footer = pq.ParquetFile(file).metadata
    names = [footer.schema.column(i).name for i in range(footer.num_columns)]
    offset, out = names.index("offset"), []
    for number in range(footer.num_row_groups):
        group = footer.row_group(number)
        told = group.column(offset).statistics
        name = path if files.type_name == "local" else f"{files.type_name}://{path}"
        out.append(Group(name, number, told.min, told.max, group.num_rows))
    return out

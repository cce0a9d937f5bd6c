"""Several tables committed together: plain Parquet folders under one manifest.

A batch writes its rows of every table into folders of its own, then creates the manifest
of the next version, which names every folder that counts. A batch is therefore visible in
all tables or in none; a crash before the manifest leaves folders nobody reads, one after
it finds its batch recorded; of two writers of one version one fails, and neither touches
the other's rows. The manifest is created by a rename that refuses an existing target.

A batch is known by its source, by the streaming query that brought it (a fresh checkpoint
is a new query, whose batches count from zero) and by its number. ``notes`` are small facts
committed with it: counters, positions, how far consumers have read.

A table with keys is the state of each key: the rows of the last version that wrote it.
Now and then the folders of a table are gathered into one, partitioned by bucket: of state
tables, only the buckets that were written since are.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.streaming.files import create, delete, names, read

VERSION = "commit_version"
BUCKET = "id_bucket"
#: Versions after which the folders of a table are gathered.
GATHER_EVERY = 100
#: Manifests kept behind the newest one, for readers that pinned an older version.
KEPT_MANIFESTS = 50
#: Set by a streaming query for the calls it makes; stored in its checkpoint.
QUERY_ID = "sql.streaming.queryId"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def batch_source(source: str, batch: DataFrame) -> str:
    """The source of a micro-batch: its name and, in a streaming query, the query's id."""
    query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
    return f"{source}#{query}" if query else source


class CommitConflict(RuntimeError):
    """Another writer created this version first."""


@dataclass(frozen=True)
class Table:
    """A table's columns; of a state table its keys, and which rows (SQL) end their key.

    ``lookup`` is the column its gathered folders are partitioned by, in ``buckets``.
    """

    schema: T.StructType
    keys: tuple[str, ...] = ()
    gone: str = "false"
    lookup: str | None = None
    buckets: int = 1


@dataclass(frozen=True)
class Part:
    """A folder and the versions in it; of a gathered one, the buckets that still count."""

    folder: str
    first: int
    last: int
    buckets: list[int] | None = None


@dataclass(frozen=True)
class Head:
    """What is visible: a version, the last batch of each source, the folders that count."""

    version: int = 0
    applied: dict[str, int] = field(default_factory=dict)
    parts: dict[str, list[Part]] = field(default_factory=dict)
    notes: dict[str, dict] = field(default_factory=dict)

    def holds(self, source: str, batch_id: int) -> bool:
        return self.applied.get(source, -1) >= batch_id

    def note(self, kind: str) -> dict:
        return dict(self.notes.get(kind, {}))

    @classmethod
    def of(cls, text: str) -> Head:
        told = json.loads(text)
        told["parts"] = {n: [Part(**p) for p in own] for n, own in told["parts"].items()}
        return cls(**told)

    def folders(self) -> set[tuple[str, str]]:
        return {(name, part.folder) for name, own in self.parts.items() for part in own}


class Attempt:
    """One try at the version after a head: the folders it wrote, or put in place of others."""

    def __init__(self, head: Head) -> None:
        self.head, self.version = head, head.version + 1
        self.name = f"{self.version:012d}-{uuid4().hex}"
        self.parts = {name: list(own) for name, own in head.parts.items()}


class TableSet:
    """Tables below ``root`` that change together."""

    def __init__(
        self, spark: SparkSession, root: str, tables: dict[str, Table], gather_every: int = GATHER_EVERY
    ) -> None:
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        self.gather_every = gather_every

    # --- versions -------------------------------------------------------------------

    def head(self) -> Head:
        """The newest manifest; the empty head where there is none."""
        versions = self._versions()
        return self._manifest(versions[-1]) if versions else Head()

    def begin(self, head: Head | None = None) -> Attempt:
        return Attempt(head or self.head())

    def commit(self, attempt: Attempt, source: str | None = None, batch_id: int = 0, **notes: dict) -> Head:
        """Make what an attempt wrote visible, with the batch it was and what there is to note."""
        old = attempt.head
        applied = old.applied | ({source: batch_id} if source is not None else {})
        new = Head(attempt.version, applied, attempt.parts, old.notes | notes)
        path = self._path(new.version)
        if not create(self.spark, path, json.dumps(asdict(new))):
            raise CommitConflict(path)
        stale = self._versions()[: -KEPT_MANIFESTS]
        for version, following in zip(stale, stale[1:], strict=False):
            for name, folder in self._manifest(version).folders() - self._manifest(following).folders():
                delete(self.spark, f"{self.root}/{name}/{folder}")
            delete(self.spark, self._path(version))
        return new

    def noted(self, kind: str, change: Callable[[dict], dict]) -> Head:
        """Commit a change of a note alone; another writer's commit in between is no obstacle."""
        while True:
            attempt = self.begin()
            try:
                return self.commit(attempt, **{kind: change(attempt.head.note(kind))})
            except CommitConflict:
                continue

    # --- writing --------------------------------------------------------------------

    def write(self, name: str, rows: DataFrame, attempt: Attempt) -> None:
        """Write a table's rows of the attempted version."""
        version = F.lit(attempt.version).cast("bigint").alias(VERSION)
        rows.select(*self.tables[name].schema.names, version).write.parquet(f"{self.root}/{name}/{attempt.name}")
        part = Part(attempt.name, attempt.version, attempt.version)
        attempt.parts[name] = [*attempt.parts.get(name, []), part]

    def write_all(self, rows: dict[str, DataFrame], attempt: Attempt) -> None:
        """Write several tables side by side: their jobs are small and independent."""
        self._side_by_side({name: (self.write, name, frame, attempt) for name, frame in rows.items()})

    def _side_by_side(self, calls: dict[str, tuple]) -> None:
        with ThreadPoolExecutor(max(1, len(calls))) as pool:
            own = inheritable_thread_target(self.spark)
            for done in [pool.submit(own(call), *args) for call, *args in calls.values()]:
                done.result()

    def gather(self, attempt: Attempt, **gone: str) -> None:
        """Put one folder in place of a table's many, where a table has many.

        ``gone`` says for a state table which rows end their key by now, besides its own.
        """
        many = {
            name: (self._gather, name, parts, attempt, gone.get(name, "false")) for name, parts in attempt.parts.items()
            if sum(p.buckets is None for p in parts) >= self.gather_every
        }
        self._side_by_side(many)

    def _gather(self, name: str, parts: list[Part], attempt: Attempt, gone: str) -> None:
        table, recent = self.tables[name], [p for p in parts if p.buckets is None]
        older, log = [p for p in parts if p.buckets is not None], self._rows(name, recent)
        touched = self._buckets(name, log) if table.lookup else [0]
        if table.keys:
            rows = self._state(name, older, recent, touched).filter(f"NOT ({table.gone}) AND NOT ({gone})")
            older = [Part(p.folder, p.first, p.last, sorted({*p.buckets} - {*touched})) for p in older]
        else:
            # as with a binary counter, a row is copied as often as its folder doubles
            while older and older[-1].last - older[-1].first <= recent[-1].last - recent[0].first:
                recent = [older.pop(), *recent]
            rows = self._rows(name, recent)
            touched = sorted({*touched}.union(*(p.buckets or () for p in recent)))
        kept = [p for p in older if p.buckets]
        attempt.parts[name] = [*kept, self._gathered(name, rows, recent, touched, attempt)]

    def rewrite(self, name: str, rows: DataFrame, upto: int, attempt: Attempt) -> bool:
        """Put rows, with their versions, in place of the folders that end with a version."""
        parts = attempt.parts.get(name, [])
        old = [p for p in parts if p.last <= upto]
        if len(old) > 1 or any(p.buckets is None for p in old):
            buckets = list(range(self.tables[name].buckets))
            attempt.parts[name] = [self._gathered(name, rows, old, buckets, attempt), *parts[len(old) :]]
        return len(old) > 0 and attempt.parts[name] != parts

    def _gathered(self, name: str, rows: DataFrame, of: list[Part], buckets: list[int], attempt: Attempt) -> Part:
        folder = f"{attempt.name}-gathered"
        # rebalancing splits the bucket of a frequent key over several tasks
        parted = rows.withColumn(BUCKET, self._bucket(name)).hint("rebalance", BUCKET)
        parted.write.partitionBy(BUCKET).parquet(f"{self.root}/{name}/{folder}")
        return Part(folder, of[0].first, of[-1].last, buckets)

    def _bucket(self, name: str, key: str | None = None) -> Column:
        table = self.tables[name]
        return bucket_of(F.col(key or table.lookup), table.buckets) if table.lookup else F.lit(0)

    def touched(self, name: str, keys: DataFrame, head: Head, key: str | None = None) -> list[int]:
        """The buckets that keys fall into, as many numbers as a table has at most.

        None where nothing is gathered yet.
        """
        if all(p.buckets is None for p in head.parts.get(name, [])):
            return []
        return self._buckets(name, keys, key)

    def _buckets(self, name: str, keys: DataFrame, key: str | None = None) -> list[int]:
        return sorted(r[0] for r in keys.select(self._bucket(name, key)).distinct().collect())

    # --- reading --------------------------------------------------------------------

    def versions(
        self, name: str, head: Head | None = None, after: int = 0, touched: list[int] | None = None,
        upto: int | None = None,
    ) -> DataFrame:
        """A table's rows after one version, or of folders that end with another at the latest.

        Each has its ``commit_version``.
        """
        parts = [p for p in (head or self.head()).parts.get(name, []) if p.last > after]
        parts = [p for p in parts if upto is None or p.last <= upto]
        rows = self._rows(name, parts, touched)
        return rows.filter(F.col(VERSION) > after) if after else rows

    def attempted(self, name: str, attempt: Attempt) -> DataFrame:
        """The rows an attempt wrote."""
        return self._rows(name, attempt.parts[name][-1:]).drop(VERSION)

    def appended(self, name: str, head: Head | None = None) -> DataFrame:
        """All rows of a table without keys."""
        return self.versions(name, head).drop(VERSION)

    def current(self, name: str, head: Head | None = None, touched: list[int] | None = None) -> DataFrame:
        """The state of a table, of the touched buckets' keys at least."""
        parts = (head or self.head()).parts.get(name, [])
        older, recent = [p for p in parts if p.buckets is not None], [p for p in parts if p.buckets is None]
        return self._state(name, older, recent, touched).filter(f"NOT ({self.tables[name].gone})").drop(VERSION)

    def _state(self, name: str, older: list[Part], recent: list[Part], touched: list[int] | None) -> DataFrame:
        """Per key the rows of its last version. Of the older rows each key has just those."""
        base, log, keys = self._rows(name, older, touched), self._rows(name, recent), self.tables[name].keys
        single = len({version for p in recent for version in (p.first, p.last)}) == 1
        if single and not older:
            return log
        newest = log.groupBy(*[F.col(k).alias(f"new_{k}") for k in keys]).agg(F.max(VERSION).alias(f"new_{VERSION}"))
        # a null equals a null, as part of a key may be one
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"new_{k}")) for k in keys])
        fresh = log if single else log.join(newest, same & (F.col(VERSION) == F.col(f"new_{VERSION}")), "left_semi")
        return base.join(newest, same, "left_anti").unionByName(fresh)

    def _rows(self, name: str, parts: list[Part], touched: list[int] | None = None) -> DataFrame:
        """Rows of folders read by their exact paths, of gathered ones from buckets that count."""
        # files do not record that a column is never null
        fields = [T.StructField(f.name, f.dataType) for f in self.tables[name].schema.fields]
        fields.append(T.StructField(VERSION, T.LongType()))
        reader = self.spark.read.schema(T.StructType(fields))
        plain = [f"{self.root}/{name}/{p.folder}" for p in parts if p.buckets is None]
        frames = [reader.parquet(*plain)] if plain else []
        for part in parts:
            if part.buckets is not None:
                counting = part.buckets if touched is None else sorted({*part.buckets} & {*touched})
                bucketed = self.spark.read.schema(T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())]))
                rows = bucketed.parquet(f"{self.root}/{name}/{part.folder}").filter(F.col(BUCKET).isin(counting))
                frames.append(rows.drop(BUCKET))
        if not frames:  # an empty range rather than an empty list: the optimizer knows its size
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
        return reduce(DataFrame.unionByName, frames)

    # --- manifests ------------------------------------------------------------------

    def _path(self, version: int) -> str:
        return f"{self.root}/_commits/{version:012d}.json"

    def _manifest(self, version: int) -> Head:
        return Head.of(read(self.spark, self._path(version)))

    def _versions(self) -> list[int]:
        found = names(self.spark, f"{self.root}/_commits")
        return sorted(int(n.removesuffix(".json")) for n in found if n[0].isdigit())

"""Repeated passages by seed and extension.

A passage of WINDOW words holds ``WINDOW - SEED + 1`` seeds of SEED words; the one of least
hash is its anchor, so equal passages have equal anchors at equal places. Occurrences of
anchors that stand alone are dropped at once. The others are extended both ways, as far as
a window around the anchor can reach:

* Where the whole surroundings of two occurrences agree, all windows around the anchor
  are repeated, and nothing else has to be looked at.
* Where an anchor has several surroundings, a match ends somewhere within reach. One
  occurrence of each is joined with its text, and the windows that the anchor stands for
  are compared one by one.

Overlapping repeated windows make up the maximal repeats. Occurrences are compared by
hashes (128 bits of them for whole surroundings, as for windows) that are counted before
they are joined back, so no two occurrences are ever paired and a passage shared by any
number of documents costs one row for each.

Words are what stands between ASCII white space. Null texts have no words. Rows equal in
id and text are copies of each other and repeat all of their windows. Null ids are an id
like any other here. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.encoding import Values
from changeflow.llm.tables import cut, rekeyed

WINDOW = 35
SEED = 8

# Odd multipliers of the two rolling hashes, and their inverses modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread so that any part of the hash is as good as another."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


class Gathered:
    """Rows of many texts, sent on some ten thousand at a time."""

    ROWS = 1 << 16

    def __init__(self, names: list[str]) -> None:
        self._names, self._parts, self._rows = names, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self._parts.append(columns)
        self._rows += len(columns[0])
        if self._rows >= self.ROWS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._rows:
            columns = [pa.array(np.concatenate(c)) for c in zip(*self._parts, strict=True)]
            self._parts, self._rows = [], 0
            yield pa.RecordBatch.from_arrays(columns, self._names)


class _Powers:
    """Powers of the bases and of their inverses, as many as the longest text needs."""

    def __init__(self) -> None:
        self._held = np.ones((4, 1), np.uint64)

    def first(self, count: int) -> np.ndarray:
        if self._held.shape[1] < count:
            size = max(count, 2 * self._held.shape[1])
            self._held = np.ones((4, size), np.uint64)
            for row, base in enumerate(_BASES + _INVERSES):
                self._held[row, 1:] = base
                np.multiply.accumulate(self._held[row], out=self._held[row])
        return self._held


class Words:
    """A text's words, and hashes of them."""

    def __init__(self) -> None:
        self._powers = _Powers()
        self._hashes = Values(xxhash.xxh3_64_intdigest, np.uint64)

    def split(self, text: str | None) -> list[bytes]:
        return (text or "").encode().split()  # bytes split at ASCII white space alone

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return self._hashes.of(words)

    def rolling(self, hashes: np.ndarray) -> Rolling:
        return Rolling(hashes, self._powers.first(len(hashes) + 1))


class Rolling:
    """Hashes of any runs of words, from running sums."""

    def __init__(self, hashes: np.ndarray, powers: np.ndarray) -> None:
        self._powers, self._sums = powers, []
        for which in (0, 1):
            own = hashes if which == 0 else _mixed(hashes + np.uint64(1))
            sums = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(own * powers[which, : len(hashes)], out=sums[1:])
            self._sums.append(sums)

    def runs(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self._sums[which]
        return _mixed((sums[end] - sums[start]) * self._powers[2 + which, start])

    def windows(self, which: int, size: int) -> np.ndarray:
        sums = self._sums[which]
        count = len(sums) - size
        return _mixed((sums[size:] - sums[:count]) * self._powers[2 + which, :count])


def _sliding(values: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """The least or greatest of each run of ``size`` values, by doubling."""
    out, held = values, 1
    while 2 * held <= size:
        out = best(out[:-held], out[held:])
        held *= 2
    rest = size - held
    return best(out[:-rest], out[rest:]) if rest else out


class Anchors:
    """The seeds that are least in some window, of one text of at least a window."""

    def __init__(self, rolling: Rolling, window: int, seed: int) -> None:
        reach = window - seed
        self.seeds = rolling.windows(0, seed)
        self.least = _sliding(self.seeds, reach + 1, np.minimum)
        pad = np.zeros(reach, np.uint64)
        around = _sliding(np.concatenate([pad, self.least, pad]), reach + 1, np.maximum)
        self.at = np.flatnonzero(around == self.seeds)


def anchors(documents: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Every anchor: its row, place and hash, and the hash of its surroundings."""
    reach = window - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, out = Words(), Gathered(["row", "at", "anchor", "around"])
        for batch in batches:
            for row, text in zip(batch.column(0), batch.column(1), strict=True):
                words = source.split(text.as_py())
                n = len(words)
                if n < window:
                    continue
                rolling = source.rolling(source.hashes(words))
                found = Anchors(rolling, window, seed)
                at = found.at
                start, end = np.maximum(at - reach, 0), np.minimum(at + seed + reach, n)
                # what is cut off at the ends of the text belongs to the surroundings
                left = (at - start).astype(np.uint64) << np.uint64(32)
                size = left + (end - start).astype(np.uint64)
                around = _mixed(rolling.runs(1, start, end) + _mixed(size))
                yield from out.add(
                    np.full(len(at), row.as_py(), np.int64),
                    at.astype(np.int32),
                    found.seeds[at].view(np.int64),
                    around.view(np.int64),
                )
        yield from out.rest()

    return documents.select("_row", "text").mapInArrow(
        run, "row long, at int, anchor long, around long"
    )


def _windows_of(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """Windows that anchors with several surroundings stand for.

    ``start`` is -1 for windows that are known to be repeated and only wanted as partners.
    """
    reach = window - seed
    row_at, text_at, found_at = map(texts.columns.index, ("_row", "text", "_found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, out = Words(), Gathered(["row", "start", "one", "two"])
        for batch in batches:
            for i in range(batch.num_rows):
                row, text = batch.column(row_at)[i], batch.column(text_at)[i].as_py()
                places = batch.column(found_at)[i].values
                rolling = source.rolling(source.hashes(source.split(text)))
                found = Anchors(rolling, window, seed)
                at = places.field("at").to_numpy().astype(np.int64)
                known = places.field("known").to_numpy(zero_copy_only=False)
                starts = at[:, None] + np.arange(-reach, 1)
                inside = (starts >= 0) & (starts < len(found.least))
                starts = np.where(inside, starts, 0)
                inside &= found.least[starts] == found.seeds[at][:, None]
                repeated = np.zeros(len(found.least), bool)
                repeated[starts[inside & known[:, None]]] = True
                start = np.unique(starts[inside])
                yield from out.add(
                    np.full(len(start), row.as_py(), np.int64),
                    np.where(repeated[start], -1, start).astype(np.int32),
                    *(rolling.runs(i, start, start + window).view(np.int64) for i in (0, 1)),
                )
        yield from out.rest()

    return texts.mapInArrow(run, "row long, start int, one long, two long")


def repeats(documents: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """What of each row is repeated: ``_row`` and ``_spans``, starts and ends in turn.

    ``documents`` has ``_row``, a number that rows share only if they are alike, and
    ``text``. Its other columns are only there so that this shuffle of the texts is also
    the caller's.
    """
    reach = window - seed
    found = anchors(documents, window, seed)
    shared = (
        found.groupBy("anchor")
        .agg(F.count("*").alias("_n"), F.min("around").alias("_lo"), F.max("around").alias("_hi"))
        .where(F.col("_n") > 1)
        .select("anchor", (F.col("_lo") != F.col("_hi")).alias("several"))
    )
    held = cut(
        found.join(rekeyed(shared, "anchor"), "anchor").select(
            "row", "at", "around", F.xxhash64("anchor", "around").alias("both"), "several"
        )
    )
    surroundings = held.groupBy("around", "both").agg(
        F.count("*").alias("_n"),
        F.max("several").alias("_several"),
        F.min(F.struct("row", "at")).alias("_first"),
    )
    frequent = surroundings.where(F.col("_n") > 1).select("around", "both")
    whole = held.join(rekeyed(frequent, "around", "both"), ["around", "both"])
    # one occurrence of each surroundings that is not the only one of its anchor
    by_row = (
        surroundings.where("_several")
        .groupBy(F.col("_first.row").alias("_owner"))
        .agg(F.collect_list(F.struct("_first.at", (F.col("_n") > 1).alias("known"))).alias("_found"))
    )
    texts = documents.join(by_row, F.col("_row") == F.col("_owner"))
    windows = _windows_of(texts, window, seed)
    twice = windows.groupBy("one", "two").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    matched = windows.where(F.col("start") >= 0).join(
        rekeyed(twice, "one", "two"), ["one", "two"]
    )
    starts = F.greatest(F.col("at") - reach, F.lit(0))
    spans = whole.select("row", F.struct(starts.alias("start"), (F.col("at") + window).alias("end")).alias("span"))
    spans = spans.unionByName(
        matched.select(
            "row", F.struct(F.col("start"), (F.col("start") + window).alias("end")).alias("span")
        )
    )
    return spans.groupBy(F.col("row").alias("_row")).agg(F.collect_set("span").alias("_spans"))


def without_repeats(
    documents: DataFrame, window: int = WINDOW, seed: int = SEED
) -> DataFrame:
    """Documents with ``n_words``, ``n_removed``, and the words that are left (``kept``)."""
    columns = documents.columns
    rows = documents.withColumn("_row", F.xxhash64("doc_id", "text"))
    marked = rows.join(repeats(rows, window, seed), "_row", "left")
    marked = marked.select(*(f"`{c}`" for c in columns), "_spans")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for batch in batches:
            total, removed, kept = [], [], []
            for text, spans in zip(batch.column(at), batch.column(len(columns)), strict=True):
                words = (text.as_py() or "").encode().split()
                total.append(len(words))
                edges = np.zeros(len(words) + 1, np.int64)
                for span in spans.as_py() or ():
                    edges[span["start"]] += 1
                    edges[min(span["end"], len(words))] -= 1
                stays = np.cumsum(edges)[:-1] == 0
                removed.append(len(words) - int(stays.sum()))
                if removed[-1]:
                    words = [w for w, s in zip(words, stays, strict=True) if s]
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                [*columns, "_n_words", "_n_removed", "_kept"],
            )

    added = "_n_words long, _n_removed long, _kept string"
    return marked.mapInArrow(run, f"{fields}, {added}")

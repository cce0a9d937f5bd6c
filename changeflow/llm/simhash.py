"""Near-duplicate texts by SimHash, with candidates from the pigeonring.

*Fingerprints.* ASCII letters are lower-cased, words are what stands between ASCII white
space, and every run of SHINGLE words (repeats included, one space apart) has a 64-bit
hash. A bit of the fingerprint is set if it is in more than half of the hashes. Texts of
fewer words are one run; texts without words have the fingerprint zero.

*Pigeonring.* To find fingerprints that differ in t bits at most, their 64 bits are cut
into t + 1 segments, set in a ring. If the differences are t at most, then from some
segment on every chain of l consecutive segments differs in at most l t / (t + 1) bits: in
none for the first segment, in one at most for the first two, and so on. (Cut the running
excess over the proportional budget where it is greatest.) So fingerprints meet by the
first two segments of a chain: each is an index row under its own two segments, and a
probe row under those with one more bit set in the second. Of two that differ in one bit
there, one lacks that bit and finds the other. A pair has to agree on about 43 of 64 bits
to meet, whatever its segment. Those that meet are held against the budgets of the longer
chains, the last of which is the whole Hamming distance.

*Dense keys.* The index rows of a key differ in the remaining bits only, so there are at
most 2^22 for distance 2. Where they are many, a row looks up the few values within its
budget instead of being compared with all. Nothing leaves a key but one edge from each
linked fingerprint to the least it is connected with there: never pairs of all.

*Classes.* Equal fingerprints are one node. A class is named by the least id in it.

A null text is an empty one: it has the fingerprint zero and links like any other. Ids may
repeat or be null; the least id leaves nulls out, and is null where a class has no other.
Long texts are hashed in blocks. An empty table gives an empty result. Other columns of the
documents are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.near import components
from changeflow.llm.tables import cut, importable, rekeyed, shuffle_width

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 2
#: Hashes whose bits are counted at a time.
HASHES = 1 << 15
#: Pairs compared at a time, and index rows from which values are looked up instead.
TILE = 1 << 20
DENSE = 1 << 11

MARKED = "doc_id long, fingerprint long"
KEYED = "part int, key long, probe boolean, fingerprint long"
EDGES = "a long, b long"


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a text in UTF-8, unsigned."""
    words = text.lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    count = len(words) - size + 1
    digest, set_in = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, count, HASHES):
        last = min(at + HASHES, count)
        starts = [ends[i - 1] if i else 0 for i in range(at, last)]
        runs = zip(starts, ends[at + size - 1 : last + size - 1], strict=True)
        hashes = np.array([digest(joined[a : b - 1], seed) for a, b in runs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little")
        set_in += bits.reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_in > count, bitorder="little").view("<u8")[0])


def with_fingerprints(documents: DataFrame) -> DataFrame:
    """Every document's fingerprint, as a signed number: doc_id, fingerprint."""
    importable(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [fingerprint(t.as_py() or b"") for t in texts]
            values = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values)], ["doc_id", "fingerprint"]
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, MARKED)


class Ring:
    """The segments for a distance, set in a ring."""

    def __init__(self, distance: int) -> None:
        self.distance, self.parts = distance, distance + 1
        ends = np.linspace(0, BITS, self.parts + 1).astype(int)
        self.places = [range(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.masks = [np.uint64(sum(1 << b for b in places)) for places in self.places]

    def chain(self, part: int, length: int) -> np.uint64:
        """The bits of so many consecutive segments."""
        out = np.uint64(0)
        for i in range(length):
            out |= self.masks[(part + i) % self.parts]
        return out

    def viable(self, part: int, differences: np.ndarray) -> np.ndarray:
        """Which differences keep to the budget of every chain from this segment on.

        The last chain is the whole ring, its budget the distance.
        """
        keep = np.ones(differences.shape, bool)
        for length in range(1, self.parts + 1):
            budget = length * self.distance // self.parts
            keep &= np.bitwise_count(differences & self.chain(part, length)) <= budget
        return keep

    def keys(self, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, bool, np.ndarray]]:
        """Per segment: the key of every value as index row, then its keys as probe rows."""
        for part in range(self.parts):
            own = values & self.chain(part, 2)
            yield part, own, False, values
            for place in self.places[(part + 1) % self.parts]:
                bit = np.uint64(1 << place)
                lacking = (values & bit) == 0
                yield part, own[lacking] | bit, True, values[lacking]

    def beside(self, part: int, most: int) -> np.ndarray:
        """All differences of at most so many bits outside the chain of two."""
        rest = [b for b in range(BITS) if not int(self.chain(part, 2)) >> b & 1]
        return np.array(
            [sum(1 << b for b in some) for n in range(most + 1) for some in combinations(rest, n)],
            np.uint64,
        )


def joined(labels: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Labels, each that of a lesser or the same node, once these nodes are connected."""
    while True:
        a, b = labels[one], labels[other]
        apart = a != b
        if not apart.any():
            return labels
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def linked(ring: Ring, part: int, index: np.ndarray, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of one key: linked fingerprints, and the least each is connected with here.

    ``index`` holds distinct fingerprints under their own key, ``probes`` those that meet
    them with one bit changed.
    """
    index = np.sort(index)
    nodes = np.concatenate([index, probes])
    labels = np.arange(len(nodes))
    for offset, rows, most in ((0, index, ring.distance), (len(index), probes, ring.distance - 1)):
        masks = None
        if len(index) > DENSE and most <= 2:
            masks = ring.beside(part, most)
        step = max(1, TILE // (len(index) if masks is None else len(masks)))
        # a probe differs from its key in the bit by which it was sent there
        keyed = rows if offset == 0 else (rows & ~ring.chain(part, 2)) | (index[0] & ring.chain(part, 2))
        for at in range(0, len(rows), step):
            if masks is None:
                near = ring.viable(part, rows[at : at + step, None] ^ index)
                one, other = np.nonzero(near)
            else:
                wanted = keyed[at : at + step, None] ^ masks
                place = np.minimum(np.searchsorted(index, wanted), len(index) - 1)
                one, column = np.nonzero(index[place] == wanted)
                other = place[one, column]
            labels = joined(labels, one + at + offset, other)
    further = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[further], nodes[labels[further]]


def links(fingerprints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) that connect what a chain of links within the distance connects.

    ``fingerprints`` has one column of distinct signed numbers.
    """
    spark = fingerprints.sparkSession
    importable(spark)
    if distance < 1:
        return spark.createDataFrame([], EDGES)
    ring = Ring(distance)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for part, key, probe, own in ring.keys(values):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(key), part, np.int32)),
                        pa.array(key.view(np.int64)),
                        pa.array(np.full(len(key), probe)),
                        pa.array(own.view(np.int64)),
                    ],
                    ["part", "key", "probe", "fingerprint"],
                )

    def met(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        part, key = rows["part"].to_numpy(), rows["key"].to_numpy()
        probe, values = rows["probe"].to_numpy(), rows["fingerprint"].to_numpy().view(np.uint64)
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])))
        size = np.diff(np.append(first, len(key)))
        # index rows come first in a key; without any, or all alone, nothing meets
        meeting = np.flatnonzero((size > 1) & ~probe[first])
        found = [
            linked(ring, int(part[a]), values[a : a + n][~probe[a : a + n]], values[a : a + n][probe[a : a + n]])
            for a, n in zip(first[meeting].tolist(), size[meeting].tolist(), strict=True)
        ]
        if found:
            one, other = (np.concatenate(side).view(np.int64) for side in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(other)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, part = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            changes = np.flatnonzero((key != key[-1]) | (part != part[-1]))
            last = int(changes[-1]) + 1 if len(changes) else 0
            same = held and held[-1].column(1)[-1] == batch.column(1)[0] and held[-1].column(0)[-1] == batch.column(0)[0]
            if held and (last or not same):
                yield from met(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            elif last:
                yield from met(pa.Table.from_batches([batch.slice(0, last)]))
            held.append(batch.slice(last))
        if held:
            yield from met(pa.Table.from_batches(held))

    return (
        fingerprints.mapInArrow(deal, KEYED)
        .repartition(shuffle_width(spark), "part", "key")
        .sortWithinPartitions("part", "key", "probe")
        .mapInArrow(run, EDGES)
    )


def classes(documents: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Every document's fingerprint (signed) and the least id it is connected with.

    Returns doc_id, fingerprint, component_id.
    """
    marked = cut(with_fingerprints(documents))
    distinct = cut(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("_least")))
    labels = components(links(distinct.select("fingerprint"), distance))
    named = distinct.join(labels, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "_least", F.coalesce("label", "fingerprint").alias("_component")
    )
    least = named.groupBy("_component").agg(F.min("_least").alias("component_id"))
    of_each = named.join(rekeyed(least, "_component"), "_component")
    return marked.join(rekeyed(of_each.select("fingerprint", "component_id"), "fingerprint"), "fingerprint")

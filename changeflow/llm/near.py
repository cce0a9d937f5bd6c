"""Near-duplicate texts by Order MinHash and banded alignment.

*Sketch.* Every run of a few words is labelled with how often it occurred before in the
text. A sketch takes the two labelled runs of least hash and keeps them in the order of
the text, so texts agree on a sketch if they share the runs and their order: a measure of
edit similarity, not of shared content alone. Each text has SKETCHES of them. Runs are so
short that texts at SIMILARITY still share many: an edit destroys as many runs as a run has
words. RUNS gives their length by the length of the text; where two lengths overlap a text
has the sketches of both, so texts within SIMILARITY always have one length in common.
Texts of at most SHORT words differ in one word at most; they agree on the words that are
left without it, which finds every such pair.

*Candidates.* Texts that agree on a sketch form a bucket. Each is first compared with the
bucket's least and greatest text, in two rounds: beside the least and the greatest of all
its buckets, then beside those other ends with which it shares no linked text yet. Members
of a bucket that are not connected by then meet in tasks, with their texts, and are compared
with one another there: all with all, less the pairs that are connected meanwhile, those
whose folded word counts alone prove them too far apart, and those that meet in a lesser
bucket too. Crowded buckets are cut into blocks that meet in tasks of their own. Only links
that join two components leave a task, so there are fewer of them than members.

*Verification.* Texts are aligned along the runs they share; where that does not settle a
pair, the edit distance of the words is found within the band that SIMILARITY allows: row by
row for texts of up to BANDED words, many partners of a text at a time, and diagonal by
diagonal for longer ones. Pairs within it are links.

*Classes.* Links connect texts; the least label of a component spreads along links and by
pointer jumping, every round written to the checkpoint folder. Rows of equal text share
one node, so copies never multiply.

Null texts and texts without words are classes of their own. A class is named by its least doc_id, nulls aside. Repeated rows are
copies. An empty table gives an empty result. Texts are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.encoding import Values
from changeflow.llm.tables import Written, cut, importable, rekeyed, shuffle_width

SKETCHES = 64
SIMILARITY = 0.8
#: Words of a run, and the shortest and longest texts that have sketches of such runs. At
#: SIMILARITY, a text one word longer than the longest has partners of the next kind only.
RUNS = ((2, 8, 40), (3, 33, None))
#: The longest texts that differ in one word at most, at SIMILARITY.
SHORT = 9
#: Words of the runs that alignments follow.
SHINGLE = 5
#: Words compared at a time along the diagonals of an alignment.
STRIDE = 16
#: Words of the longest texts that are aligned row by row, rows between two looks at which
#: pairs are lost, and cells of such rows held at a time.
BANDED = 1024
LOOK = 16
CELLS = 1 << 18
#: Hashes ranked at a time.
RANKS = 1 << 17
#: Counters that the words of a text are folded into, and marks of its labelled words.
FOLDED = 256
MARKS = 512
#: Members of a bucket that meet in one task, and pairs of them compared at a time.
BLOCK = 1024
TILE = 1 << 14
#: Parts of the buckets that are looked through one after another, which bounds the disk.
SLICES = 2
#: Wanted keys that share a word of marks.
KEYS_A_WORD = 8
#: Bytes of text of the members that meet, about, from either side.
BLOCK_BYTES = 8 << 20


def text_node(text: str = "text") -> Column:
    """The number of a text; null for texts without words."""
    return F.when(F.col(text).rlike(r"\S"), F.xxhash64(text))


class WordHashes:
    """Hashes of a text's words."""

    def __init__(self) -> None:
        self._hashes = Values(lambda word: xxhash.xxh3_64_intdigest(word.encode()), np.uint64)

    def of(self, text: str) -> np.ndarray:
        return self._hashes.of(text.split())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def labelled_runs(words: np.ndarray, shingle: int) -> np.ndarray:
    """Hashes of all runs of words, each with the number of its earlier occurrences."""
    size = min(shingle, len(words))
    count = len(words) - size + 1
    runs = np.zeros(count, np.uint64)
    for i in range(size):
        runs = _mixed(runs + words[i : i + count])
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if first.all():
        return _mixed(runs)
    starts = np.flatnonzero(first)
    earlier = np.arange(count) - np.repeat(starts, np.diff(np.append(starts, count)))
    label = np.zeros(count, np.uint64)
    label[order] = earlier
    return _mixed(runs + label * np.uint64(0x9E3779B97F4A7C15))


def sketch(runs: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each seed, the two runs of least hash combined in the order of the text."""
    if len(runs) == 1:
        return _mixed(runs[0] ^ seeds)
    out, block = [], max(1, RANKS // len(runs))
    room = np.empty((min(block, len(seeds)), len(runs)), np.uint64)
    for at in range(0, len(seeds), block):
        own = seeds[at : at + block]
        # a multiplication by an odd number permutes the hashes; high bits decide
        ranks = np.bitwise_xor(runs, own[:, None], out=room[: len(own)])
        ranks *= np.uint64(0x9E3779B97F4A7C15)
        row = np.arange(len(own))
        one = ranks.argmin(1)
        ranks[row, one] = np.iinfo(np.uint64).max
        two = ranks.argmin(1)
        first, second = runs[np.minimum(one, two)], runs[np.maximum(one, two)]
        out.append(_mixed((first * np.uint64(3) + _mixed(second)) ^ own))
    return np.concatenate(out)


def sketch_seeds(count: int, words: int = 0) -> np.ndarray:
    """Seeds of the sketches of runs of so many words."""
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(words << 32))


def less_a_word(words: np.ndarray) -> np.ndarray:
    """Hashes of a short text's words, and of those left without any one of them.

    Of texts of up to four words, all stay: none has a partner with fewer.
    """
    places = np.arange(1, len(words) + 1, dtype=np.uint64)
    out = [_mixed(_mixed(words + places).sum(keepdims=True))]
    if len(words) > 4:
        for at in range(len(words)):
            left = np.delete(words, at)
            out.append(_mixed(_mixed(left + places[:-1]).sum(keepdims=True)))
    return np.unique(np.concatenate(out))


def text_buckets(words: np.ndarray, seeds: dict[int, np.ndarray]) -> np.ndarray:
    """The buckets of a text of at least one word."""
    out = []
    if len(words) <= SHORT:
        out.append(less_a_word(words))
    for size, least, most in RUNS:
        if least <= len(words) <= (most or len(words)):
            out.append(sketch(labelled_runs(words, size), seeds[size]))
    return np.concatenate(out)


def buckets(documents: DataFrame, sketches: int = SKETCHES) -> DataFrame:
    """The buckets of every text: (bucket, node). ``documents`` has ``_node`` and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, seeds = WordHashes(), {size: sketch_seeds(sketches, size) for size, *_ in RUNS}
        for batch in batches:
            found, nodes = [], []
            for node, text in zip(batch.column(0), batch.column(1), strict=True):
                words = source.of(text.as_py())
                if len(words):
                    found.append(text_buckets(words, seeds))
                    nodes.append(node.as_py())
            keys = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
            owner = np.repeat(np.array(nodes, np.int64), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owner)], ["bucket", "node"])

    rows = documents.where(F.col("_node").isNotNull()).select("_node", "text")
    return rows.mapInArrow(run, "bucket long, node long")


def in_shared_buckets(found: DataFrame, slices: int = 1) -> list[DataFrame]:
    """The buckets of more than one text: each text beside the bucket's ends, lo and hi.

    (bucket, node, lo, hi), the buckets dealt into slices
    """
    part = F.pmod(F.col("bucket"), F.lit(slices))
    return [_in_shared_buckets(found.where(part == i)) for i in range(slices)]


def _in_shared_buckets(found: DataFrame) -> DataFrame:
    ends = (
        found.groupBy("bucket")
        .agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
        .where(F.col("lo") < F.col("hi"))
    )
    return found.join(rekeyed(ends, "bucket"), "bucket").select("bucket", "node", "lo", "hi")


def pairs_of(beside: DataFrame) -> DataFrame:
    """Each text with either end: distinct pairs (a, b), a below b."""
    either = F.array(
        F.struct(F.col("lo").alias("a"), F.col("node").alias("b")),
        F.struct(F.col("node").alias("a"), F.col("hi").alias("b")),
    )
    pairs = beside.select(F.explode(either).alias("_pair")).select("_pair.*")
    return pairs.where(F.col("a") < F.col("b")).distinct()


def edits_within(one: np.ndarray, other: np.ndarray, most: int) -> int | None:
    """The edit distance of two word sequences, or None if it exceeds ``most``.

    Diagonals are followed as far as they go with 0, 1, 2, ... edits.
    """
    n, m = len(one), len(other)
    if abs(n - m) > most:
        return None
    shared = _shared(one, other)
    if max(n, m) - shared > most:
        return None
    a = np.concatenate([one, np.full(STRIDE + 1, 1, np.uint64)])
    b = np.concatenate([other, np.full(2 * most + STRIDE + 2, 2, np.uint64)])
    steps = np.arange(STRIDE)
    target = m - n

    def slide(reached: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Go along each diagonal while the words are equal."""
        going = np.flatnonzero((reached < n) & (reached + diagonal < m) & (reached + diagonal >= 0))
        while len(going):
            i = reached[going, None] + steps
            j = i + diagonal[going, None]
            same = (a[np.minimum(i, n)] == b[np.minimum(j, len(b) - 1)]) & (i < n) & (j < m)
            run = np.where(same.all(1), STRIDE, same.argmin(1))
            reached[going] += run
            going = going[run == STRIDE]
        return reached

    low = -(1 << 40)
    reached = slide(np.zeros(1, np.int64), np.zeros(1, np.int64))
    if target == 0 and reached[0] == n:
        return 0
    for e in range(1, most + 1):
        diagonal = np.arange(-e, e + 1)
        before = np.concatenate([[low, low], reached, [low, low]])
        # from the diagonal itself, from the one below (a word more in the other text) and
        # from the one above (a word less)
        reached = np.maximum(np.maximum(before[1:-1] + 1, before[:-2]), before[2:] + 1)
        reached = np.minimum(reached, np.minimum(n, m - diagonal))
        reached = slide(reached, diagonal)
        if abs(target) <= e and reached[target + e] >= n:
            return e
    return None


def within_band(one: np.ndarray, others: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Which of the other texts are at most so many edits away, each by its own number.

    The table of distances has a row for every word of ``one`` and a column for every shift
    within the greatest band; all partners go through the rows together. A row takes the
    least of a word kept or replaced, a word dropped and, by a running minimum along the
    row, words added. Row minima never fall, so pairs above their number are given up.
    """
    n, width = len(one), int(most.max())
    lengths = np.array([len(o) for o in others])
    near = np.zeros(len(others), bool)
    alive = np.flatnonzero(np.abs(lengths - n) <= most)
    shift = np.arange(-width, width + 1, dtype=np.int32)
    padded = np.zeros((len(alive), 2 * width + max(n, int(lengths.max(initial=0))) + 1), np.int64)
    for row, at in enumerate(alive):
        padded[row, width : width + lengths[at]] = others[at]
    far = np.int32(1 << 20)
    reached = np.broadcast_to(np.where(shift < 0, far, shift), (len(alive), len(shift))).copy()
    dropped = np.empty_like(reached)
    for row, word in enumerate(one.tolist()):
        dropped[:, :-1] = reached[:, 1:]
        dropped[:, -1] = far
        dropped += 1
        reached += padded[:, row : row + len(shift)] != word
        np.minimum(reached, dropped, out=reached)
        reached -= shift
        np.minimum.accumulate(reached, axis=1, out=reached)
        reached += shift
        if row % LOOK == LOOK - 1:
            kept = reached.min(1) <= most[alive]
            if not kept.any():
                return near
            if 2 * kept.sum() <= len(kept):
                alive, padded, reached = alive[kept], padded[kept], reached[kept]
                dropped = np.empty_like(reached)
    last = reached[np.arange(len(alive)), lengths[alive] - n + width]
    near[alive] = last <= most[alive]
    return near


def _shared(one: np.ndarray, other: np.ndarray) -> int:
    """Words that two texts have in common, counted as often as in both."""
    values, inverse = np.unique(np.concatenate([one, other]), return_inverse=True)
    first = np.bincount(inverse[: len(one)], minlength=len(values))
    second = np.bincount(inverse[len(one) :], minlength=len(values))
    return int(np.minimum(first, second).sum())


def edits_at_most(one: np.ndarray, other: np.ndarray, runs: tuple, shingle: int) -> int:
    """The edits of an alignment along runs that both texts have, in the same order.

    Runs are matched by their labelled hashes. Between two of them words are taken as
    replaced, less those that belong to the first run. It is an upper bound, and exact where
    edits stand apart.
    """
    n, m = len(one), len(other)
    _, i, j = np.intersect1d(*runs, assume_unique=True, return_indices=True)
    order = np.argsort(i)
    i, j = i[order], j[order]
    if len(j):
        rising = j > np.concatenate([[-1], np.maximum.accumulate(j)[:-1]])
        i, j = i[rising], j[rising]
    size = min(shingle, n, m)
    if not len(i):
        return max(n, m)
    di, dj = np.diff(i), np.diff(j)
    kept = np.minimum(np.minimum(di, dj), size)
    between = np.where((di == dj) & (di <= size), 0, np.maximum(di, dj) - kept)
    ends = max(int(i[0]), int(j[0])) + max(n - int(i[-1]), m - int(j[-1])) - size
    return int(between.sum()) + ends


def unconnected(beside: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that were not compared with all others: (bucket, node, label, size).

    The ends of a bucket were. Buckets whose other members are all connected are left out,
    and of buckets with the same members one is kept.
    """
    between = beside.where((F.col("lo") < F.col("node")) & (F.col("node") < F.col("hi")))
    known = rekeyed(labels.toDF("node", "_label"), "node")
    members = between.join(known, "node", "left").select(
        "bucket", "node", F.coalesce("_label", "node").alias("label")
    )
    kept = (
        members.groupBy("bucket")
        .agg(
            F.min("label").alias("_least"),
            F.max("label").alias("_most"),
            F.count("*").alias("size"),
            F.bit_xor(F.xxhash64("node")).alias("_set"),
        )
        .where(F.col("_least") < F.col("_most"))
        .groupBy("size", "_set")
        .agg(F.min("bucket").alias("bucket"))
    )
    return members.join(rekeyed(kept.select("bucket", "size"), "bucket"), "bucket")


def marks_of(words: np.ndarray) -> np.ndarray:
    """Marks of a text's words, each labelled with its earlier occurrences.

    A mark that only one of two texts has stands for a word that only this one has.
    """
    marks = np.zeros(MARKS, np.float32)
    marks[(labelled_runs(words, 1) % np.uint64(MARKS)).astype(np.int64)] = 1
    return marks


def sized_alike(sizes: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """For all pairs of two sides whether lengths allow them: [left, right]."""
    one, other = sizes[left][:, None], sizes[right][None, :]
    return np.abs(one - other) <= ((1 - similarity) * np.maximum(one, other) + 1e-9).astype(np.int32)


def marked_alike(sizes: np.ndarray, marks: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: float):
    """For all pairs of two sides whether lengths and marks allow them: [left, right]."""
    one, other = marks[left], marks[right]
    longer = np.maximum(sizes[left][:, None], sizes[right][None, :])
    most = ((1 - similarity) * longer + 1e-9).astype(np.int32)
    both = one @ other.T
    missing = np.maximum(one.sum(1)[:, None], other.sum(1)[None, :]) - both
    return (np.abs(sizes[left][:, None] - sizes[right][None, :]) <= most) & (missing <= most)


def near_enough(
    words: np.ndarray, counts: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: float
) -> np.ndarray:
    """Which pairs of rows the counts allow: an edit takes away or brings one word each."""
    most = ((1 - similarity) * np.maximum(words[left], words[right]) + 1e-9).astype(np.int64)
    kept = np.flatnonzero(np.abs(words[left] - words[right]) <= most)
    one, other = counts[left[kept]], counts[right[kept]]
    alike = np.minimum(one, other)
    gone = (one - alike).sum(1, dtype=np.int64)
    come = (other - alike).sum(1, dtype=np.int64)
    return kept[np.maximum(gone, come) <= most[kept]]


class Members:
    """The members of a group: their words, runs, counts, buckets and components."""

    def __init__(self, rows: pa.Table, source: WordHashes) -> None:
        self.node = rows["node"].to_numpy()
        self.side = rows["side"].to_numpy()
        self.bucket = rows["bucket"][0].as_py()
        self.words = [source.of(t.as_py()) for t in rows["text"]]
        self.sizes = np.array([len(w) for w in self.words], np.int32)
        self.buckets = [frozenset(b.as_py()) for b in rows["buckets"]]
        self.runs: dict[int, np.ndarray] = {}
        _, first, inverse = np.unique(rows["label"].to_numpy(), return_index=True, return_inverse=True)
        self.parent = first[inverse].tolist()

    # in most groups no pair comes so far that these are needed

    @cached_property
    def marks(self) -> np.ndarray:
        return np.array([marks_of(w) for w in self.words])

    @cached_property
    def counts(self) -> np.ndarray:
        counts = [np.bincount((w % np.uint64(FOLDED)).astype(np.int64), minlength=FOLDED) for w in self.words]
        return np.minimum(np.array(counts), 255).astype(np.uint8)

    @cached_property
    def numbered(self) -> list[np.ndarray]:
        """Words numbered from 1 within the group."""
        _, numbers = np.unique(np.concatenate(self.words), return_inverse=True)
        return np.split(numbers + 1, np.cumsum(self.sizes)[:-1])

    def root(self, member: int) -> int:
        parent = self.parent
        while parent[member] != member:
            parent[member] = parent[parent[member]]
            member = parent[member]
        return member

    def runs_of(self, member: int) -> np.ndarray:
        if member not in self.runs:
            self.runs[member] = labelled_runs(self.words[member], SHINGLE)
        return self.runs[member]

    def links_of(self, i: int, others: list[int], similarity: float) -> list[int]:
        """The members that a member is linked with, less those that are connected by then.

        Few are aligned at first and more each time, as one link may connect it with all.
        """
        found, count = [], 8
        while others:
            root = self.root(i)
            others = [j for j in others if self.root(j) != root]
            others, taken = others[count:], others[:count]
            taken = [j for j in taken if min(self.buckets[i] & self.buckets[j]) == self.bucket]
            for j in self.near(i, taken, similarity):
                if self.root(i) != self.root(j):
                    self.parent[self.root(i)] = self.root(j)
                    found.append(j)
            count *= 4
        return found

    def near(self, i: int, others: list[int], similarity: float) -> Iterator[int]:
        """Those of the members that a member is within the similarity of."""
        longest = np.maximum(self.sizes[i], self.sizes[np.array(others, np.int64)])
        most = ((1 - similarity) * longest + 1e-9).astype(np.int64)
        banded = np.flatnonzero(longest <= BANDED)
        step = max(1, CELLS // (2 * int(most[banded].max(initial=0)) + 1))
        for at in range(0, len(banded), step):
            own = banded[at : at + step]
            kept = within_band(self.numbered[i], [self.numbered[others[k]] for k in own], most[own])
            yield from (others[k] for k in own[kept])
        for k in np.flatnonzero(longest > BANDED):
            j = others[k]
            if self.root(i) != self.root(j):
                runs = self.runs_of(i), self.runs_of(j)
                if aligned(self.words[i], self.words[j], runs, similarity):
                    yield j


def aligned(one: np.ndarray, other: np.ndarray, runs: tuple, similarity: float) -> bool:
    """Whether two texts are within the similarity."""
    most = int((1 - similarity) * max(len(one), len(other)) + 1e-9)
    if abs(len(one) - len(other)) > most:
        return False
    if edits_at_most(one, other, runs, SHINGLE) <= most:
        return True
    if max(len(one), len(other)) > BANDED:
        return edits_within(one, other, most) is not None
    if max(len(one), len(other)) - _shared(one, other) > most:
        return False
    return bool(within_band(one.view(np.int64), [other.view(np.int64)], np.array([most]))[0])


def links_within(members: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between unconnected members of one bucket that connect them.

    A bucket of more than BLOCK members, or BLOCK_BYTES of text, is dealt into parts. Its
    largest component and the rest are dealt apart: parts of the rest meet all parts, those
    of the component only these. Two members that share several buckets are compared in the
    least of them.
    """
    spark = members.sparkSession
    buckets_of = members.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))
    told = texts.join(rekeyed(buckets_of, "node"), "node").select("node", "text", "buckets")
    sized = members.join(
        rekeyed(texts.select("node", F.octet_length("text").cast("long").alias("_bytes")), "node"), "node"
    )
    largest = (
        sized.groupBy("bucket", "label")
        .agg(F.count("*").alias("_n"), F.sum("_bytes").alias("_b"))
        .groupBy("bucket")
        .agg(F.max(F.struct("_n", "label", "_b")).alias("_main"), F.sum("_b").alias("_all"))
        .select("bucket", F.col("_main.label").alias("_main"), F.col("_main._n").alias("_n"),
                F.col("_main._b").alias("_b"), "_all")
    )

    def parts_of(rows: Column, size: Column) -> Column:
        return F.greatest(F.ceil(rows / F.lit(BLOCK)), F.ceil(size / F.lit(BLOCK_BYTES))).cast("int")

    def meeting(kind: int, one: Column, other: Column, side: Column) -> Column:
        return F.struct(
            F.xxhash64("bucket", F.lit(kind), one, other).alias("_group"), side.cast("int").alias("side")
        )

    in_main = F.col("label") == F.col("_main")
    mains = parts_of(F.col("_n"), F.col("_b"))
    rests = parts_of(F.col("size") - F.col("_n"), F.col("_all") - F.col("_b"))
    part = F.pmod(F.xxhash64("node", F.lit("part")), F.when(in_main, mains).otherwise(rests)).cast("int")
    every_main, every_rest = (F.sequence(F.lit(0), n - 1) for n in (mains, rests))
    own, zero = F.col("_part"), F.lit(0)
    whole = (F.col("size") <= BLOCK) & (F.col("_all") <= BLOCK_BYTES)
    same = F.when(whole, F.array(meeting(2, zero, zero, F.lit(2))))
    groups = same.when(in_main, F.transform(every_rest, lambda x: meeting(0, own, x, zero))).otherwise(
        F.concat(
            F.transform(every_main, lambda x: meeting(0, x, own, F.lit(1))),
            F.transform(
                every_rest,
                lambda x: meeting(
                    1, F.least(own, x), F.greatest(own, x), F.when(own == x, 2).otherwise((own > x).cast("int"))
                ),
            ),
        )
    )
    dealt = (
        members.join(rekeyed(largest, "bucket"), "bucket")
        .withColumn("_part", part)
        .select("bucket", "node", "label", F.explode(groups).alias("_at"))
        .select("bucket", "node", "label", "_at.*")
        .join(rekeyed(told, "node"), "node")
        .select("_group", "side", "bucket", "node", "label", "text", "buckets")
    )
    ordered = dealt.repartition(shuffle_width(spark), "_group").sortWithinPartitions("_group")

    def met(group: Members) -> Iterator[pa.RecordBatch]:
        """The links of one group: of both sides, or of all members where there is one."""
        whole = group.side[0] == 2
        left = np.flatnonzero(group.side != 1)
        right = left if whole else np.flatnonzero(group.side == 1)
        height = max(1, TILE // max(1, len(right)))
        found = []
        for at in range(0, len(left), height):
            own = left[at : at + height]
            root = np.array([group.root(i) for i in range(len(group.node))])
            apart = root[own][:, None] != root[right][None, :]
            if whole:
                apart &= own[:, None] < right[None, :]
            apart &= sized_alike(group.sizes, own, right, similarity)
            if apart.any():
                apart &= marked_alike(group.sizes, group.marks, own, right, similarity)
            if not apart.any():
                continue
            i, j = np.nonzero(apart)
            i, j = own[i], right[j]
            kept = near_enough(group.sizes, group.counts, i, j, similarity)
            i, j = i[kept], j[kept]  # row by row, as the pairs were found
            for x in np.unique(i).tolist():
                found += [(x, y) for y in group.links_of(x, j[i == x].tolist(), similarity)]
        if found:
            a, b = (group.node[list(side)] for side in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, held = WordHashes(), []
        for batch in batches:
            groups = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])).tolist()
            for start, end in zip(starts, [*starts[1:], len(groups)], strict=True):
                if held and held[0].column(0)[0].as_py() != groups[start]:
                    yield from met(Members(pa.Table.from_batches(held), source))
                    held = []
                held.append(batch.slice(start, end - start))
        if held:
            yield from met(Members(pa.Table.from_batches(held), source))

    return ordered.mapInArrow(run, "a long, b long").where(F.col("a") < F.col("b")).distinct()


def likely_among(frame: DataFrame, wanted: DataFrame, key: str, number: int) -> DataFrame:
    """The rows whose (whole-number) key is wanted, and few others.

    Every eight of about so many keys mark bits in one word of 64, and the words are
    broadcast, two bytes a key: a row goes on if its word has the bits of its key.
    """
    block = F.pmod(F.col(key), F.lit(max(1, number // KEYS_A_WORD)).cast("long")).alias("_block")
    places = (F.shiftrightunsigned(F.xxhash64(key), at).bitwiseAND(63).cast("int") for at in (0, 6, 12))
    one, two, three = (F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places)
    bits = one.bitwiseOR(two).bitwiseOR(three).alias("_bits")
    words = wanted.select(block, bits).groupBy("_block").agg(F.bit_or("_bits").alias("_word"))
    marked = frame.select("*", block, bits).join(F.broadcast(words), "_block")
    return marked.where(F.col("_word").bitwiseAND(F.col("_bits")) == F.col("_bits")).select(*frame.columns)


def texts_of(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """The texts of the pairs, each once: (_node, text)."""
    wanted = pairs.select(F.col("a").alias("_node")).union(pairs.select("b")).distinct()
    number = pairs.select(F.approx_count_distinct("a") + F.approx_count_distinct("b")).first()[0]
    # one row of each text: that of least id; of texts that are in no pair few are shuffled
    keyed = likely_among(documents.where(F.col("_node").isNotNull()), wanted, "_node", number).select(
        "_node", F.coalesce("doc_id", F.lit(0)).alias("_id"), "text"
    )
    first = keyed.groupBy("_node").agg(F.min("_id").alias("_id")).join(wanted, "_node")
    # by both keys, as the join has dealt them out
    return keyed.join(first, ["_node", "_id"]).dropDuplicates(["_node", "_id"]).select("_node", "text")


def links(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose words align well enough."""
    sides = pairs.join(rekeyed(texts.toDF("a", "one"), "a"), "a").join(
        rekeyed(texts.toDF("b", "other"), "b"), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = WordHashes()
        last: tuple = (None, None, None)  # rows of one text follow each other
        for batch in batches:
            found = np.zeros(batch.num_rows, bool)
            for row, (b, one, other) in enumerate(zip(*batch.columns[1:], strict=True)):
                x = source.of(one.as_py())
                if last[0] != (b := b.as_py()):
                    last = b, source.of(other.as_py()), None
                y = last[1]
                if abs(len(x) - len(y)) > int((1 - similarity) * max(len(x), len(y)) + 1e-9):
                    continue
                if last[2] is None:
                    last = b, y, labelled_runs(y, SHINGLE)
                found[row] = aligned(x, y, (labelled_runs(x, SHINGLE), last[2]), similarity)
            kept = batch.filter(pa.array(found))
            yield pa.RecordBatch.from_arrays(kept.columns[:2], ["a", "b"])

    return sides.select("a", "b", "one", "other").mapInArrow(run, "a long, b long")


def both_ways(edges: DataFrame) -> DataFrame:
    """Links (a, b) from either end: (node, beside)."""
    return edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "beside")


def least_linked(edges: DataFrame) -> DataFrame:
    """The least of each linked node and its neighbours: (node, label)."""
    least = both_ways(edges).groupBy("node").agg(F.min("beside").alias("_least"))
    return least.select("node", F.least("node", "_least").alias("label"))


def components(edges: DataFrame) -> DataFrame:
    """The least node that each linked node is connected with: (node, label)."""
    edges = cut(edges.select("a", "b").distinct())
    both, labels = both_ways(edges), cut(least_linked(edges))
    while True:
        near = (
            both.join(rekeyed(labels.toDF("beside", "_label"), "beside"), "beside")
            .groupBy("node")
            .agg(F.min("_label").alias("_near"))
        )
        lower = labels.join(near, "node").select(
            "node", "label", F.least("label", "_near").alias("_new")
        )
        # a label's own label is lower still, or the same
        jump = rekeyed(labels.toDF("_new", "_jump"), "_new")
        moved = cut(
            lower.join(jump, "_new", "left").select(
                "node",
                F.least("_new", F.coalesce("_jump", F.col("_new"))).alias("label"),
                F.col("label").alias("_old"),
            )
        )
        labels = moved.select("node", "label")
        if moved.where(F.col("label") != F.col("_old")).isEmpty():
            return labels


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs that are not known to be connected: those of different labels."""

    def label_of(side: str) -> DataFrame:
        return rekeyed(labels.toDF(side, f"_{side}"), side)

    labelled = pairs.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left")
    same = F.coalesce("_a", "a") == F.coalesce("_b", "b")
    return labelled.where(~same).select("a", "b")


def classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Every document's class: doc_id, class_id, n_copies, _node, _label.

    ``n_copies`` counts the rows of the same text.
    """
    importable(documents.sparkSession)
    keyed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", text_node().alias("_node")
    )
    written = Written(documents.sparkSession)
    found = written(buckets(keyed))
    beside = written(*in_shared_buckets(found, SLICES))
    written.drop(found)
    pairs = written(pairs_of(beside))
    texts = written(texts_of(pairs, keyed).toDF("node", "text"))
    nearest = written(pairs_of(beside.groupBy("node").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))))
    linked = written(links(nearest, texts, similarity))
    rest = apart(pairs, least_linked(linked)).join(nearest, ["a", "b"], "left_anti")
    further = written(links(rest, texts, similarity))
    written.drop(pairs, nearest)
    label = components(linked.union(further))
    members = written(unconnected(beside, label))
    written.drop(beside, linked, further)
    if not members.isEmpty():
        wanted = rekeyed(members.select("node").distinct(), "node")
        inside = written(links_within(members, texts.join(wanted, "node"), similarity))
        if not inside.isEmpty():
            known = label.select(F.col("node").alias("a"), F.col("label").alias("b"))
            label = components(known.union(inside))
        written.drop(inside)
    written.drop(members, texts)
    nodes = keyed.groupBy("_node").agg(
        F.min("doc_id").alias("_least"), F.count("*").alias("n_copies")
    )
    nodes = (
        nodes.where(F.col("_node").isNotNull())
        .join(label.withColumnRenamed("node", "_node"), "_node", "left")
        .withColumn("label", F.coalesce("label", "_node"))
    )
    named = nodes.groupBy("label").agg(F.min("_least").alias("class_id"))
    nodes = nodes.join(rekeyed(named, "label"), "label").select(
        "_node", "label", "class_id", "n_copies"
    )
    return (
        keyed.select("doc_id", "_node")
        .join(rekeyed(nodes, "_node"), "_node", "left")
        .select(
            "doc_id",
            F.when(F.col("_node").isNull(), F.col("doc_id"))
            .otherwise(F.col("class_id"))
            .alias("class_id"),
            F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
            "_node",
            F.col("label").alias("_label"),
        )
    )


def representatives(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, all columns kept; texts without words all stay.

    It is the one of least id; of rows that share this id and text, any one.
    """
    absent = F.lit(-(1 << 63)).cast("long")
    chosen = (
        classes(documents.select("doc_id", "text"), similarity)
        .where(F.col("_node").isNotNull() & F.col("doc_id").eqNullSafe(F.col("class_id")))
        .groupBy("_label", "_node")
        .agg(F.min(F.coalesce("doc_id", absent)).alias("_id"), F.count("*").alias("_rows"))
    )
    first = chosen.groupBy("_label").agg(F.min("_node").alias("_node"))
    chosen = chosen.join(first, ["_label", "_node"]).select("_id", "_node", "_rows")
    columns = [f"`{c}`" for c in documents.columns]
    wordy = documents.withColumn("_node", text_node())
    alone = wordy.where(F.col("_node").isNull()).select(*columns)
    keyed = wordy.where(F.col("_node").isNotNull()).withColumn(
        "_id", F.coalesce(F.col("doc_id").cast("long"), absent)
    )
    kept = keyed.join(rekeyed(chosen, "_id", "_node"), ["_id", "_node"])
    single = kept.where(F.col("_rows") == 1)
    several = kept.where(F.col("_rows") > 1).dropDuplicates(["_id", "_node"])
    return single.unionByName(several).select(*columns).unionByName(alone)

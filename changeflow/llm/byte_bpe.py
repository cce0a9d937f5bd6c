"""Byte-level BPE by monoid tree reduction, and decoding.

An encoded string is an element of a monoid: two of them are joined by encoding a window
of tokens at their border again, and a window that is too small to be sure is widened. A
window is sure when each of its two ends and the token next to it encode, together, to
just these two tokens: a sequence of tokens is the encoding of its bytes exactly if that
holds for all neighbours. Strings are halved down to short leaves, and the leaves joined
up the tree. So the work of a long run without spaces follows its length.

The same holds one level up. A text is matched piece by piece against a pattern, and a
long text is cut into blocks that are matched on their own. Two blocks are joined by
matching again from a match well before the border until a match starts where one of the
right block's does; from there on both agree. Decoding concatenates bytes up the tree.

Null and empty texts have no ids. The result of a text does not depend on other rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.encoding import Codes, Rows

RANKS = "byte_bpe_50k.tiktoken"
#: Bytes of a leaf of a match's tree, and characters of a block of a text.
LEAF = 24
BLOCK_CHARS = 1 << 16
#: Tokens on either side of a border that are first encoded again.
WINDOW = 2
#: Characters of kept matches before all are forgotten; longer matches are not kept long.
KEPT_CHARS = 1 << 22
#: Above every rank.
_NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


class Encoder:
    """Encodes byte strings by ranks."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self._apart: dict[tuple[int, int], bool] = {}

    def leaf(self, data: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until no pair has a rank."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        if len(data) > 4 * LEAF:
            return self._long_leaf(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        rank = [self.ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while rank and (least := min(rank)) != _NONE:
            at = rank.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del rank[at]
            for i in (at - 1, at):
                if 0 <= i < len(rank):
                    rank[i] = self.ranks.get(parts[i] + parts[i + 1], _NONE)
        return [self.ranks[p] for p in parts]

    def _long_leaf(self, data: bytes) -> list[int]:
        """The same with a heap of pairs, for windows that had to be widened far."""
        ends = list(range(1, len(data) + 1))  # of the part that begins at each byte
        previous = list(range(-1, len(data)))
        heap: list[tuple[int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and (middle := ends[at]) < len(data):
                rank = self.ranks.get(data[at : ends[middle]])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, ends[middle]))

        for at in range(len(data)):
            offer(at)
        gone = bytearray(len(data))
        while heap:
            _, at, end = heapq.heappop(heap)
            if gone[at] or (middle := ends[at]) >= len(data) or ends[middle] != end:
                continue
            gone[middle] = 1
            ends[at] = end
            previous[end] = at
            offer(previous[at])
            offer(at)
        out, at = [], 0
        while at < len(data):
            out.append(self.ranks[data[at : ends[at]]])
            at = ends[at]
        return out

    def stable(self, left: int, right: int) -> bool:
        """Whether two neighbours stay as they are when encoded together."""
        pair = (left, right)
        if (known := self._apart.get(pair)) is None:
            if len(self._apart) > 1 << 18:
                self._apart.clear()
            known = self.leaf(self.token[left] + self.token[right]) == [left, right]
            self._apart[pair] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded strings' concatenation."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        before = after = WINDOW
        while True:
            before, after = min(before, len(left)), min(after, len(right))
            border = left[len(left) - before :] + right[:after]
            window = self.leaf(b"".join(map(self.token.__getitem__, border)))
            ends = before == len(left) or self.stable(left[-before - 1], window[0])
            starts = after == len(right) or self.stable(window[-1], right[after])
            if ends and starts:
                return left[: len(left) - before] + window + right[after:]
            before, after = before * (1 if ends else 2), after * (1 if starts else 2)

    def encode(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self.leaf(data)
        half = len(data) // 2
        return self.join(self.encode(data[:half]), self.encode(data[half:]))

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids; halves decode to the halves of the bytes."""
        return b"".join(map(self.token.__getitem__, ids))


class Matcher:
    """Matches of a pattern over a text, long texts block by block."""

    def __init__(self, pattern: str) -> None:
        import regex

        self._pattern = regex.compile(pattern)

    def spans(self, text: str, block: int = BLOCK_CHARS) -> list[tuple[int, int]]:
        return self._tree(text, 0, len(text), block)

    def matches(self, text: str) -> list[str]:
        if len(text) <= BLOCK_CHARS:
            return self._pattern.findall(text)
        return [text[a:b] for a, b in self.spans(text)]

    def _tree(self, text: str, start: int, end: int, block: int) -> list[tuple[int, int]]:
        if end - start <= block:
            part = text[start:end]
            return [(start + m.start(), start + m.end()) for m in self._pattern.finditer(part)]
        middle = (start + end) // 2
        left = self._tree(text, start, middle, block)
        return self._join(text, left, self._tree(text, middle, end, block), end)

    def _join(self, text: str, left: list, right: list, end: int) -> list[tuple[int, int]]:
        """Match again around the border.

        The pattern looks at most one character beyond a match. All matches of the left
        block but those that reach its last character are therefore final; matching goes
        on from the first that is not.
        """
        if not left or not right:
            return left + right
        border = right[0][0]
        keep = len(left)
        while keep and left[keep - 1][1] >= border - 1:
            keep -= 1
        # what a match takes may reach back over white space: begin one match earlier
        keep = max(0, keep - 1)
        at = left[keep][0]
        starts = {a: i for i, (a, _) in enumerate(right)}
        again: list[tuple[int, int]] = []
        while at < end and at not in starts:
            # a window of text, widened while the match could go on beyond it
            reach = max(64, 2 * (border - at))
            while True:
                window = text[at : min(end, at + reach)]
                found = self._pattern.match(window)
                if at + reach >= end or found.end() < len(window) - 1:
                    break
                reach *= 2
            again.append((at, at + found.end()))
            at += found.end()
        return left[:keep] + again + (right[starts[at] :] if at < end else [])


@lru_cache(maxsize=2)
def _worker_state(path: str, pattern: str) -> tuple[Encoder, Matcher]:
    return Encoder(load_ranks(path)), Matcher(pattern)


class TextEncoder:
    """Ids of whole texts; the ids of matches already seen are kept for a while."""

    def __init__(self, path: str, pattern: str) -> None:
        self.encoder, self._matcher = _worker_state(path, pattern)
        self._forget()

    def _forget(self) -> None:
        self._codes, self._ids = Codes(), Rows(np.uint32)

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if self._codes.chars > KEPT_CHARS:
            self._forget()
        found = self._matcher.matches(text)
        codes = np.fromiter(map(self._codes.__getitem__, found), np.int64, len(found))
        if fresh := self._codes.fresh:
            self._ids.extend([self.encoder.encode(m.encode()) for m in fresh])
            self._codes.taken()
        return self._ids.gather(codes)

    def text(self, ids: np.ndarray) -> bytes:
        return self.encoder.decode(ids.tolist())


ENCODED = "doc_id long, ids array<int>, decoded binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encoded(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Every document's ids and the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(ranks_path, pattern)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encoder.ids(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_id.as_py()], pa.int64()),
                        pa.array([ids.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([encoder.text(ids)], pa.binary()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ENCODED)


def digests(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The count and digest of every document's ids, and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(ranks_path, pattern)
        for batch in batches:
            rows: tuple[list, list, list, list] = ([], [], [], [])
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encoder.ids(text.as_py())
                rows[0].append(doc_id.as_py())
                rows[1].append(len(ids))
                rows[2].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                rows[3].append(hashlib.sha256(encoder.text(ids)).hexdigest())
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, types, strict=True)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, DIGESTS)

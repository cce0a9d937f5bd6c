"""Texts rearranged for fill-in-the-middle training, cut between tokens.

A text is read as units: runs of ASCII letters, and every other character by itself. Two
draws from the digest of the document's id cut it between units into prefix, middle and
suffix; a third and a fourth decide on the form:

* plain: the text as it is. So are empty texts and those that hold a mark already;
* psm: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
* spm: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

*Cuts.* Units are found in the UTF-8 bytes, so a cut is a byte position, while lengths are
told in characters. ``Exceptions`` converts between both: it holds the places of the
multibyte characters only, and the bytes they have taken beyond one each. A binary search
counts the exceptions before a cut; what lies between two of them is plain arithmetic, and
an ASCII text has an empty index.

*The way back.* No text that was cut holds a mark, and no mark begins as another ends, so
an output falls apart at its three marks in one way only.

A null text is an empty one. A document's draws depend on its id alone: rows that share an
id share draws, repeated rows come out alike, and a null id draws like an empty one. Very
long texts are handled one at a time, with about nine bytes for each of theirs. An empty
table gives an empty result. Other columns of the documents are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.tables import importable

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: What is put before an id whose digest is drawn from.
SEED = "1"
#: Of 100 texts, so many stay plain; of 100 others, so many have the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
#: Bytes of text looked at together; a longer text is looked at by itself.
BLOCK_BYTES = 1 << 22

DRAWS = ("_h1", "_h2", "_h3", "_h4")
ARRANGED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Exceptions:
    """The characters of more than one byte: where they are, and their bytes beyond one."""

    def __init__(self, raw: np.ndarray) -> None:
        self.at_byte = np.flatnonzero(raw >= 0xC0)
        lead = raw[self.at_byte]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        #: Bytes beyond one a character, before each exception and after the last.
        self.excess = np.concatenate([[0], np.cumsum(excess)])
        self.at_char = self.at_byte - self.excess[:-1]

    def chars(self, cuts: np.ndarray) -> np.ndarray:
        """Characters before byte positions that no character spans."""
        return cuts - self.excess[np.searchsorted(self.at_byte, cuts)]

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before so many characters."""
        return cuts + self.excess[np.searchsorted(self.at_char, cuts)]


def unit_starts(raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The bytes that units start at; ``texts`` holds where texts start."""
    letter = ((raw | 0x20) - np.uint8(97)) < 26
    start = (raw & 0xC0) != 0x80
    follows = letter[1:] & letter[:-1]
    start[1:] &= ~follows
    start[texts[texts < len(raw)]] = True
    return np.flatnonzero(start)


def _digits(group: int) -> Column:
    digest = F.sha2(
        F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256
    )
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def _cut(raw: np.ndarray, ends: np.ndarray, draws: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Units of each text, its two cuts in bytes, and their places in characters."""
    starts = unit_starts(raw, ends[:-1])
    first = np.searchsorted(starts, ends[:-1])
    units = np.searchsorted(starts, ends[1:]) - first
    places = np.append(starts, len(raw))
    one, other = draws[0] % (units + 1), draws[1] % (units + 1)
    index, base = Exceptions(raw), ends[:-1]
    cuts, chars = [], []
    for unit in (np.minimum(one, other), np.maximum(one, other)):
        cut = np.where(unit < units, places[first + np.minimum(unit, units)], ends[1:])
        cuts.append(cut)
        chars.append(index.chars(cut) - index.chars(base))
    return units, *cuts, *chars


def _arranged(ids: pa.Array, texts: pa.Array, draws: list[np.ndarray]) -> pa.RecordBatch:
    """Texts in the form their draws give them."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data, base = texts.buffers()[2], int(offsets[0])
    whole = data.slice(base, int(offsets[-1]) - base).to_pybytes() if data is not None else b""
    ends = offsets.astype(np.int64) - base
    units, low, high, low_chars, high_chars = _cut(np.frombuffer(whole, np.uint8), ends, draws)
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    forms, outputs = [], []
    for i in range(len(texts)):
        a, b = int(ends[i]), int(ends[i + 1])
        text = whole[a:b]
        if not text or draws[2][i] % 100 >= 100 - PLAIN or p in text or s in text or m in text:
            forms.append("plain")
            outputs.append(text)
            continue
        x, y = int(low[i]), int(high[i])
        prefix, middle, suffix = whole[a:x], whole[x:y], whole[y:b]
        if draws[3][i] % 100 < SUFFIX_FIRST:
            forms.append("spm")
            outputs.append(b"".join([s, suffix, p, prefix, m, middle]))
        else:
            forms.append("psm")
            outputs.append(b"".join([p, prefix, s, suffix, m, middle]))
    plain = np.array([f == "plain" for f in forms], bool)
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(units, pa.int64()),
            pa.array(forms, pa.string()),
            pa.array(low_chars, pa.int64(), mask=plain),
            pa.array(high_chars - low_chars, pa.int64(), mask=plain),
            pa.array(outputs, pa.string()),
        ],
        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def arranged(documents: DataFrame) -> DataFrame:
    """Every text in its form: doc_id, n (units), form, prefix_chars, middle_chars, output."""
    importable(documents.sparkSession)
    drawn = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *[_digits(group).alias(name) for group, name in enumerate(DRAWS)],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.string())
            draws = [batch.column(i).to_numpy() for i in range(2, 6)]
            if not batch.num_rows:
                continue
            offsets = np.frombuffer(texts.buffers()[1], np.int32)
            offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            at = 0
            while at < batch.num_rows:
                end = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1
                size = min(max(end, at + 1), batch.num_rows) - at
                own = [d[at : at + size] for d in draws]
                yield _arranged(ids.slice(at, size), texts.slice(at, size), own)
                at += size

    return drawn.mapInArrow(run, ARRANGED)


def restored(output: Column, form: Column) -> Column:
    """The text that an output in a form was made of."""
    part = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(F.get(part, 1), F.get(part, 3), F.get(part, 2)))
        .otherwise(F.concat(F.get(part, 2), F.get(part, 3), F.get(part, 1)))
    )

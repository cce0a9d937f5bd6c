"""Token ids of whole texts by the public word-level BPE vocabulary.

The vocabulary drops white space and no merge crosses it, so a text's ids are the ids of
its space-separated chunks in turn. Each Python worker keeps the ids of chunks it has
seen, the frequent ones longest, and asks the tokenizers library for new ones only. A chunk of Latin letters needs
none of the library's normalising and splitting: it goes straight to its BPE model. Short
texts are taken together; what is kept of chunks is bounded.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_VOCABULARY = "word_bpe_49k.json"
#: Bytes of texts taken together, and characters of kept chunks before the rare are forgotten.
GROUP_BYTES = 1 << 22
KEPT_CHARS = 1 << 22

#: A word of Latin letters, all of them composed and of simple lower case, and its stops.
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,;:!?]*)")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Codes(dict):
    """Numbers strings in order of first sight; ``fresh`` lists those not yet encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []
        self.chars = 0

    def __missing__(self, text: str) -> int:
        code = self[text] = len(self)
        self.fresh.append(text)
        return code

    def taken(self) -> None:
        """The fresh strings are encoded."""
        self.chars += sum(map(len, self.fresh))
        self.fresh = []


class Values:
    """A number for each string, computed when it is first seen and kept for a while.

    All are forgotten once their characters exceed ``kept_chars``.
    """

    def __init__(self, value: Callable, dtype, kept_chars: int = 1 << 22) -> None:
        self._value, self._dtype, self._kept_chars = value, dtype, kept_chars
        self._forget()

    def _forget(self) -> None:
        self._codes, self._held, self._count = Codes(), np.zeros(0, self._dtype), 0

    def of(self, strings: list) -> np.ndarray:
        if self._codes.chars > self._kept_chars:
            self._forget()
        codes = np.fromiter(map(self._codes.__getitem__, strings), np.int64, len(strings))
        if fresh := self._codes.fresh:
            end = self._count + len(fresh)
            self._held = _room(self._held, end)
            self._held[self._count : end] = list(map(self._value, fresh))
            self._count = end
            self._codes.taken()
        return self._held[codes]


class Rows:
    """Rows of numbers of varying length, appended at the end and gathered by row."""

    def __init__(self, dtype) -> None:
        self.flat = np.empty(1 << 12, dtype)
        self.starts = np.zeros(1 << 10, np.int64)
        self.count = 0

    def extend(self, rows: list) -> None:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        values = np.fromiter(chain.from_iterable(rows), self.flat.dtype, int(sizes.sum()))
        first = self.starts[self.count]
        end = first + len(values)
        self.flat = _room(self.flat, end)
        self.starts = _room(self.starts, self.count + len(rows) + 1)
        self.flat[first:end] = values
        self.starts[self.count + 1 : self.count + 1 + len(rows)] = first + np.cumsum(sizes)
        self.count += len(rows)

    def row(self, code: int) -> list[int]:
        return self.flat[self.starts[code] : self.starts[code + 1]].tolist()

    def sizes(self, codes: np.ndarray) -> np.ndarray:
        return self.starts[codes + 1] - self.starts[codes]

    def gather(self, codes: np.ndarray) -> np.ndarray:
        sizes = self.sizes(codes)
        ends = np.cumsum(sizes)
        index = np.arange(ends[-1] if len(ends) else 0)
        return self.flat[index + np.repeat(self.starts[codes] - (ends - sizes), sizes)]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    grown = np.zeros(max(size, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


class WordEncoder:
    """Ids of texts as the tokenizers library gives them, no special tokens added.

    Where a text holds the string of a special token, that is its id, as by the library's
    default. Such strings hold no white space, so they lie within chunks, and chunks that
    may hold one go to the library whole. A null text has no ids.
    """

    def __init__(self, path: str, kept_chars: int | None = None) -> None:
        self._kept_chars = KEPT_CHARS if kept_chars is None else kept_chars
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._letters = _byte_letters()
        self._stops: dict[str, list[int]] = {}
        self._codes, self._ids, self._uses = Codes(), Rows(np.uint32), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Forget the chunks used least, half of all or more."""
        chunks = list(self._codes)
        uses = self._uses[: len(chunks)]
        kept = np.flatnonzero(uses > max(1.0, np.median(uses)))
        rows = [self._ids.row(code) for code in kept.tolist()]
        self._codes, self._ids, self._uses = Codes(), Rows(np.uint32), np.zeros(len(kept), np.int64)
        for code in kept.tolist():
            self._codes[chunks[code]]
        self._codes.taken()
        if rows:
            self._ids.extend(rows)

    def _encoded(self, chunks: list[str]) -> np.ndarray:
        """Codes of distinct chunks, new ones encoded."""
        if self._codes.chars > self._kept_chars:
            self._forget()
        codes = np.fromiter(map(self._codes.__getitem__, chunks), np.int64, len(chunks))
        if fresh := self._codes.fresh:
            self._ids.extend([self._chunk(c) for c in fresh])
            self._codes.taken()
            self._uses = _room(self._uses, len(self._codes))
        self._uses[codes] += 1
        return codes

    def _chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The codes of all chunks of some texts, and where each text's chunks end."""
        spaced = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        split = pc.split_pattern(spaced, " ")
        places = split.offsets.to_numpy()
        # a chunk is looked up once, however often the texts have it
        distinct = split.flatten().dictionary_encode()
        codes = self._encoded(distinct.dictionary.to_pylist())
        return codes[distinct.indices.to_numpy()], places[1:] - places[0]

    def _chunk(self, chunk: str) -> list[int]:
        if chunk.isalpha() and chunk.isascii():
            return self._word(chunk, chunk.lower())
        word, stop = chunk[:-1], chunk[-1:]
        if stop in self._stops and word.isalpha() and word.isascii():
            return self._word(chunk, word.lower()) + self._stops[stop]
        if not (plain := PLAIN.fullmatch(chunk)):
            return self._tokenizer.encode(chunk, add_special_tokens=False).ids
        word, stops = plain.groups()
        ids = self._word(chunk, word.lower())
        if stops:
            if stops not in self._stops:
                self._stops[stops] = [t.id for t in self._model.tokenize(stops)]
            ids = ids + self._stops[stops]
        return ids

    def _word(self, chunk: str, word: str) -> list[int]:
        """The ids of the lower-case word of a chunk."""
        if word != chunk:  # without capitals and stops it may have been seen before
            seen = self._codes.get(word, self._ids.count)
            if seen < self._ids.count:
                return self._ids.row(seen)
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self._letters)
        return [t.id for t in self._model.tokenize(word)]

    def ids(self, text: str | None) -> np.ndarray:
        return next(self.all_ids([text]))

    def all_ids(self, texts: pa.Array | list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for group in _groups(texts):
            codes, ends = self._chunks(group)
            ids, sizes = self._ids.gather(codes), self._ids.sizes(codes)
            places = np.concatenate([[0], np.cumsum(sizes)])[ends]
            yield from np.split(ids, places[:-1])

    def counts(self, texts: pa.Array | list[str | None]) -> list[int]:
        """The number of ids of each text."""
        out: list[int] = []
        for group in _groups(texts):
            codes, ends = self._chunks(group)
            total = np.concatenate([[0], np.cumsum(self._ids.sizes(codes))])
            out += np.diff(total[np.concatenate([[0], ends])]).tolist()
        return out


def _groups(texts: pa.Array | list[str | None]) -> Iterator[pa.Array]:
    """Consecutive texts of GROUP_BYTES, or a little less, at a time."""
    if isinstance(texts, list):
        texts = pa.array(texts, pa.string())
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + GROUP_BYTES, "right")))
        yield texts.slice(start, end - start)
        start = end


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the others for those from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def word_encoder(path: str, kept_chars: int | None = None) -> WordEncoder:
    """The worker's encoder for a vocabulary file; some 25 bytes of memory a kept character."""
    return WordEncoder(path, kept_chars)

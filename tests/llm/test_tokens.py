"""Encoded lengths, packing, token files and byte-level BPE against plain computations."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from changeflow.llm import byte_bpe, lengths, packing, queries, token_files
from changeflow.llm.encoding import WORD_VOCABULARY, WordEncoder, vocabulary_path
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.001"
VOCABULARY = vocabulary_path(WORD_VOCABULARY)
ODD = [
    None, "", " ", "a", "áb ́c", "It's THE\x1cend\x85of it's", "x" * 9000,
    "12345 \n\n  \t tail ", "<|endoftext|> here", "a<|endoftext|><|startoftext|>b,<|ENDOFTEXT|>\n<|endoftext|>.", "==== " * 3000, "é\U0001f600 " * 500,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.load_ranks(vocabulary_path(byte_bpe.RANKS))
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "extra") for i, t in enumerate(ODD)] + [(None, "null id", "x"), (3, "a", "again")]
    return spark.createDataFrame(rows, "doc_id long, text string, length string")


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


def test_chunked_ids_are_the_librarys(library, spark):
    encoder = WordEncoder(VOCABULARY)
    for text in [*ODD, *(d["text"] for d in documents(spark))]:
        assert encoder.ids(text).tolist() == library(text)
        assert encoder.counts([text]) == [len(library(text))]
    assert [i.tolist() for i in encoder.all_ids(ODD)] == [library(t) for t in ODD]
    assert encoder.counts(ODD) == [len(library(t)) for t in ODD]


def test_groups_of_texts_and_forgotten_chunks(monkeypatch, library):
    from changeflow.llm import encoding

    texts = ["some words, and somemorewithoutspace then  two spaces " * 5, None, "", "a", *ODD, ""]
    for group, kept in ((0, 20), (9, 1 << 20), (1 << 20, 0)):
        monkeypatch.setattr(encoding, "GROUP_BYTES", group)
        monkeypatch.setattr(encoding, "KEPT_CHARS", kept)
        encoder = WordEncoder(VOCABULARY)
        assert [i.tolist() for i in encoder.all_ids(texts)] == [library(t) for t in texts]
        assert encoder.counts(texts) == [len(library(t)) for t in texts]


def test_histogram_answers_every_limit(spark, odd, library, monkeypatch):
    monkeypatch.setattr(lengths, "BLOCK", 16)
    sizes = [len(library(r["text"])) for r in odd.collect()]
    counts = lengths.by_limit(lengths.histogram(lengths.encoded_lengths(odd, VOCABULARY)))
    found = {r["length"]: r for r in counts.collect()}
    assert {n: r["n_docs"] for n, r in found.items()} == Counter(sizes)
    for limit, row in found.items():
        assert row["docs_within"] == sum(s <= limit for s in sizes)
        assert row["tokens_within"] == sum(s for s in sizes if s <= limit)
        assert row["docs_longer"] == sum(s > limit for s in sizes)
        assert row["tokens_longer"] == sum(s for s in sizes if s > limit)
        assert row["truncated_tokens"] == sum(min(s, limit) for s in sizes)
    for row in lengths.at_limits(counts, [0, 3, 50, 10**6]).collect():
        assert row["truncated_tokens"] == sum(min(s, row["context"]) for s in sizes)
        assert row["docs_within"] == sum(s <= row["context"] for s in sizes)
    assert lengths.quantiles(counts, [0.5])[0.5] == sorted(sizes)[(len(sizes) + 1) // 2 - 1]
    empty = lengths.by_limit(lengths.histogram(lengths.encoded_lengths(odd.limit(0), VOCABULARY)))
    assert empty.collect() == [] and lengths.quantiles(empty, [0.5]) == {}


def test_query_histogram_counts_all_documents(spark, library):
    sizes = Counter(len(library(d["text"])) for d in documents(spark))
    rows = queries.op8_length_histogram(spark, SF_DIR).collect()
    assert {r["length"]: r["n_docs"] for r in rows} == sizes


def check_packing(frame, texts, library, capacity=4096):
    rows = frame.collect()
    expected = []
    for doc_id, text in texts:
        ids = np.array([*library(text), 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            expected.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    got = [tuple(r)[:5] for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(r["length"] for r in rows)


def test_packing_is_whole_and_tight(spark, odd, library):
    texts = [(d["doc_id"], d["text"]) for d in documents(spark)]
    made, tokens = check_packing(queries.op4_best_two_fit_packing(spark, SF_DIR), texts, library)
    assert made <= -(-tokens // 4096) + 1
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check_packing(packing.packed(odd, VOCABULARY, 64), texts, library, 64)
    assert packing.packed(odd.limit(0), VOCABULARY).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plan_places_every_rank_once(counts):
    plan = packing.plan(counts, 40)
    taken = {}
    for length, count in counts.items():
        sequence, offset = plan.place(np.full(count, length), np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            for token in range(o, o + length):
                assert taken.setdefault((s, token), (s, o)) == (s, o)
                assert token < 40
    assert len(taken) == sum(n * k for n, k in counts.items())
    sizes = Counter(s for s, _ in taken)
    assert set(sizes) == set(range(plan.sequences))
    for s, size in sizes.items():
        assert {t for q, t in taken if q == s} == set(range(size))


def test_two_pieces_replace_the_smallest():
    # 10 = 6 + 3 leaves a gap of one; 6 + (2 + 2) fills it
    assert packing._tightened({6: 1, 3: 1}, np.array([0, 0, 2, 1, 0, 0, 1]), 10) == {6: 1, 2: 2}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 255, 256, 49407, 65535, 65536, 2**24, 2**32 - 1]), max_size=1500))
def test_codes_give_any_id_and_run(ids):
    codes = token_files.Codes(token_files.encode(np.array(ids, np.uint32)))
    assert len(codes) == len(ids)
    for i in random.Random(1).sample(range(len(ids)), min(20, len(ids))):
        assert codes[i] == ids[i]
        assert codes.run(i, len(ids)).tolist() == ids[i:]
        assert codes.run(0, i).tolist() == ids[:i]


def expected_files(texts, library):
    start, rows = 0, []
    for doc_id, text in texts:
        ids = np.array([*library(text), 2], "<u4")
        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(rows, key=repr)


def test_token_files_read_back(spark, odd, library, tmp_path, monkeypatch):
    texts = sorted((d["doc_id"], d["text"]) for d in documents(spark))
    got = queries.op9_directly_addressable_codes(spark, SF_DIR)
    assert rows_of(got) == expected_files(texts, library)
    distinct = odd.where("doc_id is null or doc_id != 3 or length = 'extra'")  # order of the rest is given by id
    token_files.write(distinct, f"{tmp_path}/odd", VOCABULARY)
    texts = [(None, "null id"), *enumerate(ODD)]
    assert rows_of(token_files.read(spark, f"{tmp_path}/odd")) == expected_files(texts, library)
    token_files.write(odd, f"{tmp_path}/all", VOCABULARY)
    rows = sorted(token_files.read(spark, f"{tmp_path}/all").collect(), key=lambda r: r["start"])
    assert len(rows) == odd.count()
    assert [r["start"] for r in rows[1:]] == list(np.cumsum([r["n_tokens"] for r in rows])[:-1])
    token_files.write(odd.limit(0), f"{tmp_path}/none", VOCABULARY)
    assert token_files.read(spark, f"{tmp_path}/none").collect() == []


def test_row_groups_of_token_files_stay_small(spark, tmp_path, library):
    rng = random.Random(5)
    words = sorted({w for d in documents(spark) for w in d["text"].split() if w.isalpha()})
    texts = [(i, " ".join(rng.choices(words, k=20_000))) for i in range(300)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        token_files.write(frame, f"{tmp_path}/large", VOCABULARY)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    found = [pq.ParquetFile(f).metadata for f in tmp_path.glob("large/*.parquet")]
    sizes = [m.row_group(i).total_byte_size for m in found for i in range(m.num_row_groups)]
    assert sum(sizes) > 12 << 20 and max(sizes) < 12 << 20
    got = token_files.read(spark, f"{tmp_path}/large").where("doc_id % 50 < 2 and doc_id < 120")
    expected = {r[0]: r[2:] for r in expected_files(texts[:2] + texts[50:52] + texts[100:102], library)}
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in got.collect()} == expected


def expected_digests(texts, reference):
    rows = []
    for doc_id, text in texts:
        ids = np.array(reference.encode_ordinary(text or ""), "<u4")
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        rows.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), digest))
    return sorted(rows, key=repr)


def test_byte_bpe_is_the_librarys(spark, odd, reference):
    texts = [(d["doc_id"], d["text"]) for d in documents(spark)]
    assert rows_of(queries.op10_monoid_byte_bpe(spark, SF_DIR)) == expected_digests(texts, reference)
    path = vocabulary_path(byte_bpe.RANKS)
    got = byte_bpe.digests(odd, path, public_tokenizers.PATTERN)
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows_of(got) == expected_digests(texts, reference)
    for row in byte_bpe.encoded(odd, path, public_tokenizers.PATTERN).collect():
        assert row["ids"] == reference.encode_ordinary(row["decoded"].decode())
    assert byte_bpe.digests(odd.limit(0), path, public_tokenizers.PATTERN).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aethio=- 'és"), min_size=1, max_size=400) | st.binary(min_size=1, max_size=200))
def test_tree_reduction_is_the_plain_encoding(reference, text):
    data = text.encode() if isinstance(text, str) else text
    expected = reference._encode_single_piece(data)
    assert ENCODER.encode(data) == expected
    assert ENCODER._long_leaf(data) == expected
    assert ENCODER.decode(expected) == data


ENCODER = byte_bpe.Encoder(byte_bpe.load_ranks(vocabulary_path(byte_bpe.RANKS)))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab '\n\t.1lrées"), max_size=120), st.integers(1, 9))
def test_blocks_match_like_the_whole_text(text, block):
    matcher = byte_bpe.Matcher(public_tokenizers.PATTERN)
    plain = [m.span() for m in matcher._pattern.finditer(text)]
    assert matcher.spans(text, block) == plain

"""Fill-in-the-middle texts against a plain transformation, and the way back."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from changeflow.llm import middles, queries
from compare import differences, oracle_connection
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, n string, form int, output string"


def plain(doc_id, text):
    """(doc_id, n, form, prefix_chars, middle_chars, output) from its definition."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_query_matches_its_sql(spark):
    name = "op13_exception_index_middles"
    connection = oracle_connection(SF_DIR)
    assert differences(queries.QUERIES[name](spark, SF_DIR), connection, queries.ORACLE[name]) == ""


TEXTS = [
    None, "", "a", "é", "abc", "A-b", "日本語 text 🙂🙂 mixed é", "line\nbreak\r\n\ttab\x00nul", "has <P> a mark", "<M>", "<S", "<<S><",
    "P><S", "<P<S<M", "straße ÀÉ x" * 50, "🙂" * 2000, "plain words only " * 3000, "x" * 100_000, "́combining", "  ",
]


@pytest.mark.parametrize("block", [1, 64, middles.BLOCK_BYTES])
def test_nulls_marks_and_characters_of_all_widths(spark, monkeypatch, block):
    monkeypatch.setattr(middles, "BLOCK_BYTES", block)
    rows = [(i * len(TEXTS) + k, t, "n", 1, "o") for i in range(12) for k, t in enumerate(TEXTS)]
    rows += [(None, "no id at all", "n", None, None), rows[6], rows[6], (-3, "negative id", None, None, None)]
    found = middles.arranged(spark.createDataFrame(rows, DOCUMENTS).repartition(3))
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == sorted((plain(i, t) for i, t, *_ in rows), key=str)
    forms = {r[2] for r in got}
    assert forms == {"plain", "psm", "spm"}
    back = found.select("doc_id", middles.restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(((i, t or "") for i, t, *_ in rows), key=str)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZ é日🙂\n"), max_size=40))
def test_index_converts_both_ways(text):
    index = middles.Exceptions(np.frombuffer(text.encode(), np.uint8))
    chars = np.arange(len(text) + 1)
    cuts = np.array([len(text[:c].encode()) for c in chars])
    assert index.bytes(chars).tolist() == cuts.tolist()
    assert index.chars(cuts).tolist() == chars.tolist()
    # nothing is held for characters of one byte
    assert len(index.at_byte) == sum(ord(c) > 127 for c in text)


def test_empty_table(spark):
    found = middles.arranged(spark.createDataFrame([], DOCUMENTS))
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert found.collect() == []

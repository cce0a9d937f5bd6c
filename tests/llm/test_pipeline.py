"""The corpus pipeline, stage by stage, each on its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from test_near import classes_by_all_pairs
from test_substrings import brute_force
from test_toxicity import planted

SF_DIR = "/root/testdata/sf0.001"


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def test_stages_keep_columns_and_do_their_work(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "minhash_near_dedup":
            groups = classes_by_all_pairs(list(before.items()))
            wordy = {i for i, t in before.items() if (t or "").split()}
            assert set(after) == {min(g) for g in groups} | (set(before) - wordy)
            assert all(before[i] == t for i, t in after.items())
        if name == "substring_dedup":
            ids = list(before)
            found = brute_force([before[i] for i in ids], 35)
            for i, (n, kept) in zip(ids, found, strict=True):
                if len(kept) == n:
                    assert after[i] == before[i]
                elif kept:
                    assert after[i] == b" ".join(kept).decode()
                else:
                    assert i not in after
            assert all(r["n_chars"] == len(r["text"] or "") for r in docs.collect() if r["text"] != before[r["doc_id"]])
        before = after
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r["doc_id"] for r in final.collect()} == set(before)


def test_run_is_the_stages_one_after_another(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(rows_of(got.select(key))) == Counter(rows_of(docs.select(key)))


def test_toxic_documents_go_and_clean_ones_stay(spark, tmp_path):
    documents, labels = planted(spark)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    left = corpus_pipeline.toxicity_stage(spark, documents, str(tmp_path))
    assert left.columns == documents.columns
    ids = {r["doc_id"] for r in left.collect()}
    assert ids == {i for i in range(402) if i % 4 or i >= 400}


def test_odd_rows(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, 5, "x"), (1, text, 5, "x"), (2, text, 5, "x"), (None, "a b", 5, "x"), (None, "c d", 5, "x")]
    rows += [(3, None, None, "x"), (4, "", 5, "x"), (5, text + " end", 5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, row string")
    near = corpus_pipeline.near_duplicates_stage(spark, docs, SF_DIR)
    assert sorted(rows_of(near.select("doc_id", "text")), key=repr) == sorted(
        [(1, text), (None, "a b"), (None, "c d"), (3, None), (4, "")], key=repr
    )
    left = corpus_pipeline.repeated_passages_stage(spark, docs, SF_DIR)
    assert sorted(rows_of(left.select("doc_id", "text", "n_chars", "row")), key=repr) == sorted(
        [(None, "a b", 5, "x"), (None, "c d", 5, "x"), (3, None, None, "x"), (4, "", 5, "x"), (5, "end", 3, None)],
        key=repr,
    )
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_columns_of_any_name_are_kept(spark, tmp_path):
    names = ["_row", "_node", "toxic_score", "_kept", "_n_words", "_spans", "label", "a b", "text_"]
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, t, *(f"{n}{i}" for n in names)) for i, t in enumerate([text, text + " x", "other", None])]
    docs = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in ["doc_id", "text", *names]).replace("`doc_id` string", "doc_id long"))
    spark.createDataFrame([(0, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, str(tmp_path))
        assert left.columns == docs.columns
        for r in left.collect():
            assert all(r[n] == f"{n}{r['doc_id']}" for n in names)
    assert corpus_pipeline.packing_stage(spark, docs, str(tmp_path)).count() == 4

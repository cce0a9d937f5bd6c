"""The registered queries of the operators, and the SQL that checks them where it can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import (
    byte_bpe,
    fingerprints,
    lengths,
    middles,
    near,
    packing,
    search,
    sharding,
    simhash,
    substrings,
    token_files,
    toxicity,
    vector_codes,
)
from changeflow.llm.encoding import WORD_VOCABULARY, vocabulary_path
from changeflow.llm.tables import shuffle_width, table
from changeflow.session import scratch_dir

SHARDS = 24
#: Queries of the search are the ids divisible by this.
QUERY_EVERY = 50
NEIGHBOURS = 5
SCALE = 256


def op1_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and their likeness."""
    ranges = fingerprints.RANGES_PER_PARTITION * shuffle_width(spark)
    return fingerprints.with_edits(table(spark, sf_dir, "documents"), ranges)


def op2_virtual_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    path = scratch_dir(spark, "shards")
    placed = sharding.sharded(table(spark, sf_dir, "documents"), SHARDS, path)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op3_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents, learned from the labels that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.with_scores(documents, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxic_passages").alias("n_passages"),
    )


def op4_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary_path(WORD_VOCABULARY))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the windows of 35 words that stand anywhere else too."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.without_repeats(documents).select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2(F.encode("_kept", "UTF-8"), 256).alias("kept_sha256"),
    )


def op6_segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every fiftieth vector among all vectors."""
    vectors = search.whole_vectors(table(spark, sf_dir, "embeddings"), SCALE)
    asked = vectors.where(F.col("vec_id") % QUERY_EVERY == 0)
    return search.top_k(vectors, asked, NEIGHBOURS, scratch_dir(spark, "search"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of every document."""
    found = near.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_copies")


def op8_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded lengths of all documents, with the sums for every context limit."""
    found = lengths.encoded_lengths(
        table(spark, sf_dir, "documents"), vocabulary_path(WORD_VOCABULARY)
    )
    return lengths.by_limit(lengths.histogram(found))


def op9_directly_addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written to token files and read back."""
    path = scratch_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, vocabulary_path(WORD_VOCABULARY))
    return token_files.read(spark, path)


def op10_monoid_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by byte-level BPE and decoded again."""
    import public_tokenizers

    return byte_bpe.digests(
        table(spark, sf_dir, "documents"),
        vocabulary_path(byte_bpe.RANKS),
        public_tokenizers.PATTERN,
    )


def op11_pigeonring_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document, and the least id it is connected with."""
    return simhash.classes(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op12_active_entry_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as 16 codes of 64 entries each, with their errors."""
    return vector_codes.with_errors(*vector_codes.compressed(table(spark, sf_dir, "embeddings")))


def op13_exception_index_middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents rearranged for fill-in-the-middle training, and the way back."""
    found = middles.arranged(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middles.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_multiset_fingerprints,
        op2_virtual_slot_sharding,
        op3_toxic_segments,
        op4_best_two_fit_packing,
        op5_repeated_passages,
        op6_segment_search,
        op7_order_minhash,
        op8_length_histogram,
        op9_directly_addressable_codes,
        op10_monoid_byte_bpe,
        op11_pigeonring_simhash,
        op12_active_entry_lloyd,
        op13_exception_index_middles,
    )
}


def _nearest(rows: str, book: str) -> str:
    """SQL: every part's distance and entry, packed so that the lowest of equals is least."""
    return f"""
        SELECT r, p, x, min(d * 64 + e) AS packed FROM (
            SELECT r, p, x, e, CAST(list_sum(list_transform(range(1, len(x) + 1),
                   lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) AS d
            FROM {rows} JOIN {book} USING (p)
        ) GROUP BY r, p, x"""


def _moved(book: str, codes: str) -> str:
    """SQL: the entries at the floors of their parts' means, unused ones as they were."""
    return f"""
        SELECT p, e, coalesce(means.c, {book}.c) AS c FROM {book} LEFT JOIN (
            SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c FROM (
                SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM (
                    SELECT p, packed % 64 AS e, x, unnest(range(1, len(x) + 1)) AS i FROM {codes}
                ) GROUP BY p, e, i
            ) GROUP BY p, e
        ) means USING (p, e)"""


ORACLE = {
    # a window is one whose words start at two places at least
    "op5_repeated_passages": """
        WITH split AS (
            SELECT row_number() OVER () AS r, doc_id,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda w: w <> '') AS words
            FROM documents
        ), windows AS (
            SELECT r, s, md5(array_to_string(words[s:s + 34], ' ')) AS m
            FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS s FROM split)
        ), repeated AS (
            SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY m) AS n FROM windows)
            WHERE n > 1
        ), covered AS (
            SELECT DISTINCT r, unnest(range(s, s + 35)) AS w FROM repeated
        ), gone AS (
            SELECT r, list(w) AS ws, count(*) AS n_removed FROM covered GROUP BY r
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
               CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(array_to_string(
                   CASE WHEN ws IS NULL THEN words
                   ELSE list_filter(words, lambda w, i: NOT list_contains(ws, i)) END,
                   ' '), '')) AS kept_sha256
        FROM split LEFT JOIN gone USING (r)
    """,
    "op6_segment_search": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM scored
        ) WHERE rank <= 5
    """,
    # no SQL function has the hash of op11: its test compares all pairs
    "op12_active_entry_lloyd": f"""
        WITH vectors AS (
            SELECT row_number() OVER () AS r, vec_id, label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS (
            SELECT r, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x
            FROM vectors, (SELECT unnest(range(16)) AS p)
        ), firsts AS (
            SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM vectors ORDER BY e LIMIT 64
        ), book0 AS (SELECT p, e, x AS c FROM parts JOIN firsts USING (r)
        ), codes0 AS ({_nearest("parts", "book0")}
        ), book1 AS ({_moved("book0", "codes0")}
        ), codes1 AS ({_nearest("parts", "book1")}
        ), book2 AS ({_moved("book1", "codes1")}
        ), codes2 AS ({_nearest("parts", "book2")}
        ), told AS (
            SELECT r, string_agg(printf('%02x', packed % 64), '' ORDER BY p) AS code,
                   CAST(sum(packed // 64) AS BIGINT) AS error
            FROM codes2 GROUP BY r
        ), digest AS (
            SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256
            FROM book2
        )
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM vectors JOIN told USING (r), digest
    """,
    "op13_exception_index_middles": """
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
            FROM documents
        ), cuts AS (
            SELECT doc_id, t, u, len(u) AS n,
                   CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS one,
                   CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS other,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                             OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                        WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), parts AS (
            SELECT doc_id, t, n, form,
                   array_to_string(u[1:least(one, other)], '') AS p,
                   array_to_string(u[least(one, other) + 1:greatest(one, other)], '') AS m,
                   array_to_string(u[greatest(one, other) + 1:], '') AS s
            FROM cuts
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts
    """,
}

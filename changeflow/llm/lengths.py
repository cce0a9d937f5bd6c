"""Exact histogram of encoded lengths, and what follows from it for every context limit.

Documents collapse to one row per encoded length, counted without loss. Sums over the
longer and the shorter lengths then answer, for any limit L, how many documents and
tokens are within it, how many documents are longer, and how many tokens remain if all
are cut to L; quantiles are read off the running counts.

A null or empty text has length 0. Repeated rows count each time; ids play no part. An
empty table has an empty histogram, and no quantiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.encoding import word_encoder
from changeflow.llm.tables import cut

#: Lengths summed within one window partition of the running sums.
BLOCK = 256


def encoded_lengths(documents: DataFrame, vocabulary: str) -> DataFrame:
    """The number of token ids of every document: (length long)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        for batch in batches:
            lengths = encoder.counts(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["length"])

    return documents.select("text").mapInArrow(counted, "length long")


def histogram(lengths: DataFrame) -> DataFrame:
    """Documents of each length: (length, n_docs). Computed once, as it is read repeatedly."""
    return cut(lengths.groupBy("length").agg(F.count("*").alias("n_docs")))


def by_limit(counts: DataFrame) -> DataFrame:
    """For each length that occurs, taken as the context limit:

    ``n_docs`` of that length, ``docs_within`` and ``tokens_within`` up to it,
    ``docs_longer`` and ``tokens_longer`` beyond it, and ``truncated_tokens``, the tokens
    left of all documents when each is cut to the limit. Running sums take two levels:
    totals of blocks of lengths, then the lengths of each block.
    """
    rows = counts.select(
        "length",
        "n_docs",
        (F.col("length") * F.col("n_docs")).alias("_tokens"),
        F.floor(F.col("length") / BLOCK).alias("_block"),
    )
    blocks = rows.groupBy("_block").agg(
        F.sum("n_docs").alias("_docs_in"), F.sum("_tokens").alias("_tokens_in")
    )
    after = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "_block",
        *(
            F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}{side}")
            for c in ("_docs_in", "_tokens_in")
            for side, w in (("_after", after), ("_before", before))
        ),
    )
    own = Window.partitionBy("_block")
    up = own.orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    down = own.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)

    def total(column: str, window, beside: str):
        return F.coalesce(F.sum(column).over(window), F.lit(0)) + F.col(beside)

    return (
        rows.join(blocks, "_block")
        .withColumn("docs_within", total("n_docs", up, "_docs_in_before"))
        .withColumn("tokens_within", total("_tokens", up, "_tokens_in_before"))
        .withColumn("docs_longer", total("n_docs", down, "_docs_in_after"))
        .withColumn("tokens_longer", total("_tokens", down, "_tokens_in_after"))
        .select(
            "length",
            "n_docs",
            "docs_within",
            "tokens_within",
            "docs_longer",
            "tokens_longer",
            (F.col("tokens_within") + F.col("length") * F.col("docs_longer")).alias(
                "truncated_tokens"
            ),
        )
    )


def at_limits(limits: DataFrame, contexts: list[int]) -> DataFrame:
    """Answers for any limits, also those that are no document's length."""
    asked = F.explode(F.array(*(F.lit(x).cast("long") for x in sorted(set(contexts)))))
    within = F.col("length") <= F.col("context")
    return (
        limits.select("length", "n_docs", asked.alias("context"))
        .groupBy("context")
        .agg(
            F.sum(F.when(within, F.col("n_docs")).otherwise(0)).alias("docs_within"),
            F.sum(F.least("length", "context") * F.col("n_docs")).alias("truncated_tokens"),
        )
    )


def quantiles(limits: DataFrame, fractions: list[float]) -> dict[float, int]:
    """The least length that at least a fraction of the documents do not exceed."""
    if limits.isEmpty():
        return {}
    share = F.col("docs_within") / (F.col("docs_within") + F.col("docs_longer"))
    found = limits.agg(
        *(F.min(F.when(share >= f, F.col("length"))).alias(str(i)) for i, f in enumerate(fractions))
    ).first()
    return dict(zip(fractions, found, strict=True))

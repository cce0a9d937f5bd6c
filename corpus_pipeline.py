"""The corpus pipeline: documents through the training-data operators, stage by stage.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and
read again as the next stage's documents. All but the last keep the columns of the
documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import near, packing, substrings, toxicity
from changeflow.llm.encoding import WORD_VOCABULARY, vocabulary_path
from changeflow.llm.tables import importable, set_aside, table
from changeflow.session import scratch_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less those whose segments are more likely toxic than not."""
    docs, names = set_aside(docs, "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_scores(docs, model)
    return scored.where(F.col("toxic_score") < 0.5).select(*names)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of least id."""
    importable(spark)
    docs, names = set_aside(docs, "doc_id", "text")
    return near.representatives(docs).select(*names)


def repeated_passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand anywhere else too.

    Texts that hold none stay as they are; of the others the remaining words do, one space
    apart. Documents of which nothing remains go.
    """
    importable(spark)
    docs, names = set_aside(docs, "doc_id", "text", "n_chars")
    found = substrings.without_repeats(docs)
    changed = F.col("_n_removed") > 0
    text = F.when(changed, F.col("_kept")).otherwise(F.col("text"))
    left = found.where(~changed | (F.col("_n_removed") < F.col("_n_words")))
    out = left.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(kind)
        out = out.withColumn("n_chars", length)
    return out.select(*names)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 4096 tokens."""
    importable(spark)
    docs = docs.select("doc_id", "text")
    return packing.packed(docs, vocabulary_path(WORD_VOCABULARY))


STAGES = [
    ("toxicity", toxicity_stage),
    ("minhash_near_dedup", near_duplicates_stage),
    ("substring_dedup", repeated_passages_stage),
    ("best_fit_packing", packing_stage),
]

#: The classifier and the sketches have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}

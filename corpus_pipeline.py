"""From raw documents to packed training sequences, stage by stage.

Every stage gets what its predecessor kept, written and read again, and returns the columns of ``documents``; the last one returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.llm import ngram_join, packing, quality, substring_dedup, toxicity
from paysignal.llm.rows import KEYS, bounded_batches, remainder, row_keys, vocabulary_path
from paysignal.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose toxicity score reaches the threshold."""
    labels = bounded_batches(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, remainder("doc_id", 4) != 2)
    return toxicity.score(docs, model).filter(F.col("score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the quality rules reject."""
    return quality.judge(docs).filter("_quality.kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near copies."""
    bounded_batches(spark)
    kept = ngram_join.jaccard_groups(docs).filter("kept").select(*KEYS).distinct()
    keyed = docs.select("*", *row_keys("doc_id", "text"))
    # equal rows have equal keys: one of them stays
    return keyed.join(kept, KEYS, "left_semi").dropDuplicates(KEYS).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur more than once."""
    bounded_batches(spark)
    cut = substring_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their token ids."""
    bounded_batches(spark)
    return packing.pack_documents(docs, vocabulary_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

# Trained scores, sketches, hash-drawn paths and a tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs

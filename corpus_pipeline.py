"""Corpus preparation in stages, each one operator of ``ledgertide.llm`` over all that its predecessor kept.

Every stage but the last returns the columns of ``documents``. ``run`` writes each
stage's result to the shared folder and reads it again, so that a lost executor
costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertide.llm import exact, jaccard, langid, packing, substring
from ledgertide.llm.common import positional, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected: no letters, or a score below the calibrated threshold."""
    names, rows = positional(docs)
    doc_id, text, lang = (f"c{names.index(c)}" for c in ("doc_id", "text", "lang"))
    model = langid.fit(rows.select(doc_id, text, lang), F.xxhash64(doc_id), text, lang)
    told = langid.identify(rows, model, text)
    return told.where("NOT rejected").select(*rows.columns).toDF(*names)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    return exact.one_per_group(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    return jaccard.one_per_class(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that occur earlier; a text without any stays as it was."""
    names, rows = positional(docs)
    text = f"c{names.index('text')}"
    left = substring.remove_repeats(rows, f"c{names.index('doc_id')}", text)
    left = left.withColumn(text, F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col(text)))
    if "n_chars" in names:
        chars = f"c{names.index('n_chars')}"
        left = left.withColumn(chars, F.coalesce(F.char_length(text).cast("long"), F.col(chars)))
    return left.select(*rows.columns).toDF(*names)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences."""
    return packing.op5_cost_packing(docs)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_passages),
    ("packing", sequences),
]

#: Language identification and packing cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

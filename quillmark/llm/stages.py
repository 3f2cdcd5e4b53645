"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns documents.

A row that a stage keeps keeps its columns; only the text (and ``n_chars``) may change. Null and
empty texts, repeated rows, null ids and empty tables are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import decontamination, exact_dedup, pieces, quality, simhash
from quillmark.llm.common import PIECE_MODEL, read_table

REJECT_BELOW = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects; it learns from the labels of ``docs``."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model, REJECT_BELOW)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints."""
    return simhash.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the words that lie in benchmark passages."""
    cleaned = decontamination.without_passages(docs, read_table(spark, sf_dir, "benchmark"))
    return cleaned.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the piece ids of the text, their number and digest, and whether decoding them gives the text."""
    return pieces.encode(docs, PIECE_MODEL).drop("_row")


STAGES = [
    ("quality", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("pieces", piece_stage),
]

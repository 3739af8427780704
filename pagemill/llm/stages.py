"""Stages of the corpus pipeline: each applies one operator and lets its decision
take effect. All but the last return the columns they were given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import decontam, neardup, packing, pii, quality, queries
from pagemill.llm.common import table

GOOD = 0.3


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least GOOD."""
    model = queries.learn_quality(spark, sf_dir, docs)
    kept = quality.score(docs, model, out="__quality").where(F.col("__quality") >= GOOD)
    return kept.drop("__quality")


# Near copies share 0.8 of their five-word shingles.
COPY_SHINGLE, COPY_PERCENT = 5, 80


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.drop_copies(docs, shingle=COPY_SHINGLE, percent=COPY_PERCENT)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by an item of `benchmark`."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their text replaced by the kind's name."""
    return pii.mask_personal_data(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their ids and where they stand."""
    return packing.pack(docs)

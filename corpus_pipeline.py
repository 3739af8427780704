"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and is written as Parquet before the next one reads it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import stages
from pagemill.session import scratch_root

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", stages.drop_poor),
    ("near_duplicates", stages.drop_near_copies),
    ("decontamination", stages.drop_benchmark_text),
    ("personal_data", stages.mask_personal_data),
    ("packing", stages.pack_sequences),
]

# Compression and bin packing are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over `documents`. Intermediate tables go to the
    shared folder of the session."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

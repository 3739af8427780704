"""Harvest evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.operators.ordering import running_totals
from pagemill.plans.frontier import page_label


def label_pages(scored: DataFrame, threshold: float = fixed.PAGE_THRESHOLD) -> DataFrame:
    return scored.withColumn("label", page_label(F.col("score"), threshold))


def harvest_curve(scored: DataFrame, page_id: str = "page_id", label: str = "label") -> DataFrame:
    """(page_id, rel, tot) in page order: relevant pages and pages so far."""
    rows = running_totals(scored.select(page_id, label), [F.col(page_id)], {"rel": F.col(label)}, "_pos")
    return rows.select(page_id, "rel", (F.col("_pos") + 1).alias("tot"))


def harvest_summary(scored: DataFrame, label: str = "label") -> DataFrame:
    """Relevant pages, all pages, harvest ratio."""
    return scored.agg(
        F.sum(label).cast("bigint").alias("relevant"), F.count("*").alias("total"), F.avg(label).alias("ratio")
    )

"""Global order without a single-task window.

Rows are range-partitioned by the whole order key and the partition number is
written with them. Each partition is numbered on its own and shifted by the
totals of the partitions before it. The totals table has one row per partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.session import settle


def _parts(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def running_totals(df: DataFrame, order_by: list[Column], sums: dict[str, Column] | None = None,
                   position: str = "position") -> DataFrame:
    """Add the 0-based position in the total order and the inclusive running sum
    of each named expression. The order key should be unique."""
    sums = sums or {}
    placed = settle(
        df.select("*", *[c.cast("bigint").alias(f"_v_{n}") for n, c in sums.items()])
        .repartitionByRange(_parts(df), *order_by)
        .withColumn("_part", F.spark_partition_id()),
        "ordered",
    )
    inside = Window.partitionBy("_part").orderBy(*order_by)
    rows = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select(
        "*",
        (F.row_number().over(inside) - 1).cast("bigint").alias("_row"),
        *[F.sum(f"_v_{n}").over(rows).alias(f"_r_{n}") for n in sums],
    )
    # One row per partition: bounded by the partition count.
    totals = placed.groupBy("_part").agg(
        F.count("*").alias("_n"), *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums]
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s_row"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in sums],
    )
    return local.join(F.broadcast(shifts), "_part").select(
        *[F.col(c) for c in df.columns],
        (F.col("_row") + F.col("_s_row")).alias(position),
        *[(F.col(f"_r_{n}") + F.col(f"_s_{n}")).alias(n) for n in sums],
    )


def positions(df: DataFrame, order_by: list[Column], position: str = "position") -> DataFrame:
    """Sequential 0-based numbers along a total order."""
    return running_totals(df, order_by, position=position)


def batches(df: DataFrame, order_by: list[Column], size: int) -> DataFrame:
    """Add `batch`, the number of the group of `size` consecutive rows."""
    numbered = positions(df, order_by, "_pos")
    return numbered.withColumn("batch", F.floor(F.col("_pos") / size).cast("bigint")).drop("_pos")


def top_k(df: DataFrame, order_by: list[Column], k: int) -> DataFrame:
    """First k rows of a total order (per-task heaps, merged)."""
    return df.orderBy(*order_by).limit(k)


def sort_by_field(df: DataFrame, field: str, tie: str | None = None) -> DataFrame:
    """Descending sort by one field."""
    return df.orderBy(F.desc(field), *([F.asc(tie)] if tie else []))

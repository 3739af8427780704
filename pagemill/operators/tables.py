"""Combining and consolidating tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concatenate(*tables: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def merge_schemas(*tables: DataFrame) -> DataFrame:
    """Union of tables with different columns; absent ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def distinct_union(*tables: DataFrame) -> DataFrame:
    return concatenate(*tables).distinct()


def latest_by_key(df: DataFrame, key: str, newest: Column) -> DataFrame:
    """Last write wins per key. A max_by over whole rows: partial aggregation
    leaves one row per key and task, so a hot key does not gather anywhere."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), newest).alias("_last")
    ).select(key, *[F.col(f"_last.`{c}`").alias(c) for c in others])


def consolidate(*tables: DataFrame, key: str = "row_key", newest: str = "fetch_time") -> DataFrame:
    """One table out of several of different age and width, newest row per key;
    on a tie the later table in the argument list wins."""
    ranked = [t.withColumn("_order", F.lit(i)) for i, t in enumerate(tables)]
    merged = merge_schemas(*ranked)
    return latest_by_key(merged, key, F.struct(F.col(newest), F.col("_order"))).drop("_order")


def add_event_info(df: DataFrame, database: str, source: str, event: str) -> DataFrame:
    """Append three constant event columns to an existing table."""
    return df.withColumns({"database": F.lit(database), "source": F.lit(source), "event": F.lit(event)})

"""URL lists, tweet files, word lists, stored fetches and saved tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill import schemas
from pagemill.session import fits


def _line(value):
    return F.trim(F.regexp_replace(value, "[\r\n﻿]", ""))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line; blank lines are dropped."""
    return spark.read.text(path).select(_line(F.col("value")).alias("url")).filter("url <> ''")


def read_tweets_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less tweet file by position, plus `seq`, the file order."""
    raw = spark.read.schema(schemas.TWEETS).csv(path, header=False)
    return raw.select(
        "tweet_id", "collection_id", "collection_name",
        F.regexp_replace("url", "\n", "").alias("url"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("seq"),
    )


def read_fetches(spark: SparkSession, path: str) -> DataFrame:
    """Stored fetch results (or any page table) as parquet."""
    return spark.read.parquet(path)


def read_url_html_csv(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Two unquoted columns, url and html."""
    return (
        spark.read.schema(schemas.URL_HTML).option("quote", "").option("escape", "")
        .option("maxCharsPerColumn", -1).csv(path, header=header)
    )


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Word list, one phrase per line, trimmed, blanks dropped."""
    return spark.read.text(path).select(_line(F.col("value")).alias("word")).filter("word <> ''")


def word_list(words: DataFrame, limit: int = 10_000) -> list[str]:
    """A bounded word table as a Python list, for patterns and literals."""
    rows = words.select("word").distinct().orderBy("word").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} words: pass the table itself to mask_listed or CleanOptions.phrases")
    return [r.word for r in rows]


def collections_table(spark: SparkSession, ids: Mapping[str, str]) -> DataFrame:
    """Collection name to id dimension."""
    return spark.createDataFrame(list(ids.items()), schemas.COLLECTIONS)


def with_collection_id(df: DataFrame, collections: DataFrame, name: str = "collection_name") -> DataFrame:
    """Add collection_id by name; an unknown name gives null."""
    side = collections.select(F.col("collection_name").alias(name), "collection_id")
    return df.join(F.broadcast(side) if fits(side) else side, name, "left")


def select_columns(table: DataFrame, names: list[str]) -> DataFrame:
    """Store scan of `family:qualifier` columns of a nested table."""

    def one(name: str):
        family, qualifier = (part.replace("-", "_") for part in name.split(":"))
        return F.col(f"`{family}`.`{qualifier}`").alias(qualifier)

    return table.select(*[one(n) for n in names])


def scan_where(table: DataFrame, family: str, qualifier: str, value: str) -> DataFrame:
    """Store scan that keeps rows with one cell equal to a value."""
    return table.filter(F.col(f"`{family.replace('-', '_')}`.`{qualifier.replace('-', '_')}`") == value)


def load_model(spark: SparkSession, path: str) -> DataFrame | None:
    """A saved model table, or None when nothing is stored there."""
    try:
        return spark.read.parquet(path)
    except Exception as exc:  # AnalysisException: the path does not exist
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise

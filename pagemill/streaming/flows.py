"""Streaming jobs. Each reuses the batch functions on a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pagemill.plans.clean import CleanOptions, clean_flat
from pagemill.plans.frontier import source_counts
from pagemill.sinks.files import write_tsv


def url_stream(spark: SparkSession, path: str) -> DataFrame:
    """URLs arriving as lines of text files."""
    lines = spark.readStream.text(path)
    return lines.select(F.trim(F.regexp_replace("value", "[\r\n]", "")).alias("url")).filter("url <> ''")


def table_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def clean_stream(fetches: DataFrame, o: CleanOptions = CleanOptions()) -> DataFrame:
    """Record-at-a-time cleaning: the batch plan on a stream, no state. Options
    that look up tables belong in `foreach_clean`, whatever the tables' size."""
    if any(x is not None for x in (o.profiles, o.gazetteer, o.lemmas, o.lexicon)):
        raise ValueError("options with a table need foreach_clean")
    return clean_flat(fetches, o)


def append_stream(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append-only table that survives restarts through its checkpoint."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def foreach_clean(fetches: DataFrame, path: str, checkpoint: str, o: CleanOptions = CleanOptions(), once: bool = False,
                  transform: Callable[[DataFrame, CleanOptions], DataFrame] = clean_flat) -> StreamingQuery:
    """Micro-batches through the full batch plan into delimited files. Every batch
    owns one folder and rewrites it when replayed, so nothing doubles."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_tsv(transform(batch, o), f"{path}/batch={batch_id}", mode="overwrite")

    writer = fetches.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def first_visits(fetches: DataFrame, time_col: str | None = "fetch_time", delay: str = "1 day") -> DataFrame:
    """Each URL once. With a time column the state is bounded by `delay`; without
    one every URL is remembered."""
    if time_col is None:
        return fetches.dropDuplicates(["url"])
    return fetches.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["url"])


def running_source_counts(scored: DataFrame) -> DataFrame:
    """Relevant and other pages per source, updated as pages arrive."""
    return source_counts(scored)


def update_stream(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Changed rows of an aggregate, one folder per micro-batch, with its number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("version", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = df.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()

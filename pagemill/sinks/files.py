"""Delimited, JSON, text and table sinks."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pagemill.functions import text, urls
from pagemill.operators.records import delimited_view, family_tables, flatten_record
from pagemill.sinks.pages import PageFiles
from pagemill.sources.warc import full_path


def write_tsv(records: DataFrame, path: str, mode: str = "append") -> None:
    """Page records as tab-separated text with a header, no quoting. Control
    characters were replaced when the record was made."""
    flat = flatten_record(records) if "webpage" in records.columns else records
    (
        delimited_view(flat).write.mode(mode).option("sep", "\t").option("header", True)
        .option("quote", "").option("escape", "").option("emptyValue", "").csv(path)
    )


def write_family_table(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Keyed table with one nested column per family."""
    records.write.mode(mode).parquet(path)


def write_family_files(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One delimited file set per column family."""
    for family, table in family_tables(records).items():
        write_tsv(table, f"{path}/{family}", mode)


def summary_rows(pages: DataFrame) -> DataFrame:
    """URL, Raw, Text with separators replaced by dots (removed in the URL)."""
    return pages.select(
        text.strip_csv(F.col("url")).alias("URL"), text.clean_csv(F.col("html")).alias("Raw"),
        text.clean_csv(F.col("clean_text")).alias("Text"),
    )


def write_summary_csv(pages: DataFrame, path: str) -> None:
    (
        summary_rows(pages).write.mode("append").option("header", True).option("quote", "").option("escape", "")
        .option("emptyValue", "").csv(path)
    )


def url_html_rows(pages: DataFrame) -> DataFrame:
    """url, html with newline, carriage return and comma deleted from the html."""
    return pages.select(
        F.translate("url", "\n\r", "").alias("url"), text.strip_csv(F.col("html")).alias("html")
    )


def write_url_html_csv(pages: DataFrame, path: str, sep: str = ",") -> None:
    (
        url_html_rows(pages).write.mode("append").option("header", True).option("sep", sep).option("quote", "")
        .option("escape", "").option("emptyValue", "").csv(path)
    )


def write_json(pages: DataFrame, path: str) -> None:
    """JSON lines of the page fields."""
    pages.write.mode("append").json(path)


def page_files(pages: DataFrame) -> DataFrame:
    """(file_name, text); pages whose URL has no scheme are skipped."""
    named = pages.select(urls.file_name(F.col("url")).alias("file_name"), F.replace("clean_text", F.lit("\n"), F.lit(".")).alias("text"))
    return named.filter(F.col("file_name").isNotNull())


def write_page_files(pages: DataFrame, path: str) -> None:
    """One file per page, named after its address; a page whose name is there already
    takes its place. Of pages with the same name the text that sorts first is kept."""
    pages.sparkSession.dataSource.register(PageFiles)
    named = page_files(pages).groupBy("file_name").agg(F.min("text").alias("text"))
    named.write.format("page_files").mode("append").save(full_path(pages.sparkSession, path))


def write_pairs(df: DataFrame, columns: list[str], path: str) -> None:
    """Header-less comma file of some columns: crawl log, output addresses,
    frontier dump, evaluation curve."""
    df.select(*columns).write.mode("overwrite").csv(path)


def save_model(model: DataFrame, path: str) -> None:
    model.write.mode("overwrite").parquet(path)


def run_counters(df: DataFrame, write) -> dict[str, float]:
    """Run `write(df)` and report rows seen and seconds taken. The count rides on
    the write itself; the data is read once."""
    seen = Observation()
    started = time.time()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return {"rows": seen.get["rows"], "seconds": time.time() - started}

"""Fetch classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions.urls import is_image_url


def fetch_status(
    url: Column, status: Column, content_type: Column, error: Column, check_type: bool = True,
    ok: str = fixed.STATUS_OK,
) -> Column:
    """Status code known before any text is extracted: image address, failure,
    HTTP status, content type, in that order."""
    code = F.when(is_image_url(url), F.lit(fixed.STATUS_NOT_HTML)).when(
        error.isNotNull() | status.isNull(), F.lit(fixed.STATUS_FAILED)
    ).when(status != 200, F.concat(F.lit("0"), status.cast("string")))
    if check_type:
        code = code.when(~F.coalesce(content_type, F.lit("")).contains("text/html"), F.lit(fixed.STATUS_NOT_HTML))
    return code.otherwise(F.lit(ok))


def text_status(code: Column, text: Column, empty_text_code: str = fixed.STATUS_EMPTY) -> Column:
    """Add the empty-text rule to a code from `fetch_status`."""
    fine = code.isin(fixed.STATUS_OK, fixed.STATUS_WARC)
    blank = F.trim(F.translate(F.coalesce(text, F.lit("")), "\n\r\t", "   ")) == ""
    return F.when(fine & blank, F.lit(empty_text_code)).otherwise(code)


def error_mime(url: Column, code: Column, content_type: Column) -> Column:
    """Mime column of the record: images by address, nothing for HTTP errors."""
    return (
        F.when(is_image_url(url), F.lit("image/jpg"))
        .when(code.isin(fixed.STATUS_OK, fixed.STATUS_WARC, fixed.STATUS_NOT_HTML, fixed.STATUS_EMPTY),
              F.coalesce(content_type, F.lit("")))
        .otherwise(F.lit(""))
    )


def is_valid(code: Column) -> Column:
    return code.isin(fixed.STATUS_OK, fixed.STATUS_WARC)


def valid_rows(df: DataFrame, code: str = "status_code") -> DataFrame:
    return df.filter(is_valid(F.col(code)))


def failed_rows(df: DataFrame, code: str = "status_code") -> DataFrame:
    return df.filter(~is_valid(F.col(code)))


def count_by_status(df: DataFrame, code: str = "status_code") -> DataFrame:
    return df.groupBy(code).agg(F.count("*").alias("n"))

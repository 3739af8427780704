"""Page record assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill import schemas


def row_key(url: Column, stamp: Column) -> Column:
    return F.concat_ws("-", url, stamp)


def assemble_record(df: DataFrame) -> DataFrame:
    """Flat columns to row_key plus one struct per column family."""
    present = set(df.columns)
    families = [
        F.struct(*[F.col(c) for c in columns if c in present]).alias(family)
        for family, columns in schemas.FAMILIES.items()
    ]
    return df.select("row_key", *families)


def flatten_record(df: DataFrame) -> DataFrame:
    """Nested record back to flat columns in output order."""
    return df.select("row_key", *[f"{family}.*" for family in schemas.FAMILIES if family in df.columns])


def delimited_view(df: DataFrame) -> DataFrame:
    """Flat strings as they go to a delimited file: lists joined, timestamps as
    unix seconds, nulls empty."""
    types = dict(df.dtypes)

    def one(name: str) -> Column:
        c = F.col(name)
        if types[name].startswith("array"):
            c = F.array_join(c, ";" if name in schemas.SEMICOLON_LISTS else ",")
        elif types[name].startswith("timestamp"):
            c = F.unix_timestamp(c)
        return F.coalesce(c.cast("string"), F.lit("")).alias(name)

    return df.select(*[one(c) for c in df.columns])


def family_tables(df: DataFrame) -> dict[str, DataFrame]:
    """One flat table per column family, each with the row key."""
    return {family: df.select("row_key", f"{family}.*") for family in schemas.FAMILIES}

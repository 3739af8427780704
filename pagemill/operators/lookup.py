"""Token lookups: lemmas and part-of-speech tags from user tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from pagemill.session import BROADCAST_ROWS, content_key, fits, settle

# Tags by ending for words outside the lexicon, first match decides.
SUFFIX_TAGS = [
    ("ing", "VBG"), ("ed", "VBD"), ("ly", "RB"), ("ous", "JJ"), ("ful", "JJ"), ("able", "JJ"), ("est", "JJS"),
    ("s", "NNS"),
]
DEFAULT_TAG = "NN"


def _one_per_key(table: DataFrame, key: str, value: str) -> DataFrame:
    return table.groupBy(F.col(key).alias("_key")).agg(F.min(value).alias("_value"))


def lookup_tokens(
    df: DataFrame, id_col: str, tokens_col: str, table: DataFrame, key: str, value: str, out: str,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add array `out`: the table value of each token, null where it has none,
    order kept. A table of at most `limit` rows goes to the tasks as a broadcast
    dictionary and no row moves. A larger one is joined by token, once for every
    distinct token array; rows are matched by that array, not by `id_col`."""
    unique = settle(_one_per_key(table, key, value), "lookup")
    if fits(unique, limit):
        spark = df.sparkSession
        held = spark.sparkContext.broadcast({r["_key"]: r["_value"] for r in unique.toLocalIterator()})

        @F.pandas_udf(ArrayType(StringType()))
        def look(column: pd.Series) -> pd.Series:
            get = held.value.get
            return column.map(lambda t: None if t is None else list(map(get, t)))

        return df.withColumn(out, look(F.col(tokens_col)))
    keyed = df.withColumn("_k", content_key(tokens_col))
    arrays = keyed.select("_k", F.col(tokens_col).alias("_tokens")).dropDuplicates(["_k"])
    found = arrays.select("_k", F.posexplode("_tokens").alias("_pos", "_key")).join(unique, "_key", "left")
    rebuilt = found.groupBy("_k").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_pos", "_value"))), lambda s: s["_value"]
        ).alias(out)
    )
    joined = keyed.join(rebuilt, "_k", "left").drop("_k")
    empty = F.expr("cast(array() as array<string>)")
    return joined.withColumn(
        out, F.when(F.col(tokens_col).isNotNull(), F.coalesce(F.col(out), empty))
    )


def lemmatize(df: DataFrame, id_col: str, tokens_col: str, lemmas: DataFrame, out: str = "lemmatized",
              limit: int = BROADCAST_ROWS) -> DataFrame:
    """Lemma of each token from a (form, lemma) table; a token without an entry
    stays as it is."""
    found = lookup_tokens(df, id_col, tokens_col, lemmas, "form", "lemma", "_found", limit)
    return found.withColumn(
        out, F.zip_with(F.col("_found"), F.col(tokens_col), lambda f, t: F.coalesce(f, t))
    ).drop("_found")


def fallback_tag(token: Column) -> Column:
    rule = F.when(token.rlike(r"^[0-9]+$"), F.lit("CD"))
    for suffix, tag in SUFFIX_TAGS:
        rule = rule.when(token.endswith(suffix), F.lit(tag))
    return rule.otherwise(F.lit(DEFAULT_TAG))


def pos_tags(df: DataFrame, id_col: str, tokens_col: str, lexicon: DataFrame, out: str = "pos",
             limit: int = BROADCAST_ROWS) -> DataFrame:
    """`token:TAG` of each token from a (token, tag) lexicon, else by ending."""
    found = lookup_tokens(df, id_col, tokens_col, lexicon, "token", "tag", "_found", limit)
    return found.withColumn(
        out,
        F.zip_with(
            F.col(tokens_col), F.col("_found"), lambda t, f: F.concat(t, F.lit(":"), F.coalesce(f, fallback_tag(t)))
        ),
    ).drop("_found")

"""Sentences that know abbreviations, learned from the texts themselves.

A word is an abbreviation if a full stop follows it far more often than chance has it,
by the log-likelihood ratio of Kiss and Strunk (2006), scaled for short words, for
full stops inside and against words that also stand without one."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.arrays import let_sql, quoted
from pagemill.session import content_key, fits, settle

# Fixed values of the published method: probability of a full stop behind an
# abbreviation, and the least score of one.
WITH_STOP, THRESHOLD = 0.99, 0.3
TOKEN = r"\p{L}(?:[\p{L}.]*\p{L})?\.?"
LAST = r"(\p{L}(?:[\p{L}.]*\p{L})?)\.$"
# A list of at most this many abbreviations is part of the expression.
LITERAL_WORDS = 5_000


def abbreviations(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(word, n, stops, score): lower-cased words of `text` that count as
    abbreviations, how often they occur and how often with a full stop. Words are
    counted once, in one aggregation. Written."""
    words = docs.select(F.explode(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))).alias("t"))
    counts = settle(
        words.groupBy(F.lower(F.regexp_replace("t", r"\.$", "")).alias("word")).agg(
            F.count("*").alias("n"), F.count_if(F.endswith("t", F.lit("."))).alias("stops")
        ), "word-stops"
    )
    total = counts.agg(F.sum("n").alias("n"), F.sum("stops").alias("stops")).first()
    chance = min(max((total["stops"] or 0) / max(total["n"] or 0, 1), 1e-12), 1 - 1e-12)
    plain = F.col("n") - F.col("stops")
    ratio = F.col("stops") * (math.log(WITH_STOP) - math.log(chance)) + plain * (math.log(1 - WITH_STOP) - math.log(1 - chance))
    letters = F.length(F.replace("word", F.lit("."), F.lit(""))).cast("double")
    inner = F.length("word") - letters
    score = 2 * ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -plain.cast("double"))
    return settle(counts.withColumn("score", score).where((F.col("stops") > 0) & (F.col("score") >= threshold)), "abbreviations")


def _sentences(known: str) -> str:
    """SQL lambda from (text, words) to sentences; `known` says that x is the last
    word of a piece and an abbreviation."""
    return f"""r -> filter(flatten(transform(split(regexp_replace(r.text, {quoted(r'(\p{Ll})\.(\p{Lu})')}, '$1. $2'), '\n'), line ->
      get(transform(array(split(line, {quoted(r'(?<=[.!?])\s+')})), p ->
      get(transform(array(filter(sequence(0, size(p) - 1), i -> i = 0 OR NOT coalesce(get(transform(array(lower(regexp_extract(get(p, i - 1), {quoted(LAST)}, 1))),
        x -> {known}), 0), false))), s ->
        transform(s, (b, j) -> trim(array_join(transform(sequence(b, coalesce(get(s, j + 1), size(p)) - 1), i -> get(p, i)), ' ')))), 0)), 0))),
      x -> size(split(x, {quoted(r'\s+')})) > 3)"""


def learned_sentences(docs: DataFrame, found: DataFrame, text: str = "text", out: str = "sentences", limit: int = LITERAL_WORDS) -> DataFrame:
    """`docs` with `out`, the sentences of more than three words: split after .!? and
    white space and at newlines, but not behind the abbreviations in found(word). A
    short list is part of the expression; a longer one is joined with the last words
    of pieces, once for every different text. Null texts give null."""
    words = found.select("word")
    if fits(words, limit):
        listed = [r["word"] for r in words.collect()]
        known = f"x IN ({', '.join(map(quoted, listed))})" if listed else "false"
        return docs.withColumn(out, let_sql(F.struct(F.col(text).alias("text")), _sentences(known)))
    keyed = docs.withColumn("_k", content_key(text))
    last = F.transform(F.split(text, r"(?<=[.!?])\s+"), lambda p: F.lower(F.regexp_extract(p, LAST, 1)))
    seen = keyed.select("_k", F.explode(F.array_distinct(last)).alias("word")).distinct().join(words, "word")
    of_text = seen.groupBy("_k").agg(F.collect_set("word").alias("_abbr"))
    row: Column = F.struct(F.col(text).alias("text"), F.coalesce("_abbr", F.expr("CAST(array() AS ARRAY<STRING>)")).alias("words"))
    return keyed.join(of_text, "_k", "left").withColumn(out, let_sql(row, _sentences("array_contains(r.words, x)"))).drop("_k", "_abbr")

"""Language detection as a naive Bayes job over character n-grams."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from pagemill.functions.arrays import few_at_once, let_sql, quoted, term_counts
from pagemill.functions.text import words
from pagemill.session import BROADCAST_ROWS, content_key, fits, frequent_join, settle

MAX_GRAM = 3
SMOOTHING = 0.5
WORDS_AT_ONCE = 200_000


def word_grams(word: Column, max_gram: int = MAX_GRAM) -> Column:
    """Character n-grams of one word padded with a space on both sides."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.substr(padded, i, F.lit(n)))

    return F.flatten(F.array(*[of_length(n) for n in range(1, max_gram + 1)]))


@dataclass
class LanguageProfiles:
    """`table` is (gram, logp array in the order of `languages`); `unseen` holds
    the log probability of a gram that a language never showed."""

    table: DataFrame
    languages: list[str]
    unseen: list[float]


def gram_counts(docs: DataFrame, label: str = "lang", text: str = "text", max_gram: int = MAX_GRAM) -> DataFrame:
    """(label, gram, n). Words are counted first, so each distinct word of a
    language is cut into grams once."""
    word_rows = docs.select(label, F.explode(term_counts(F.transform(words(F.col(text)), lambda w: F.lower(w)))).alias("c"))
    per_word = word_rows.groupBy(label, F.col("c.term").alias("word")).agg(F.sum("c.tf").alias("n"))
    return per_word.select(label, F.explode(word_grams(F.col("word"), max_gram)).alias("gram"), "n").groupBy(
        label, "gram"
    ).agg(F.sum("n").alias("n"))


def train_profiles(docs: DataFrame, label: str = "lang", text: str = "text", smoothing: float = SMOOTHING) -> LanguageProfiles:
    """Gram log probabilities per language with additive smoothing."""
    counts = settle(gram_counts(docs, label, text), "grams")
    totals = counts.groupBy(label).agg(F.sum("n").alias("n")).orderBy(label).collect()  # one row per language
    size = counts.select("gram").distinct().count()
    languages = [r[0] for r in totals]
    denominators = [float(r["n"]) + smoothing * size for r in totals]
    wide = counts.groupBy("gram").agg(
        *[F.sum(F.when(F.col(label) == lang, F.col("n")).otherwise(0)).alias(f"_{i}") for i, lang in enumerate(languages)]
    )
    table = settle(
        wide.select(
            "gram",
            F.array(*[F.log((F.col(f"_{i}") + smoothing) / d) for i, d in enumerate(denominators)]).alias("logp"),
        ),
        "profiles",
    )

    return LanguageProfiles(table, languages, [math.log(smoothing / d) for d in denominators])


def _sum_rows(matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive row groups; empty groups give zero."""
    out = np.zeros((len(lengths), matrix.shape[1]))
    full = np.flatnonzero(lengths)
    if len(full):
        out[full] = np.add.reduceat(matrix, (np.cumsum(lengths) - lengths)[full], axis=0)
    return out


def _score_words(docs: list, grams: dict, unseen: list[float]) -> np.ndarray:
    """Score matrix of some word lists: every distinct word is cut once, every
    distinct gram is looked up once."""
    lengths = np.array([len(d) for d in docs])
    flat = np.concatenate([np.asarray(d, dtype=object) for d in docs]) if lengths.sum() else np.array([], dtype=object)
    if not len(flat):
        return np.zeros((len(docs), len(unseen)))
    codes, distinct = pd.factorize(flat)
    cut, sizes = [], []
    for word in distinct:
        padded = f" {word} "
        found = [padded[i:i + n] for n in range(1, MAX_GRAM + 1) for i in range(len(padded) - n + 1)]
        cut += found
        sizes.append(len(found))
    gram_codes, gram_names = pd.factorize(np.array(cut, dtype=object))
    looked_up = np.array([grams.get(g, unseen) for g in gram_names])
    per_word = _sum_rows(looked_up[gram_codes], np.array(sizes))
    return _sum_rows(per_word[codes], lengths)


def _row_scores(docs: DataFrame, profiles: LanguageProfiles, text: str) -> DataFrame:
    """Scores inside the row, a bounded number of words at a time."""
    table = {r["gram"]: list(r["logp"]) for r in profiles.table.toLocalIterator()}
    held = docs.sparkSession.sparkContext.broadcast((table, list(profiles.unseen)))

    @F.arrow_udf(ArrayType(DoubleType()))
    def score(column: pa.Array) -> pa.Array:
        grams, unseen = held.value
        out: list = [None] * len(column)
        waiting: dict[int, np.ndarray] = {}
        held_words = 0

        def flush() -> None:
            nonlocal held_words
            if waiting:
                for at, row in zip(waiting, _score_words(list(waiting.values()), grams, unseen)):
                    out[at] = row
            waiting.clear()
            held_words = 0

        for i, ws in enumerate(few_at_once(column)):
            if ws is not None and len(ws):
                waiting[i] = ws
                held_words += len(ws)
                if held_words >= WORDS_AT_ONCE:
                    flush()
        flush()
        return pa.array(out, pa.list_(pa.float64()))

    low = F.transform(words(F.col(text)), lambda w: F.lower(w))
    return docs.withColumn("_scores", score(low))


def language_scores(docs: DataFrame, profiles: LanguageProfiles, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_grams, scores array) by joins, for profiles of any size: summed log
    probabilities per language. Each distinct word meets the profiles once; its
    scores then join the word counts of the documents, in the tasks for the commonest
    words."""
    low = F.transform(words(F.col(text)), lambda w: F.lower(w))
    counted = settle(docs.select(id_col, term_counts(low).alias("_c")), "word-counts")
    word_rows = counted.select(id_col, F.explode("_c").alias("c")).select(
        id_col, F.col("c.term").alias("word"), F.col("c.tf").alias("tf")
    )
    grams = word_rows.select("word").distinct().select("word", F.explode(term_counts(word_grams(F.col("word")))).alias("g"))
    table = F.broadcast(profiles.table) if fits(profiles.table) else profiles.table
    found = grams.select("word", F.col("g.term").alias("gram"), F.col("g.tf").alias("k")).join(table, "gram", "left")
    n = len(profiles.unseen)
    per_word = settle(found.groupBy("word").agg(
        F.sum("k").alias("grams"),
        *[
            F.sum(F.col("k") * F.coalesce(F.get(F.col("logp"), F.lit(i)), F.lit(u))).alias(f"_{i}")
            for i, u in enumerate(profiles.unseen)
        ],
    ), "word-scores")
    sums = [F.sum(F.col("tf") * F.col(f"_{i}")) for i in range(n)]
    return frequent_join(word_rows, per_word, "word").groupBy(id_col).agg(
        F.sum(F.col("tf") * F.col("grams")).alias("n_grams"), F.array(*sums).alias("scores")
    )


def detect_language(docs: DataFrame, profiles: LanguageProfiles, id_col: str = "doc_id", text: str = "text",
                    min_probability: float = 0.1, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Add `languages`, array<struct<prob, lang>> with the likeliest first, for
    every document; empty when the text has no words. With profiles of at most
    `limit` grams the rows stay in place, otherwise the scores come from a join, once
    for every distinct text; rows are matched by the text, not by `id_col`."""
    if fits(profiles.table, limit):
        scored = _row_scores(docs, profiles, text)
    else:
        keyed = docs.withColumn("_k", content_key(text))
        texts = keyed.select("_k", F.col(text).alias("_text")).dropDuplicates(["_k"])
        side = language_scores(texts, profiles, "_k", "_text").select("_k", F.col("scores").alias("_scores"))
        scored = keyed.join(side, "_k", "left").drop("_k")
    names = "array(" + ", ".join(quoted(x) for x in profiles.languages) + ")"
    ranked = let_sql(
        F.col("_scores"),
        f"""s -> get(transform(array(transform(s, x -> exp(x - array_max(s)))),
          w -> filter(sort_array(zip_with(w, {names}, (v, n) -> named_struct('prob', v / aggregate(w, 0D, (a, x) -> a + x), 'lang', n)), false),
            p -> p.prob >= {min_probability!r}D)), 0)""",
    )
    empty = F.expr("cast(array() as array<struct<prob:double,lang:string>>)")
    return scored.withColumn("languages", F.coalesce(ranked, empty)).drop("_scores")


def language_codes(languages: Column) -> Column:
    return F.transform(languages, lambda s: s["lang"])


def language_pairs(languages: Column) -> Column:
    """`lang:prob` strings, the older column form."""
    return F.transform(languages, lambda s: F.concat(s["lang"], F.lit(":"), s["prob"].cast("string")))

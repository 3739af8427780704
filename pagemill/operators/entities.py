"""Entities: gazetteer tagging and phrase merging."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from pagemill.functions.arrays import few_at_once, let_sql, quoted, runs
from pagemill.functions.text import words
from pagemill.operators.phrases import entry_part, listed_grams
from pagemill.session import BROADCAST_ROWS, fits, numbered, settle

# A gazetteer of at most this many phrases is held as a literal inside the plan.
LITERAL_PHRASES = 5_000

# A gazetteer that is joined is joined in at most so many rounds.
ROUNDS = 8

# Date expressions counted as DATE entities.
DATE_ENTITY_PATTERN = (
    r"(?i)\b(?:(?:january|february|march|april|may|june|july|august|september|october|november|december)"
    r"(?: [0-9]{1,2})?(?:,? (?:19|20)[0-9]{2})?|(?:19|20)[0-9]{2}(?:-[0-9]{2}-[0-9]{2})?)\b"
)


def _listed_grams(tokens: Column, phrases: list[str], max_words: int) -> Column:
    """The n-grams that are listed phrases. N-grams are built only where a token
    is the first word of a phrase."""
    if not phrases:
        phrases = [""]
    firsts = ", ".join(sorted({quoted(p.split(" ")[0]) for p in phrases}))
    grams = ", ".join(
        f"named_struct('start', i, 'words', {n}, 'phrase', lower(concat_ws(' ', "
        + ", ".join(f"get(t, i + {k})" for k in range(n)) + ")))"
        for n in range(1, max_words + 1)
    )
    return let_sql(
        tokens,
        f"""t -> CASE WHEN size(t) > 0 THEN filter(flatten(transform(
              filter(sequence(0, size(t) - 1), i -> lower(get(t, i)) IN ({firsts})),
              i -> filter(array({grams}), g -> g.start + g.words <= size(t)))),
            g -> g.phrase IN ({', '.join(quoted(p) for p in phrases)}))
          ELSE cast(array() AS array<struct<start:int,words:int,phrase:string>>) END""",
    )


def _entries(gazetteer: DataFrame, cut: Callable[[Column], Column] | None) -> DataFrame:
    """(phrase, units, type) and, for `listed_grams`, `_words` and `_part`. Phrases become the tokens
    that `cut` makes of them, as the text did, joined by spaces; a phrase without tokens
    is left out. Written once, as it comes: a phrase may come several times. Units that
    the phrase itself tells are not written beside it."""
    units = F.transform((cut or words)(F.col("phrase")), F.lower)
    # A generator: a filter on its rows is not pushed into the cutting, which runs once.
    some = F.explode(F.filter(F.array(units), lambda u: F.size(u) > 0))
    named = gazetteer.select(some.alias("units"), "type").select(F.array_join("units", " ").alias("phrase"), "units", "type")
    told = F.split("phrase", " ")
    rows = named.where("phrase <> ''").select(
        "phrase", F.when(F.size(told) != F.size("units"), F.col("units")).alias("_units"), "type",
        F.size("units").alias("_words"), entry_part("units").alias("_part"),
    )
    return settle(rows, "gazetteer", lean=True).select("phrase", F.coalesce("_units", told).alias("units"), "type", "_words", "_part")


def _short_list(entries: DataFrame, limit: int) -> DataFrame | None:
    """The entries, one row each, if `limit` and their bytes let the tasks hold them."""
    if entries.agg(F.approx_count_distinct("phrase")).first()[0] > 2 * limit:
        return None
    named = settle(entries.groupBy("phrase", "units").agg(F.min("type").alias("type")), "gazetteer")
    return named if fits(named, limit) else None


def _kept_low(df: DataFrame, tokens_col: str) -> Column:
    """The tokens of a written table in lower case, as they stand where they are."""
    other = df.where(F.exists(tokens_col, lambda t: t != F.lower(t))).limit(1)
    return F.transform(tokens_col, F.lower) if other.count() else F.col(tokens_col)


class _Index:
    """A gazetteer inside a task: the lengths of phrases by their first word, and
    the type of each phrase."""

    def __init__(self, entries: DataFrame):
        self.types: dict[str, str] = {}
        sizes: dict[str, set[int]] = {}
        for r in entries.toLocalIterator():
            self.types[r["phrase"]] = r["type"]
            sizes.setdefault(r["units"][0], set()).add(len(r["units"]))
        self.sizes = {head: tuple(sorted(found)) for head, found in sizes.items()}

    def hits(self, low) -> list[tuple[int, int, str, str]]:
        """(start, words, phrase, type) in lower-cased tokens."""
        low = list(low)
        found = []
        for start, head in enumerate(low):
            for n in self.sizes.get(head, ()):
                phrase = " ".join(low[start:start + n]) if start + n <= len(low) else None
                if phrase in self.types:
                    found.append((start, n, phrase, self.types[phrase]))
        return found

    def tags(self, low) -> list[str]:
        """Tags of one token array, by the rule of `tag_tokens`."""
        best: list[tuple | None] = [None] * len(low)
        for start, n, _, kind in self.hits(low):
            rank = (n, -start, kind)
            for at in range(start, start + n):
                if best[at] is None or rank > best[at]:
                    best[at] = rank
        return ["O" if b is None else b[2] for b in best]


HITS = "array<struct<start:int,words:int,phrase:string,type:string>>"


def match_phrases(
    df: DataFrame, id_col: str, tokens_col: str, gazetteer: DataFrame, limit: int = BROADCAST_ROWS,
    cut: Callable[[Column], Column] | None = None, row_col: str | None = None,
) -> DataFrame:
    """Gazetteer hits (id, start, words, phrase, type), phrases of any length. A
    short gazetteer is part of the expression, a larger one goes to the tasks while
    its size allows: only hits leave the row. Beyond that it is joined, by the first
    words of every place. `cut` is the token function the text went through.
    `row_col` says that `df` is a written table and which column numbers its rows; then
    it is not written again."""
    entries = _entries(gazetteer, cut)
    short = _short_list(entries, limit)
    lowered = F.transform(tokens_col, F.lower)
    if short is not None and fits(short, min(LITERAL_PHRASES, limit)):
        listed = [(r["phrase"], len(r["units"])) for r in short.select("phrase", "units").collect()]
        hits = _listed_grams(F.col(tokens_col), [p for p, _ in listed], max((n for _, n in listed), default=1))
        grams = df.select(id_col, F.explode(hits).alias("g")).select(id_col, "g.*")
        return grams.join(F.broadcast(short), "phrase").select(id_col, "start", "words", "phrase", "type")
    if short is not None:
        held = df.sparkSession.sparkContext.broadcast(_Index(short))

        @F.arrow_udf(HITS)
        def find(column: pa.Array) -> pa.Array:
            ends, found = [0], []
            for t in few_at_once(column):
                found += [] if t is None else held.value.hits(t)
                ends.append(len(found))
            types = (pa.int32(), pa.int32(), pa.string(), pa.string())
            hits = [pa.array([h[k] for h in found], kind) for k, kind in enumerate(types)]
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(hits, ["start", "words", "phrase", "type"]))

        return df.select(id_col, F.explode(find(lowered)).alias("h")).select(id_col, "h.*")
    if row_col:
        keyed = df.select(id_col, F.col(row_col).alias("_row"), _kept_low(df, tokens_col).alias("_low"))
    else:
        keyed = numbered(df.select(id_col, lowered.alias("_low")), "gazetteer-rows", lean=True)
    typed = listed_grams(keyed.select("_row", "_low"), "_row", "_low", entries, " ", slices=ROUNDS)
    # Phrases are made of the row again: a caller without use for them moves no tokens.
    phrase = F.array_join(F.slice("_low", F.col("start") + 1, F.col("words")), " ")
    return typed.join(keyed, "_row").select(id_col, "start", "words", phrase.alias("phrase"), "type")


def tag_tokens(hits: DataFrame, id_col: str) -> DataFrame:
    """Tag of every covered token (id, pos, tag): the longest hit that covers it,
    the earliest on a tie."""
    covered = hits.select(
        id_col, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("words") - 1)).alias("pos"),
        F.struct("words", (-F.col("start")).alias("early"), "type").alias("rank"),
    )
    return covered.groupBy(id_col, "pos").agg(F.max("rank").alias("rank")).select(
        id_col, "pos", F.col("rank.type").alias("tag")
    )


def tag_arrays(df: DataFrame, id_col: str, tokens_col: str, gazetteer: DataFrame, out: str = "tags",
               limit: int = BROADCAST_ROWS, cut: Callable[[Column], Column] | None = None, row_col: str | None = None) -> DataFrame:
    """Add one tag per token (`O` outside entities). With a gazetteer of at most
    `limit` phrases the rows stay in place; with a larger one the hits are found
    by joins and matched by a number that every row gets, not by `id_col`. A written
    table whose rows `row_col` numbers is not written again."""
    entries = _entries(gazetteer, cut)
    short = _short_list(entries, limit)
    if short is not None:
        held = df.sparkSession.sparkContext.broadcast(_Index(short))

        @F.arrow_udf(ArrayType(StringType()))
        def tag(column: pa.Array) -> pa.Array:
            return pa.array((None if t is None else held.value.tags(t) for t in few_at_once(column)), pa.list_(pa.string()))

        return df.withColumn(out, tag(F.transform(tokens_col, F.lower)))
    keyed = df.withColumn("_row", F.col(row_col)) if row_col else numbered(df, "tag-rows", lean=True)
    low = _kept_low(keyed, tokens_col)
    arrays = keyed.where(F.size(tokens_col) > 0).select("_row", low.alias("_low"))
    # Dealt by row first: hits come in the order of their phrases, so tasks have little to put together before.
    hits = listed_grams(arrays, "_row", "_low", entries, " ", slices=ROUNDS).repartition("_row").groupBy("_row").agg(
        F.collect_list(F.struct("start", "words", "type")).alias("_hits")
    )

    @F.arrow_udf(ArrayType(StringType()))
    def paint(sizes: pa.Array, found: pa.Array) -> pa.Array:
        pairs = zip(few_at_once(sizes), few_at_once(found), strict=True)
        return pa.array((None if n < 0 else best_tags(n, h) for n, h in pairs), pa.list_(pa.string()))

    sized = keyed.withColumn("_size", F.coalesce(F.size(F.col(tokens_col)), F.lit(-1)))
    found = sized.join(hits.withColumnRenamed("_row", "_at"), F.col("_row") == F.col("_at"), "left")
    tagged = found.withColumn(out, paint(F.col("_size"), F.col("_hits"))).drop("_hits", "_size", "_at")
    return tagged if row_col == "_row" else tagged.drop("_row")


def best_tags(size: int, hits) -> list[str]:
    """Tags of `size` tokens from their hits (start, words, type), by the rule of
    `tag_tokens`: the best hit is written last."""
    tags = ["O"] * size
    if hits is not None:
        for n, early, kind in sorted((h["words"], -h["start"], h["type"]) for h in hits):
            tags[-early:n - early] = [kind] * n
    return tags


def tokens_with_tag(tokens: Column, tags: Column, wanted: str) -> Column:
    """Tokens that carry one tag, in order."""
    return F.transform(
        F.filter(F.arrays_zip(tokens.alias("t"), tags.alias("g")), lambda z: z["g"] == wanted), lambda z: z["t"]
    )


def merge_phrases(tokens: Column, tags: Column, wanted: str) -> Column:
    """Neighbouring tokens with the same tag joined by a space."""
    kept = F.filter(runs(tags), lambda r: F.get(tags, r["start"]) == wanted)
    return F.transform(
        kept,
        lambda r: F.array_join(
            F.transform(F.sequence(r["start"], r["start"] + r["len"] - 1), lambda i: F.get(tokens, i)), " "
        ),
    )


def merge_tagged_rows(tagged: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Phrase merge for exploded (id, pos, token, tag) rows: gaps and islands
    inside one document, one output row per phrase. A gap in `pos` also ends a
    phrase, so rows tagged `O` may be left out."""
    inside = Window.partitionBy(id_col).orderBy("pos")
    marked = tagged.withColumn(
        "_new",
        (
            ~F.col("tag").eqNullSafe(F.lag("tag").over(inside))
            | ~F.col("pos").eqNullSafe(F.lag("pos").over(inside) + 1)
        ).cast("int"),
    )
    islands = marked.withColumn("_island", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        islands.filter("tag <> 'O'").groupBy(id_col, "_island", "tag").agg(
            F.min("pos").alias("start"),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda s: s["token"]), " "
            ).alias("phrase"),
        ).drop("_island")
    )


def date_entities(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(DATE_ENTITY_PATTERN), F.lit(0))

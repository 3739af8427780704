"""Phrase lists of any length over arrays: which entries stand where, and masking.

An entry is a sequence of units. Only places whose unit begins an entry are looked
at, and only with the lengths that entries with that first unit have."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pagemill import fixed
from pagemill.functions.arrays import few_at_once, let_sql
from pagemill.functions.text import mask_phrases
from pagemill.session import BROADCAST_ROWS, discard, fits, numbered, settle

# A list of at most this many phrases becomes one pattern.
PATTERN_PHRASES = 1_000
# A list within these bounds, measured, goes to the tasks as a trie.
TRIE_PHRASES = 200_000
TRIE_BYTES = 8 << 20
# Units of a place that are compared before longer entries are built there.
HEAD_UNITS = 3
# Entries and places are dealt to so many parts; a round takes in every second part or
# fewer, if there are more places than this.
PARTS = 64
ROUND_PLACES = 1_000_000
# First units of one character, if at most this many, are told apart in the row.
SINGLE_HEADS = 2_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
UNIT = "[a-z0-9]+|[^a-z0-9]"  # of a text with A-Z lower-cased


def heads(entries: DataFrame) -> DataFrame:
    """entries(phrase, units) to (head, sizes): the first unit and the lengths of the
    entries that begin with it. Written."""
    return settle(
        entries.groupBy(F.get("units", F.lit(0)).alias("head")).agg(F.sort_array(F.collect_set(F.size("units"))).alias("sizes")), "phrase-heads"
    )


def part_of(words: Column, first: Column, second: Column) -> Column:
    """0 to PARTS - 1, the same for an entry of one unit (`words` 1) or more and for every
    place where it stands. It depends on the first unit and the length of the second, so
    that a frequent first unit is not in one part."""
    return F.pmod(F.xxhash64(first, F.when(words > 1, F.octet_length(second))), F.lit(PARTS)).cast("int")


def entry_part(units: str) -> Column:
    """`_part` of an entry."""
    return part_of(F.size(units), F.get(units, F.lit(0)), F.get(units, F.lit(1)))


def _places(arrays: DataFrame, key: str, units: str, entries: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, start, words, u0, u1, ...): every place that may begin an entry, with its
    first units, once for each of `lengths` that entries have there."""
    size = F.size(units)
    at = F.when(size > 0, F.sequence(F.lit(0), size - 1))
    spots = arrays.select(key, units, F.explode_outer(at).alias("start")).select(
        key, "start", *[F.get(units, F.col("start") + k).alias(f"u{k}") for k in range(HEAD_UNITS)]
    ).where("u0 IS NOT NULL")
    first = F.get("units", F.lit(0))
    few = entries.agg(F.approx_count_distinct(first)).first()[0] <= 1.25 * BROADCAST_ROWS
    firsts = heads(entries) if few else None
    if few and fits(firsts):
        short = F.array_distinct(F.transform("sizes", lambda n: F.least(n, F.lit(HEAD_UNITS))))
        known = F.broadcast(firsts.select(F.col("head").alias("u0"), short.alias("n")))
        return spots.join(known, "u0").select("*", F.explode("n").alias("words")).drop("n")
    single = entries.select(first.alias("u0")).where("char_length(u0) = 1").distinct().limit(SINGLE_HEADS + 1).collect()
    if len(single) <= SINGLE_HEADS:
        spots = spots.where((F.char_length("u0") > 1) | F.col("u0").isin([r["u0"] for r in single]))
    return spots.withColumn("words", F.lit(lengths[0]) if len(lengths) == 1 else F.explode(F.array(*map(F.lit, lengths))))


def listed_grams(
    arrays: DataFrame, key: str, units: str, entries: DataFrame, glue: str, slices: int = 1, unique: bool = False
) -> DataFrame:
    """(key, start, words) of the entries that stand in `units` and the columns of
    the entry other than its units, by joins; for lists too long for a task. Written.
    `key` is unique; of entries that come several times (unless `unique`) the least of
    every other column counts. A place is compared by its own first units, up to
    HEAD_UNITS of them: they are the whole of a short entry and the head of a longer
    one. Only where such a head stands the n-grams of its lengths are built, in the
    row, and compared. Where the first units of all entries fit a task, other places
    are left out before anything moves. Frequent heads are skew that the adaptive join
    splits.

    Places take several times the room of the text. In up to `slices` rounds those of
    some parts (`part_of`) are compared with the entries of these parts: every place in
    one round, and only what a round moves is on the disks at one time."""
    size = F.col("_words") if "_words" in entries.columns else F.size("units")
    kept = [c for c in entries.columns if c not in ("phrase", "units", "_part", "_words")]
    span = F.least(size, F.lit(HEAD_UNITS))
    found = entries.agg(F.collect_set(span).alias("n"), F.coalesce(F.max(size), F.lit(0)).alias("most")).first()
    lengths, longer = sorted(found["n"]) or [1], found["most"] > HEAD_UNITS
    if "_part" not in entries.columns and slices > 1:
        entries = entries.withColumn("_part", entry_part("units"))
    total = arrays.agg(F.sum(F.greatest(F.size(units), F.lit(0)))).first()[0] if slices > 1 else 0
    rounds = 1
    while 2 * rounds <= min(slices, PARTS) and (total or 0) > rounds * ROUND_PLACES:
        rounds *= 2
    spots = _places(arrays, key, units, entries, lengths)
    firsts = [F.col(f"u{k}") for k in range(HEAD_UNITS)]
    gram = F.when(F.col("words") == 1, firsts[0])
    for n in range(2, HEAD_UNITS + 1):
        parts = [x for u in firsts[:n] for x in (F.lit(glue), u)][1:] if glue else firsts[:n]
        gram = gram.when(F.col("words") == n, F.concat(*parts))  # array_join would leave nulls out: a place needs all its units
    none = F.lit(None).cast("array<int>").alias("sizes")
    hits = []
    for k in range(rounds):
        some, here = entries, spots
        if rounds > 1:
            some = entries.where(F.col("_part") % rounds == k)
            here = spots.where(part_of(F.col("words"), *firsts[:2]) % rounds == k)
        targets = some.where(size <= HEAD_UNITS).select("phrase", size.alias("words"), *kept)
        if not unique:
            targets = _least(targets, kept)
        if longer:
            head = F.array_join(F.slice("units", 1, HEAD_UNITS), glue).alias("phrase")
            begins = some.where(size > HEAD_UNITS).groupBy(head, F.lit(HEAD_UNITS).alias("words")).agg(
                F.sort_array(F.collect_set(size)).alias("sizes")
            )
            targets = targets.withColumn("sizes", none).unionByName(begins, allowMissingColumns=True)
        whole = unique and not longer
        targets = targets if whole else settle(targets, "phrase-targets", lean=True)
        placed = here.select(key, "start", "words", gram.alias("phrase")).join(targets, ["phrase", "words"])
        hits.append(settle(placed.drop("phrase"), "phrase-hits", lean=True))
        if not whole:
            discard(targets)
    hits = reduce(DataFrame.unionByName, hits)
    if not longer:
        return hits
    grams = let_sql(
        F.struct(F.col(units).alias("u"), F.col("_spots").alias("s")),
        f"""r -> flatten(transform(r.s, p -> transform(filter(p.sizes, n -> p.pos + n <= size(r.u)), n ->
          named_struct('start', p.pos, 'words', n, 'phrase', array_join(transform(sequence(p.pos, p.pos + n - 1), i -> get(r.u, i)), '{glue}')))))""",
    )
    long = settle(_least(entries.where(size > HEAD_UNITS).select("phrase", size.alias("words"), *kept), kept), "phrase-targets", lean=True)
    # Rows move here with all their units, some of the rows in a round.
    turns = max(1, rounds // 2)
    whole = []
    for k in range(turns):
        turn = F.pmod(F.xxhash64(key), F.lit(turns)) == k if turns > 1 else F.lit(True)
        per_row = hits.where("sizes IS NOT NULL").where(turn).groupBy(key).agg(
            F.collect_list(F.struct(F.col("start").alias("pos"), "sizes")).alias("_spots")
        )
        built = arrays.where(turn).join(per_row, key).select(key, F.explode(grams).alias("g")).select(key, "g.*")
        whole.append(settle(built.join(long, ["phrase", "words"]).select(key, "start", "words", *kept), "phrase-hits", lean=True))
    discard(long)
    return reduce(DataFrame.unionByName, whole, hits.where("sizes IS NULL").drop("sizes"))


def _least(entries: DataFrame, kept: list[str]) -> DataFrame:
    """(phrase, words, kept...), one row each, with the least of every kept column."""
    named = entries.groupBy("phrase", "words")
    return named.agg(*[F.min(c).alias(c) for c in kept]) if kept else named.count().drop("count")


# ---- masking ----------------------------------------------------------------------------


def low(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def units_of(text: Column) -> Column:
    """Runs of a-z and digits, and every other character for itself."""
    return F.regexp_extract_all(low(text), F.lit(UNIT), F.lit(0))


def build_trie(entries: Iterable[Sequence[str]]) -> dict:
    """Nested dictionaries by unit; the key None marks the end of an entry."""
    root: dict = {}
    for units in entries:
        node = root
        for unit in units:
            node = node.setdefault(unit, {})
        node[None] = True
    return root


_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def may_start(units: Sequence[str], at: int) -> bool:
    return at == 0 or not (units[at - 1][-1] in _WORD or units[at - 1] in "-.")


def may_end(units: Sequence[str], end: int) -> bool:
    return end == len(units) or not (units[end][0] in _WORD or units[end] == "_")


def split_units(text: str) -> tuple[list[str], list[str]]:
    """(units as they stand, lower-cased)."""
    own = re.findall("[A-Za-z0-9]+|[^A-Za-z0-9]", text)
    return own, [u.lower() if u.isascii() else u for u in own]


def mask_by_trie(text: str | None, trie: dict) -> str | None:
    """`text` with listed phrases masked, from left to right, the longest at a place."""
    if text is None:
        return None
    own, units = split_units(text)
    out, at = [], 0
    while at < len(units):
        end, node, i = 0, trie.get(units[at]), at + 1
        if node is not None and may_start(units, at):
            while node is not None:
                if None in node and may_end(units, i):
                    end = i
                node = node.get(units[i]) if i < len(units) else None
                i += 1
        out.append(fixed.MASK_TEXT if end else own[at])
        at = end or at + 1
    return "".join(out)


def mask_places(text: str | None, hits) -> str | None:
    """`text` with the units of `hits` [(start, words)] masked, by the same rule."""
    if text is None or hits is None:
        return text
    own, units = split_units(text)
    out, at = [], 0
    for start, negative in sorted((h["start"], -h["words"]) for h in hits):
        end = start - negative
        if start >= at and may_start(units, start) and may_end(units, end):
            out += own[at:start] + [fixed.MASK_TEXT]
            at = end
    return "".join(out + own[at:])


def mask_listed(
    df: DataFrame, text_col: str, words: DataFrame, out: str = "masked", pattern: int = PATTERN_PHRASES, trie: int = TRIE_PHRASES
) -> DataFrame:
    """`df` with `out`, the text with the phrases of words(word), any number of them,
    masked: from left to right, the longest at a place, between the borders that
    mask_phrases names; A-Z and a-z are the same. Blank and null phrases are left
    out, null texts stay null.

    Up to `pattern` phrases are one regular expression. Up to `trie` phrases of
    TRIE_BYTES are a trie in every task; rows do not move in either case. Longer
    lists are joined: narrow rows of places move, and every text once."""
    entries = settle(
        words.select(low(F.regexp_replace("word", r"^\s+|\s+$", "")).alias("phrase")).where("phrase <> ''").distinct()
        .withColumn("units", units_of(F.col("phrase"))), "mask-list"
    )
    if fits(entries, pattern):
        listed = sorted((r["phrase"] for r in entries.select("phrase").collect()), key=lambda p: (-len(p), p))
        return df.withColumn(out, mask_phrases(F.col(text_col), listed))
    if fits(entries, trie, TRIE_BYTES):
        held = df.sparkSession.sparkContext.broadcast(build_trie(r["units"] for r in entries.select("units").toLocalIterator()))

        @F.pandas_udf(StringType())
        def mask(column: pd.Series) -> pd.Series:
            root = held.value
            return column.map(lambda t: mask_by_trie(t, root))

        return df.withColumn(out, mask(F.col(text_col)))
    keyed = numbered(df, "mask-rows")
    arrays = keyed.where(F.col(text_col).isNotNull()).select("_row", units_of(F.col(text_col)).alias("_units"))
    hits = listed_grams(arrays, "_row", "_units", entries, "", unique=True)
    per_text = hits.groupBy("_row").agg(F.collect_list(F.struct("start", "words")).alias("_hits"))

    @F.arrow_udf(StringType())
    def place(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array((mask_places(t, h) for t, h in zip(few_at_once(texts), few_at_once(found), strict=True)), pa.string())

    return keyed.join(per_text, "_row", "left").withColumn(out, place(F.col(text_col), F.col("_hits"))).drop("_row", "_hits")

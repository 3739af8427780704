"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of WINDOW words (a shorter item is one window) and a
window into shingles of SHINGLE words. Shingles are ordered by how often they
occur in the documents. A window can only occur where its rarest shingle does, so
that one (the prefix for full containment) is joined; offsets bound where the
window would start and end; the shingles around the place decide whether the
window is really there, word by word.

Built-in functions only. The text is read once: each document gives the shingles
that some window has, with their places, and one row for itself."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import ascii_lower, maybe_broadcast, text_key
from pagemill.session import settle

WINDOW = 13
SHINGLE = 3
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lowered; none for null."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1), lambda w: w != "")


def shingles(column: str, n: str, size: int) -> Column:
    """All runs of `size` words of the array `column`, which has `n` words."""
    picked = ", ".join(f"{column}[i + {j}]" for j in range(size))
    return F.expr(
        f"IF({n} >= {size}, transform(sequence(0, {n} - {size}), i -> concat_ws(' ', {picked})), "
        "CAST(array() AS ARRAY<STRING>))"
    )


@dataclass(frozen=True)
class Windows:
    """windows(win, size, k, grams): distinct windows, words per shingle, words,
    shingles in order. owners(win, items): the items that have them."""

    windows: DataFrame
    owners: DataFrame
    sizes: list[int]


def item_windows(items: DataFrame) -> Windows:
    """items(item_id, text). Items without words have no window; repeated items
    and equal windows count once."""
    cut = items.select("item_id", words(F.col("text")).alias("words")).withColumn("n", F.size("words")).where("n > 0")
    cut = cut.select(
        "item_id", F.explode(F.expr(
            f"transform(sequence(0, greatest(n - {WINDOW}, 0)), s -> slice(words, s + 1, {WINDOW}))"
        )).alias("w"),
    ).withColumn("win", F.array_join("w", " "))
    owners = settle(cut.groupBy("win").agg(F.collect_set("item_id").alias("items"), F.first("w").alias("w")), "owners")
    windows = owners.select("win", "w", F.size("w").alias("k")).withColumn("size", F.least("k", F.lit(SHINGLE)))
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most SHINGLE values
    grams = F.lit(None).cast("array<string>")
    for size in sizes:
        grams = F.when(F.col("size") == size, shingles("w", "k", size)).otherwise(grams)
    return Windows(windows.select("win", "size", "k", grams.alias("grams")), owners.select("win", "items"), sizes)


def document_grams(docs: DataFrame, found: Windows) -> DataFrame:
    """docs(key, doc_id, text) to (key, doc_id, n_words, pos, size, gram): places
    of shingles that some window has, and one row with pos -1 for the document."""
    known = settle(
        found.windows.select("size", F.explode("grams").alias("gram")).distinct(), "known-grams"
    )
    own = docs.sparkSession.range(1).select(F.lit(0).alias("size"), F.lit("").alias("gram"))
    known = maybe_broadcast(settle(known.union(own), "known-grams-own"))
    split = docs.select("key", "doc_id", words(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    places = split.select(
        "key", "doc_id", "n_words",
        F.explode(F.array(
            F.struct(F.lit(0).alias("size"), F.array(F.lit("")).alias("grams")),
            *[F.struct(F.lit(s).alias("size"), shingles("words", "n_words", s).alias("grams")) for s in found.sizes],
        )).alias("part"),
    ).select("key", "doc_id", "n_words", F.col("part.size").alias("size"), F.posexplode("part.grams").alias("pos", "gram"))
    return settle(places.join(known, ["size", "gram"]), "document-grams")


def rarest(found: Windows, grams: DataFrame) -> DataFrame:
    """windows with their prefix: the shingle with the fewest places in the
    documents (then the smaller, then the earlier one) and its offset. Windows
    with a shingle that no document has cannot occur and are left out."""
    counts = grams.where("pos >= 0 AND size > 0").groupBy("size", "gram").agg(F.count("*").alias("places"))
    each = found.windows.select("win", "size", F.posexplode("grams").alias("off", "gram"))
    best = (
        each.join(counts, ["size", "gram"], "left").groupBy("win")
        .agg(F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "gram", "off")).alias("best"))
    )
    return found.windows.join(best.where("best.places > 0"), "win").select(
        "win", "size", "k", "grams", F.col("best.gram").alias("gram"), F.col("best.off").alias("off")
    )


def occurrences(found: Windows, grams: DataFrame) -> DataFrame:
    """(key, start, k, win): every place where a window occurs."""
    prefixes = maybe_broadcast(settle(rarest(found, grams), "prefixes"))
    reach = WINDOW - 1
    near = Window.partitionBy("key", "size").orderBy("pos").rowsBetween(-reach, reach)
    placed = grams.where("pos >= 0 AND size > 0").select("key", "n_words", "size", "pos", "gram").distinct()
    placed = placed.withColumn("near", F.collect_list(F.struct("pos", "gram")).over(near))
    candidates = placed.join(prefixes, ["size", "gram"]).withColumn("start", F.expr("pos - off"))
    candidates = candidates.where("start >= 0 AND start + k <= n_words")
    return candidates.where(F.expr(
        "transform(filter(near, p -> p.pos >= start AND p.pos <= start + k - size), p -> p.gram) = grams"
    )).select("key", "start", "k", "win")


def find_contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: (key, doc_id, n_words, n_hit, items, contaminated)
    with `items` the sorted ids (as text) of items that have a window in the text.
    `key` is row_key(doc_id, text); rows that agree in both have equal results.

    Null or empty texts have no words and are clean; without items all are clean;
    an item without id is looked for but not listed. Work on one document stays
    with its key, however often a passage occurs elsewhere."""
    rows = docs.select(
        row_key(docs, doc_id, text).alias("key"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    found = item_windows(items)
    grams = document_grams(rows, found)
    places = settle(occurrences(found, grams), "window-places")
    hit = places.groupBy("key").agg(F.size(F.array_distinct(F.flatten(F.collect_set(
        F.expr("sequence(start, start + k - 1)")
    )))).cast("long").alias("n_hit"))
    owners = maybe_broadcast(settle(found.owners, "window-owners"))
    listed = places.select("key", "win").distinct().join(owners, "win").groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.expr("transform(items, x -> CAST(x AS STRING))"))))).alias("items")
    )
    own = grams.where("size = 0").select("key", "doc_id", F.col("n_words").cast("long").alias("n_words"))
    joined = own.join(hit.join(listed, "key"), "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "key", "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def row_key(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Column:
    return text_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs`, all columns, without contaminated rows."""
    bad = find_contamination(docs, items, doc_id, text).where("contaminated").select(F.col("key").alias("__key")).distinct()
    return docs.withColumn("__key", row_key(docs, doc_id, text)).join(bad, "__key", "left_anti").drop("__key")

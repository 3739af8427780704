"""Near duplicates from bottom-k sketches.

Texts with the same words are one class. Of each class's set of word shingles
the SKETCH lowest values of one hash function are retained. Inverted lists of
retained values generate pairs with their overlaps, the sketch of the union
estimates their similarity, and the full sets confirm it.

A value on more than LONG_LIST sketches is no basis for pairs of all its holders.
* A class whose sketch is at least half rare values is compared through those: a
  partner at the threshold shares many of them (all sketch values of a small set
  are retained, so there it is certain; else a miss needs 16 independent values to
  fail together).
* The others ("common" classes: large groups of near copies) are first compared
  with the hub of each of their long lists only, the member with the fewest
  shingles of its own. What is not joined with a hub that way needs a partner that
  holds one of its rarest shingles (prefix filter over the full sets). Shingles
  with few holders are joined as they are. A partner that shares none of those
  differs in all of them, which rules most pairs out before a frequent shingle is
  joined. This is exact and leaves out only pairs already connected.

Links decide components; so pairs inside one component need no further check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import ascii_lower, maybe_broadcast, text_key
from pagemill.session import settle

SHINGLE = 3
SKETCH = 32
INDEXED = 16
LONG_LIST = 64
PERCENT = 85
# An estimate from SKETCH values this far below the threshold is five standard
# deviations away from it.
ESTIMATE_SLACK = 0.32


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the text's word shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: A-Z only, six blanks
    if not words:
        return np.zeros(0, np.int64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(codes) - size + 1)
    rolled = np.full(n, min(size, len(codes)), np.uint64)
    for i in range(min(size, len(codes))):
        rolled = (rolled ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(32)
    rolled *= np.uint64(0xD6E8FEB86659FD93)
    rolled ^= rolled >> np.uint64(29)
    return np.unique((rolled >> np.uint64(1)).astype(np.int64))


def sketch_rows(docs: DataFrame, size: int) -> DataFrame:
    """docs(row, doc_id, text) to (row, doc_id, cls, n, sketch)."""

    @F.pandas_udf("n long, sketch array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [(len(s), s[:SKETCH].copy()) for s in (shingle_hashes(t, size) for t in texts)]
            yield pd.DataFrame(found, columns=["n", "sketch"])

    plain = F.trim(F.regexp_replace(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), r"[\x20\x09-\x0D]+", " "))
    return docs.select("row", "doc_id", F.when(plain != "", text_key(plain)).alias("cls"), run("text").alias("s")).select(
        "row", "doc_id", "cls", "s.n", "s.sketch"
    )


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cls, items): the full sets of the classes in wanted(cls, row), read from
    the text of their first row."""

    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingle_hashes(t, size) for t in texts])

    texts = docs.select("row", "text").join(maybe_broadcast(wanted), "row")
    return texts.select("cls", run("text").alias("items")).dropDuplicates(["cls"])


def size_bound(a: str, b: str, percent: int) -> Column:
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def postings(classes: DataFrame) -> DataFrame:
    """(value, holders, cls, n): retained values that more than one class holds."""
    each = classes.select("cls", "n", F.explode("sketch").alias("value"))
    shared = each.groupBy("value").agg(F.count("*").alias("holders")).where("holders > 1")
    return each.join(shared, "value")


def rare_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs over the short lists, with enough common values. Each class is
    listed under its INDEXED lowest rare values."""
    rare = lists.where(F.col("holders") <= LONG_LIST)
    order = Window.partitionBy("cls").orderBy("value")
    rare = rare.withColumn("at", F.row_number().over(order)).withColumn(
        "own", F.least(F.count("*").over(Window.partitionBy("cls")), F.lit(INDEXED))
    ).where(F.col("at") <= INDEXED)
    left = rare.select("value", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("own").alias("own_a"))
    right = rare.select("value", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("own").alias("own_b"))
    pairs = left.join(right, "value").where((F.col("a") < F.col("b")) & size_bound("na", "nb", percent))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("common"), F.min(F.least("own_a", "own_b")).alias("own")).where(
        "common * 6 >= own"
    ).select("a", "b")


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose union sketch does not speak against the threshold. Sketches of
    sets up to SKETCH are whole sets, where the estimate is the similarity."""
    side = classes.select("cls", "sketch")
    both = pairs.join(side.toDF("a", "sa"), "a").join(side.toDF("b", "sb"), "b")
    low = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    share = F.size(F.array_intersect(low, F.array_intersect("sa", "sb"))) / F.size(low)
    return both.where(share >= percent / 100 - ESTIMATE_SLACK).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union on the full sets."""
    both = pairs.join(sets.toDF("a", "ia"), "a").join(sets.toDF("b", "ib"), "b")
    same = F.size(F.array_intersect("ia", "ib"))
    return both.where(100 * same >= percent * (F.size("ia") + F.size("ib") - same)).select("a", "b")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of all nodes of edges(a, b): root is the least node that can be
    reached. Alternating large and small stars; every round is written, so a lost
    executor repeats one round at most."""
    now = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name)
    state = None
    while True:
        # Large star: neighbours above a node move to the least of its neighbourhood.
        both = now.union(now.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its lower neighbours move to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        small = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now = settle(small.where("a <> b").distinct(), name)
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(new) == state:
            break
        state = tuple(new)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def with_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet in one component."""
    joined = pairs.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left")
    return joined.where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b")


def common_classes(classes: DataFrame, lists: DataFrame) -> DataFrame:
    """(cls, n, row): classes with more than half of their sketch on long lists."""
    long = lists.where(F.col("holders") > LONG_LIST).groupBy("cls").agg(F.count("*").alias("long"))
    return classes.join(long, "cls").where("2 * long > size(sketch)").select("cls", "n", "row")


def common_tokens(common: DataFrame, sets: DataFrame) -> DataFrame:
    """(cls, n, token, df, at): the shingles of the common classes, how many of these
    have each, and its place in the order from the rarest on. Written."""
    tokens = sets.join(common.select("cls", "n"), "cls").select("cls", "n", F.explode("items").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("df"))
    order = Window.partitionBy("cls").orderBy("df", "token")
    return settle(tokens.join(counts, "token").withColumn("at", F.row_number().over(order)), "common-tokens")


def rest_pairs(common: DataFrame, tokens: DataFrame, lists: DataFrame, roots: DataFrame, percent: int) -> DataFrame | None:
    """(a, b) among the common classes that could still be linked, where a is not
    joined with the hub of one of its long lists. lists(value, cls, hub). Written;
    None where every class is joined with all of its hubs."""
    root = roots.select(F.col("node").alias("cls"), "root")
    placed = settle(
        common.select("cls", "n", "spread").join(root, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "common-roots"
    )
    hubs = placed.select(F.col("cls").alias("hub"), F.col("root").alias("hub_root"))
    apart = settle(
        lists.select("cls", "hub").distinct().join(placed.select("cls", "root"), "cls").join(hubs, "hub")
        .where("root <> hub_root").select("cls").distinct(), "apart"
    )
    if apart.isEmpty():
        return None
    # A partner has one of the first tokens up to this place.
    prefix = tokens.where(f"df > 1 AND 100 * (at - 1) <= (100 - {percent}) * n").join(apart, "cls", "left_semi")
    left = prefix.join(placed.select("cls", "spread", "root"), "cls").select(
        "token", "df", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("spread").alias("ca"), F.col("root").alias("ra")
    )
    right = tokens.where("df > 1").select("token", "cls").join(placed, "cls").select(
        "token", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("spread").alias("cb"), F.col("root").alias("rb")
    )
    rare = left.where(F.col("df") <= LONG_LIST).join(right, "token").where((F.col("ra") != F.col("rb")) & size_bound("na", "nb", percent))
    # Without a rare shingle in common the intersection is at most the lesser count
    # of frequent ones: 100 i >= percent * (na + nb - i).
    able = [F.expr(f"100 * {c} >= {percent} * {n}") for c, n in (("ca", "na"), ("cb", "nb"))]
    wide = left.where((F.col("df") > LONG_LIST) & able[0]).join(right.where(able[1]), "token").where(
        F.expr(f"ra <> rb AND (100 + {percent}) * least(ca, cb) >= {percent} * (na + nb)")
    )
    pairs = rare.select("a", "b").union(wide.select("a", "b"))
    return settle(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "rest-pairs")


def find_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs`: (row, doc_id, n_shingles, component_id, kept, group).
    `row` is row_key of the row; rows that agree in it have equal results. `group`
    is the component's own key (null without shingles): ids may repeat or be null,
    so component_id does not tell components apart.

    Words are lower-cased in A-Z and split at the six ASCII blanks. A text of fewer
    words than a shingle is one shingle; null, empty and blank texts have none, are
    linked with nothing and are their own component. component_id is the least
    doc_id that can be reached (null ids are passed over; null if there is no
    other); kept says that it is the row's own."""
    source = docs.select(row_key(docs, doc_id, text).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = settle(sketch_rows(source, shingle), "sketches")
    classes = settle(
        rows.where("cls IS NOT NULL").groupBy("cls").agg(
            F.min("doc_id").alias("least"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    lists = settle(postings(classes), "postings")
    common = settle(common_classes(classes, lists), "common")
    common_sets = settle(full_sets(source, common.select("cls", "row"), shingle), "common-sets")
    tokens = common_tokens(common, common_sets)
    common = settle(
        common.join(tokens.groupBy("cls").agg(F.count_if(F.col("df") > LONG_LIST).alias("spread")), "cls"), "common-spread"
    )
    long = lists.where(F.col("holders") > LONG_LIST).select("value", "cls").join(common.select("cls", "n", "spread"), "cls")
    hubs = long.groupBy("value").agg(F.min(F.struct(F.expr("n - spread").alias("own"), F.col("cls").alias("hub"), F.col("n").alias("hub_n"))).alias("h"))
    in_long = settle(long.join(hubs, "value").select("value", "cls", "n", "h.hub", "h.hub_n"), "long-lists")

    rare = settle(likely(rare_pairs(lists, percent), classes, percent), "rare-pairs")
    stars = likely(
        in_long.where((F.col("cls") != F.col("hub")) & size_bound("n", "hub_n", percent))
        .select(F.greatest("cls", "hub").alias("a"), F.least("cls", "hub").alias("b")).distinct(), classes, percent
    )
    stars = settle(stars, "star-pairs")
    # First each class with the least partner, then what that has not joined.
    first = rare.groupBy(F.col("b")).agg(F.min("a").alias("a")).select("a", "b").union(stars).distinct()
    ends = rare.select("a").union(rare.select("b")).toDF("cls").distinct().join(common, "cls", "left_anti")
    wanted = settle(ends.join(classes.select("cls", "row"), "cls"), "wanted")
    sets = settle(full_sets(source, wanted, shingle), "full-sets").union(common_sets)
    links = settle(confirmed(first, sets, percent), "links")
    roots = settle(components(links, "stars"), "roots")
    more = settle(with_roots(rare, roots), "open-pairs")
    rest = rest_pairs(common, tokens, in_long, roots, percent)
    if rest is not None:
        more = settle(more.union(likely(rest, classes, percent)).distinct(), "open-pairs")
    more = settle(confirmed(more, sets, percent), "more-links")
    if not more.isEmpty():
        known = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = settle(components(known.union(more), "more-stars"), "more-roots")

    named = classes.select("cls", "least").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
    named = named.withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "root").select("cls", "component_id", "root")
    joined = rows.select("row", "doc_id", F.col("n").alias("n_shingles"), "cls").join(of_class, "cls", "left")
    own = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "row", "doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"),
        F.col("root").alias("group"),
    )


def row_key(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Column:
    return text_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """`docs`, all columns, with one row of each component: the row of its least
    doc_id (null ids last; of equal ids the one whose key is least; of equal rows
    any one). Documents without words all stay."""
    groups = settle(find_groups(docs, doc_id, text, shingle, percent), "groups")
    full = groups.where("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    best = full.groupBy("group").agg(first.alias("f")).select("f.row")
    counts = full.groupBy("row").agg(F.count("*").alias("copies"))
    keep = best.join(counts, "row").union(groups.where("n_shingles = 0").select("row").distinct().select("row", F.lit(1).alias("copies")))
    keep = settle(keep.select(F.col("row").alias("__row"), F.col("copies").alias("__copies")), "kept-rows")
    found = docs.withColumn("__row", row_key(docs, doc_id, text)).join(keep, "__row")
    single = found.where("__copies = 1")
    return single.union(found.where("__copies > 1").dropDuplicates(["__row"])).drop("__row", "__copies")

"""Focused expansion over stored pages.

Page and link scores do not depend on the crawl, so they are computed once into
two compact tables, split by a hash of the URL. A round pops a batch, reads only
the URL buckets of that batch and appends to three tables (visited, scored,
pushed); nothing grows on the driver and no lineage builds up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions.html import links as link_array
from pagemill.functions.urls import canonical_link, host, is_blocked_link
from pagemill.operators.ordering import positions
from pagemill.session import BROADCAST_ROWS, fits, scratch_path, settle

# A batch of at most this many pages is ordered by per-task heaps and numbered in one
# task, and may be exact; larger ones are ordered in range partitions.
SMALL_BATCH = 10_000

FRONTIER = "score double, url string, parent_id bigint"
SCORED = "page_id bigint, url string, parent_id bigint, score double, label int"


@dataclass(frozen=True)
class CrawlOptions:
    page_limit: int = fixed.PAGE_LIMIT
    # Pages popped in one round, at most.
    batch: int = 1
    # Pages and their order are those of a heap that pops one page at a time: a batch
    # ends where a link of its own pages could overtake the next page. At most
    # SMALL_BATCH pages are popped then. Otherwise pages of one batch do not see each
    # other's links and source counts.
    exact: bool = True
    page_threshold: float = fixed.PAGE_THRESHOLD
    url_threshold: float = fixed.URL_THRESHOLD
    restricted: bool = False
    combine_method: int = 1
    # URL buckets of the stored tables; by default one per shuffle partition.
    buckets: int | None = None
    max_rounds: int | None = None


def page_links(pages: DataFrame) -> DataFrame:
    """(src_url, pos, anchor, href) of pages (url, html)."""
    return pages.select(F.col("url").alias("src_url"), F.explode(link_array(F.col("html"))).alias("k")).select(
        "src_url", "k.pos", "k.anchor", "k.href"
    )


def link_candidates(links: DataFrame, keep_id_params: bool = False) -> DataFrame:
    """Links worth following, with their canonical address `dst_url`."""
    with_dst = links.filter(F.col("href").isNotNull() & (F.col("href") != "")).withColumn(
        "dst_url", canonical_link(F.col("href"), keep_id_params)
    )
    return with_dst.filter(F.col("dst_url").startswith("http") & ~is_blocked_link(F.col("href"), F.col("dst_url")))


def page_label(score: Column, threshold: float = fixed.PAGE_THRESHOLD) -> Column:
    return F.when(score >= threshold, F.lit(1)).otherwise(F.lit(0))


def source_counts(scored: DataFrame, domain: Column | None = None) -> DataFrame:
    """(domain, rel, nonrel) with a prior of one on both sides."""
    by = host(F.col("url")) if domain is None else domain
    return scored.groupBy(by.alias("domain")).agg(
        (F.sum("label") + F.lit(fixed.SOURCE_PRIOR)).alias("rel"),
        (F.sum(1 - F.col("label")) + F.lit(fixed.SOURCE_PRIOR)).alias("nonrel"),
    )


def source_ratio(rel: Column, nonrel: Column) -> Column:
    prior = F.lit(fixed.SOURCE_PRIOR)
    return F.coalesce(rel, prior) / F.coalesce(nonrel, prior)


def with_source_ratio(links: DataFrame, counts: DataFrame, url: str = "dst_url", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Add the importance of each link's target source; unseen sources give 1."""
    counts = settle(counts, "source-counts")  # its size is checked before it is used
    side = F.broadcast(counts) if fits(counts, limit) else counts
    return (
        links.withColumn("domain", host(F.col(url))).join(side, "domain", "left")
        .withColumn("ratio", source_ratio(F.col("rel"), F.col("nonrel"))).drop("rel", "nonrel")
    )


def link_total(page: Column, link: Column, ratio: Column, label: Column, method: int = 1) -> Column:
    """Priority of a link. Method 1 weighs by the source ratio when the parent is
    relevant; method 2 blends score and ratio."""
    total = page * link
    if method == 1:
        return F.when(label == 1, total * ratio).otherwise(total)
    if method == 2:
        return fixed.LINK_WEIGHT * total + fixed.SOURCE_WEIGHT * ratio
    return total


def expandable(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("score") >= fixed.EXPAND_THRESHOLD)


def link_priorities(links: DataFrame, method: int = 1, threshold: float = fixed.URL_THRESHOLD) -> DataFrame:
    """Rows with score, label, link_score, ratio: threshold, combine, threshold."""
    first = links.filter(F.col("score") * F.col("link_score") >= threshold)
    total = link_total(F.col("score"), F.col("link_score"), F.col("ratio"), F.col("label"), method)
    return first.withColumn("total", total).filter(F.col("total") >= threshold)


def unvisited(frontier: DataFrame, visited: DataFrame, url: str = "url", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose address is not in visited(url)."""
    seen = visited.select(F.col("url").alias(url))
    return frontier.join(F.broadcast(seen) if fits(seen, limit) else seen, url, "left_anti")


def available(pages: DataFrame) -> DataFrame:
    """Pages that can be had: the score is known and not -1."""
    return pages.filter(F.col("score").isNotNull() & (F.col("score") != -1))


def at_least(pages: DataFrame, threshold: float = fixed.PAGE_THRESHOLD) -> DataFrame:
    """Pages of a restricted crawl: the score reaches the page threshold."""
    return pages.filter(F.col("score") >= threshold)


def _by(score: str) -> list[Column]:
    return [F.desc(score), F.asc("url"), F.asc("parent_id")]


def first_rows(df: DataFrame, order: list[Column], n: int, number: str) -> DataFrame:
    """The first n rows of an order with their number from 0 on. No more than
    SMALL_BATCH rows meet in one task."""
    if n <= SMALL_BATCH:
        few = df.orderBy(*order).limit(n)
        return few.withColumn(number, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("bigint") - 1)
    return positions(df, order, number).where(F.col(number) < n)


def pop_best(frontier: DataFrame, visited: DataFrame, n: int | None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Best n unvisited addresses by score, then url, then parent; all of them, in no
    order and without a top-k, when n is None."""
    best = unvisited(frontier, visited, limit=limit).groupBy("url").agg(
        F.min(F.struct((-F.col("score")).alias("neg"), "parent_id")).alias("_k")
    )
    best = best.select((-F.col("_k.neg")).alias("score"), "url", F.col("_k.parent_id").alias("parent_id"))
    if n is None or n > SMALL_BATCH:
        return best if n is None else first_rows(best, _by("score"), n, "_at").drop("_at")
    return best.orderBy(*_by("score")).limit(n)


def _bucket(url: str, n: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(n)).cast("int")


@dataclass
class Expansion:
    scored: DataFrame  # page_id, url, parent_id, score, label
    frontier: DataFrame  # score, url, parent_id still waiting
    visited: DataFrame  # url


def counts_at(links: DataFrame, counts: DataFrame, scored: DataFrame) -> DataFrame:
    """links(dst_url, rank, ...) with `ratio` as it stood when the page of that rank had
    been scored: counts(domain, rel, nonrel) of earlier batches and scored(url, rank,
    label) of this one."""
    mine = scored.groupBy(host(F.col("url")).alias("domain")).agg(F.collect_list(F.struct("rank", "label")).alias("_seen"))
    side = counts.join(mine, "domain", "full")
    side = settle(side, "source-counts")
    weighed = links.withColumn("domain", host(F.col("dst_url"))).join(F.broadcast(side) if fits(side) else side, "domain", "left")
    so_far = lambda label: F.expr(f"coalesce(size(filter(_seen, s -> s.rank <= rank AND s.label = {label})), 0)")
    prior = F.lit(fixed.SOURCE_PRIOR)
    rel, nonrel = (F.coalesce(F.col(n), prior) + F.greatest(so_far(v), F.lit(0)) for n, v in (("rel", 1), ("nonrel", 0)))
    return weighed.withColumn("ratio", source_ratio(rel, nonrel)).drop("rel", "nonrel", "_seen")


def undisturbed(batch: DataFrame, pushed: DataFrame) -> int:
    """How many pages of batch(rank, score), at most SMALL_BATCH, a heap pops before any
    of the links that they push: pushed(rank, total)."""
    waiting = [r["score"] for r in batch.select("rank", "score").orderBy("rank").collect()]
    best = {r["rank"]: r["total"] for r in pushed.groupBy("rank").agg(F.max("total").alias("total")).collect()}
    highest = float("-inf")
    for rank in range(len(waiting) - 1):
        highest = max(highest, best.get(rank, highest))
        if highest >= waiting[rank + 1]:
            return rank + 1
    return len(waiting)


def focused_expand(seeds: DataFrame, pages: DataFrame, links: DataFrame, o: CrawlOptions = CrawlOptions()) -> Expansion:
    """Expand from `seeds` (url) over `pages` (url, score; no row or a null or -1
    score means the page cannot be had) and `links` (src_url, dst_url,
    link_score)."""
    spark = seeds.sparkSession
    n_buckets = o.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def bucketed(df: DataFrame, url: str, name: str) -> DataFrame:
        # Rebalancing gathers small buckets into few files and splits a hot one.
        rows = df.withColumn("bucket", _bucket(url, n_buckets)).hint("rebalance", F.col("bucket"))
        return settle(rows, name, ["bucket"])

    stored = bucketed(available(pages).select("url", "score"), "url", "crawl-pages")
    out_links = bucketed(links.select("src_url", "dst_url", "link_score"), "src_url", "crawl-links")
    root = scratch_path(spark, "crawl-state")
    spots = {n: f"{root}/{n}" for n in ("visited", "scored", "frontier")}

    def add(df: DataFrame, spot: str) -> None:
        df.write.mode("append").parquet(spots[spot])

    def state(spot: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(spots[spot])

    add(seeds.select(F.lit(1.0).alias("score"), "url", F.lit(-1).cast("bigint").alias("parent_id")), "frontier")
    add(spark.createDataFrame([], "url string"), "visited")
    add(spark.createDataFrame([], SCORED), "scored")
    most = min(o.batch, SMALL_BATCH) if o.exact else o.batch
    done, rounds, size = 0, 0, most
    while done < o.page_limit and (o.max_rounds is None or rounds < o.max_rounds):
        rounds += 1
        waiting = pop_best(state("frontier", FRONTIER), state("visited", "url string"), None)
        batch = settle(first_rows(waiting, _by("score"), size, "rank").withColumn("bucket", _bucket("url", n_buckets)), "batch")
        buckets = [r["bucket"] for r in batch.select("bucket").distinct().collect()]
        if not buckets:
            break
        near = F.broadcast if fits(batch) else (lambda d: d)
        found = stored.filter(F.col("bucket").isin(buckets)).join(near(batch.drop("score")), ["url", "bucket"])
        if o.restricted:
            found = at_least(found, o.page_threshold)
        # A batch holds each page once: the rank is a total order.
        scored = settle(
            first_rows(found, [F.asc("rank")], min(o.page_limit - done, size), "_at").select(
                (F.col("_at") + done).alias("page_id"), "url", "parent_id", "score",
                page_label(F.col("score"), o.page_threshold).alias("label"), "bucket", "rank",
            ), "batch-scored",
        )
        parents = near(
            expandable(scored).select(F.col("url").alias("src_url"), "page_id", "score", "label", "bucket", "rank")
        )
        fresh = out_links.filter(F.col("bucket").isin(buckets)).join(parents, ["src_url", "bucket"])
        fresh = unvisited(fresh, state("visited", "url string"), "dst_url")
        before = source_counts(state("scored", SCORED))
        last = F.lit(None) if o.exact else F.lit(size)
        popped = near(batch.select(F.col("url").alias("dst_url"), F.col("rank").alias("_popped")))
        fresh = fresh.join(popped, "dst_url", "left").where(F.col("_popped").isNull() | (F.col("_popped") > F.coalesce(last, "rank")))
        if o.exact:
            weighed = counts_at(fresh, before, scored)
        else:
            weighed = with_source_ratio(fresh, source_counts(state("scored", SCORED).unionByName(scored.drop("bucket", "rank"))))
        pushed = settle(link_priorities(weighed, o.combine_method, o.url_threshold).select("rank", "total", "dst_url", "page_id"), "batch-links")
        kept = batch
        if o.exact:
            stop = undisturbed(batch, pushed)
            # The last page that the limit allows ends the crawl as well.
            if done + scored.count() == o.page_limit:
                stop = min(stop, scored.agg(F.max("rank")).first()[0] + 1)
            size = min(most, max(2 * stop, 8))
            kept, scored, pushed = (d.where(F.col("rank") < stop) for d in (batch, scored, pushed))
        add(kept.select("url"), "visited")
        add(scored.drop("bucket", "rank"), "scored")
        add(pushed.select(F.col("total").alias("score"), F.col("dst_url").alias("url"), F.col("page_id").alias("parent_id")), "frontier")
        done += scored.count()
    visited = state("visited", "url string")
    return Expansion(
        scored=state("scored", SCORED),
        frontier=unvisited(state("frontier", FRONTIER), visited).select("score", "url", "parent_id"),
        visited=visited,
    )

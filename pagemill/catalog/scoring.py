"""Relevance filters, source counts, link priorities and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.catalog.base import SCORED_CTE, query, scored, table
from pagemill.operators import ordering as od
from pagemill.plans import evaluate as ev
from pagemill.plans import frontier as fr
from pagemill.plans.relevance import event_score
from pagemill.session import scratch_path
from pagemill.sinks.files import write_pairs


@query("flt9_page_threshold", f"WITH {SCORED_CTE} SELECT page_id, score FROM scored WHERE score >= 0.5")
def flt9(spark, sf):
    return fr.at_least(scored(spark, sf)).select("page_id", "score")


@query("flt10_relevant_label", f"WITH {SCORED_CTE} SELECT page_id, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS label FROM scored")
def flt10(spark, sf):
    return ev.label_pages(scored(spark, sf)).select("page_id", "label")


@query("flt11_expandable", f"WITH {SCORED_CTE} SELECT page_id FROM scored WHERE score >= 0.1")
def flt11(spark, sf):
    return fr.expandable(scored(spark, sf)).select("page_id")


@query("flt12_skip_unscored", f"WITH {SCORED_CTE} SELECT page_id FROM scored WHERE score > 0.05")
def flt12(spark, sf):
    """Pages whose score failed (-1) or has no text (null) are skipped."""
    raw = scored(spark, sf).withColumn(
        "score", F.when(F.col("score") <= 0.02, -1.0).when(F.col("score") <= 0.05, F.lit(None)).otherwise(F.col("score"))
    )
    return fr.available(raw).select("page_id")


SQL_COUNTS = """counts AS (SELECT domain, 1.0 + sum(label) AS rel, 1.0 + sum(1 - label) AS nonrel FROM scored GROUP BY domain)"""


@query(
    "agg13_source_counts",
    f"WITH {SCORED_CTE}, {SQL_COUNTS} SELECT domain, CAST(rel AS DOUBLE) AS rel, CAST(nonrel AS DOUBLE) AS nonrel FROM counts",
)
def agg13(spark, sf):
    return fr.source_counts(scored(spark, sf), F.col("domain"))


@query(
    "agg14_harvest_summary",
    f"WITH {SCORED_CTE} SELECT CAST(sum(label) AS BIGINT) AS relevant, count(*) AS total, round(avg(label), 9) AS ratio FROM scored",
)
def agg14(spark, sf):
    return ev.harvest_summary(scored(spark, sf)).withColumn("ratio", F.round("ratio", 9))


@query(
    "win1_harvest_curve",
    f"""WITH {SCORED_CTE} SELECT page_id, CAST(sum(label) OVER (ORDER BY page_id) AS BIGINT) AS rel,
    row_number() OVER (ORDER BY page_id) AS tot FROM scored""",
)
def win1(spark, sf):
    return ev.harvest_curve(scored(spark, sf))


@query(
    "snk10_evaluation_file",
    f"""WITH {SCORED_CTE} SELECT CAST(sum(label) OVER (ORDER BY page_id) AS BIGINT) AS rel,
    row_number() OVER (ORDER BY page_id) AS tot FROM scored""",
)
def snk10(spark, sf):
    path = scratch_path(spark, "evaluation")
    write_pairs(ev.harvest_curve(scored(spark, sf)), ["rel", "tot"], path)
    return spark.read.schema("rel bigint, tot bigint").csv(path)


@query("top3_page_limit", f"WITH {SCORED_CTE} SELECT page_id, score FROM scored ORDER BY score DESC, page_id LIMIT 1000")
def top3(spark, sf):
    return od.top_k(scored(spark, sf).select("page_id", "score"), [F.desc("score"), F.asc("page_id")], fixed.PAGE_LIMIT)


# ---- a link graph over documents: three links per document ---------------------------------
GRAPH_CTE = """ids AS (SELECT doc_id, 'https://' || source || '.example.org/' || CAST(doc_id AS STRING) AS url,
  (doc_id * 37 % 101) / 100.0 AS score FROM documents),
graph AS (SELECT a.doc_id AS parent_id, a.url AS src_url, a.score, CASE WHEN a.score >= 0.5 THEN 1 ELSE 0 END AS label, b.url AS dst_url,
  ((a.doc_id * 13 + k * 29) % 97) / 96.0 AS link_score FROM ids a, (VALUES (1), (3), (7)) v(k), ids b
  WHERE b.doc_id = (a.doc_id * (k + 1) + k) % (SELECT count(*) FROM documents)),
counts AS (SELECT string_split(string_split(url, '//')[2], '/')[1] AS domain, 1.0 + sum(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) AS rel,
  1.0 + sum(CASE WHEN score >= 0.5 THEN 0 ELSE 1 END) AS nonrel FROM ids WHERE score < 0.8 GROUP BY 1)"""


def graph_pages(spark, sf):
    """(doc_id, url, score) of every document as a page."""
    return table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("https://"), "source", F.lit(".example.org/"), F.col("doc_id").cast("string")).alias("url"),
        (F.col("doc_id") * 37 % 101 / 100.0).alias("score"),
    )


def graph_links(spark, sf):
    """(parent_id, src_url, score, label, dst_url, link_score)"""
    pages = graph_pages(spark, sf)
    n = table(spark, sf, "documents").count()
    sources = pages.withColumn("k", F.explode(F.array(F.lit(1), F.lit(3), F.lit(7)))).select(
        F.col("doc_id").alias("parent_id"), F.col("url").alias("src_url"), "score", fr.page_label(F.col("score")).alias("label"),
        ((F.col("doc_id") * 13 + F.col("k") * 29) % 97 / 96.0).alias("link_score"),
        ((F.col("doc_id") * (F.col("k") + 1) + F.col("k")) % n).alias("doc_id"),
    )
    return sources.join(pages.select("doc_id", F.col("url").alias("dst_url")), "doc_id").drop("doc_id")


def graph_counts(spark, sf):
    return fr.source_counts(graph_pages(spark, sf).filter(F.col("score") < 0.8).withColumn("label", fr.page_label(F.col("score"))))


SQL_RATIO = """rated AS (SELECT g.*, coalesce(rel, 1.0) / coalesce(nonrel, 1.0) AS ratio
  FROM graph g LEFT JOIN counts c ON string_split(string_split(dst_url, '//')[2], '/')[1] = c.domain)"""


@query(
    "jn8_source_ratio_join",
    f"WITH {GRAPH_CTE}, {SQL_RATIO} SELECT src_url, dst_url, round(ratio, 9) AS ratio FROM rated",
)
def jn8(spark, sf):
    rated = fr.with_source_ratio(graph_links(spark, sf), graph_counts(spark, sf))
    return rated.select("src_url", "dst_url", F.round("ratio", 9).alias("ratio"))


@query(
    "mth9_source_importance",
    f"WITH {GRAPH_CTE} SELECT domain, round(rel / nonrel, 9) AS ratio FROM counts",
)
def mth9(spark, sf):
    return graph_counts(spark, sf).select("domain", F.round(fr.source_ratio(F.col("rel"), F.col("nonrel")), 9).alias("ratio"))


for _method, _total in (
    (1, "CASE WHEN label = 1 THEN score * link_score * ratio ELSE score * link_score END"),
    (2, "0.6 * (score * link_score) + 0.4 * ratio"),
):

    def _run(spark, sf, method=_method):
        rated = fr.with_source_ratio(graph_links(spark, sf), graph_counts(spark, sf))
        return fr.link_priorities(rated, method).select("src_url", "dst_url", F.round("total", 9).alias("total"))

    query(
        f"mth8_link_total_method{_method}",
        f"""WITH {GRAPH_CTE}, {SQL_RATIO} SELECT src_url, dst_url, round({_total}, 9) AS total FROM rated
        WHERE score * link_score >= 0.1 AND {_total} >= 0.1""",
    )(_run)


@query(
    "flt14_link_threshold",
    f"WITH {GRAPH_CTE} SELECT src_url, dst_url, round(score * link_score, 9) AS total FROM graph WHERE score * link_score >= 0.1",
)
def flt14(spark, sf):
    links = graph_links(spark, sf).withColumn("ratio", F.lit(1.0))
    return fr.link_priorities(links, method=0).select("src_url", "dst_url", F.round("total", 9).alias("total"))


FRONTIER_SQL = f"""{GRAPH_CTE}, {SQL_RATIO},
front AS (SELECT score * link_score AS score, dst_url AS url, parent_id FROM rated WHERE score * link_score >= 0.1),
seen AS (SELECT url FROM ids WHERE score > 0.7),
best AS (SELECT url, max(score) AS score, arg_min(parent_id, (-score, parent_id)) AS parent_id FROM front
  WHERE url NOT IN (SELECT url FROM seen) GROUP BY url)"""


def frontier(spark, sf):
    links = graph_links(spark, sf).withColumn("total", F.col("score") * F.col("link_score")).filter("total >= 0.1")
    return links.select(F.col("total").alias("score"), F.col("dst_url").alias("url"), "parent_id")


def seen(spark, sf):
    return graph_pages(spark, sf).filter(F.col("score") > 0.7).select("url")


@query(
    "top2_pop_best",
    f"WITH {FRONTIER_SQL} SELECT round(score, 9) AS score, url, parent_id FROM best ORDER BY best.score DESC, url, parent_id LIMIT 100",
)
def top2(spark, sf):
    return fr.pop_best(frontier(spark, sf), seen(spark, sf), 100).withColumn("score", F.round("score", 9))


@query(
    "jn6_visited_anti_join",
    f"WITH {FRONTIER_SQL} SELECT url, count(*) AS n FROM front WHERE url NOT IN (SELECT url FROM seen) GROUP BY url",
)
def jn6(spark, sf):
    return fr.unvisited(frontier(spark, sf), seen(spark, sf)).groupBy("url").agg(F.count("*").alias("n"))


@query(
    "jn7_frontier_page_join",
    f"WITH {FRONTIER_SQL} SELECT b.url, round(b.score, 9) AS priority, ids.doc_id FROM best b JOIN ids ON b.url = ids.url",
)
def jn7(spark, sf):
    popped = fr.pop_best(frontier(spark, sf), seen(spark, sf), None)
    pages = graph_pages(spark, sf).select("url", "doc_id")
    return popped.join(pages, "url").select("url", F.round("score", 9).alias("priority"), "doc_id")


@query("snk11_frontier_dump", f"WITH {FRONTIER_SQL} SELECT round(score, 9) AS score, url FROM front")
def snk11(spark, sf):
    path = scratch_path(spark, "frontier-dump")
    write_pairs(frontier(spark, sf).withColumn("score", F.round("score", 9)), ["score", "url"], path)
    return spark.read.schema("score double, url string").csv(path)


@query("snk9_crawl_log", "SELECT doc_id AS page_id, doc_id - 1 AS parent_id FROM documents")
def snk9(spark, sf):
    path = scratch_path(spark, "crawl-log")
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), (F.col("doc_id") - 1).alias("parent_id"))
    write_pairs(rows, ["page_id", "parent_id"], path)
    return spark.read.schema("page_id bigint, parent_id bigint").csv(path)


@query(
    "mth6_event_score",
    """WITH p AS (SELECT doc_id, (doc_id * 37 % 101) / 100.0 AS topic, (doc_id * 17 % 53) / 52.0 AS location,
      CASE WHEN doc_id % 3 <> 0 THEN doc_id % 5 END AS d FROM documents)
    SELECT doc_id, round(CASE WHEN d IS NULL THEN 0.4 / (0.4 + 0.2) * topic + 0.2 / (0.4 + 0.2) * location
      WHEN d = 0 THEN 0.0 ELSE 0.4 * topic + 0.2 * location + 0.4 * 1.0 END, 9) AS score FROM p""",
)
def mth6(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", (F.col("doc_id") * 37 % 101 / 100.0).alias("topic"), (F.col("doc_id") * 17 % 53 / 52.0).alias("location"),
        F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 5).alias("d"),
    )
    day = F.when(F.col("d") == 0, 0.0).otherwise(1.0)
    score = event_score(F.col("topic"), F.col("location"), F.col("d").isNotNull(), day)
    return docs.select("doc_id", F.round(score, 9).alias("score"))

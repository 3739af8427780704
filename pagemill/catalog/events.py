"""Tweet collection, date-score and batch queries over events and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalog.base import TWEET_CTE, query, table, tweets
from pagemill.functions import dates as dx
from pagemill.operators import ordering as od
from pagemill.operators import tweets as tw
from pagemill.session import scratch_path
from pagemill.sources import files as src


@query("src2_tweets_csv", f"WITH {TWEET_CTE} SELECT tweet_id, collection_id, collection_name, url FROM tweets")
def src2(spark, sf):
    path = scratch_path(spark, "tweets-csv")
    tweets(spark, sf).select("tweet_id", "collection_id", "collection_name", "url").write.csv(path)
    return src.read_tweets_csv(spark, path).drop("seq")


@query(
    "agg1_tweets_by_url",
    f"""WITH {TWEET_CTE} SELECT url, 0 AS chunk, arg_min(collection_id, seq) AS collection_id,
    arg_min(collection_name, seq) AS collection_name, count(*) AS n_tweets, string_agg(tweet_id, ',' ORDER BY seq) AS tweet_ids
    FROM tweets GROUP BY url""",
)
def agg1(spark, sf):
    return tw.tweets_by_url(tweets(spark, sf)).withColumn("tweet_ids", F.array_join("tweet_ids", ","))


@query(
    "agg1_tweets_by_url_hot",
    f"""WITH {TWEET_CTE}, hot AS (SELECT tweet_id, seq, CASE WHEN seq % 3 = 0 THEN 'http://hot' ELSE url END AS url FROM tweets),
    numbered AS (SELECT *, count(*) OVER (PARTITION BY url) AS n_tweets, (row_number() OVER (PARTITION BY url ORDER BY seq) - 1) // 500 AS chunk FROM hot)
    SELECT url, n_tweets, chunk, string_agg(tweet_id, ',' ORDER BY seq) AS tweet_ids FROM numbered GROUP BY ALL""",
)
def agg1_hot(spark, sf):
    """A third of all tweets on one URL: its ids come in lists of 500."""
    hot = tweets(spark, sf).withColumn("url", F.when(F.col("seq") % 3 == 0, "http://hot").otherwise(F.col("url")))
    rows = tw.tweets_by_url(hot, ids_per_row=500)
    return rows.select("url", "n_tweets", "chunk", F.array_join("tweet_ids", ",").alias("tweet_ids"))


@query("agg2_distinct_urls", f"WITH {TWEET_CTE} SELECT DISTINCT url FROM tweets")
def agg2(spark, sf):
    return tw.distinct_urls(tweets(spark, sf))


@query(
    "jn1_page_tweet_join",
    f"""WITH {TWEET_CTE} SELECT p.page_id, count(*) AS n_tweets, arg_min(collection_id, seq) AS collection_id
    FROM pages p JOIN tweets t ON p.url = t.url GROUP BY p.page_id""",
)
def jn1(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    joined = tw.join_tweet_info(pages, tw.tweets_by_url(tweets(spark, sf)))
    return joined.select("page_id", "n_tweets", "collection_id")


@query(
    "jn9_seed_page_join",
    "SELECT e.event_id, p.page_id FROM events e JOIN pages p ON p.url = 'x' || e.event_id OR p.page_id = e.event_id",
)
def jn9(spark, sf):
    """Seed addresses (one per event) with their stored page, by key."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    named = table(spark, sf, "events").select("event_id").join(
        pages.select(F.col("page_id").alias("event_id"), F.col("url").alias("seed")), "event_id", "left"
    )
    seeds = named.select("event_id", F.coalesce("seed", F.concat(F.lit("x"), F.col("event_id").cast("string"))).alias("url"))
    return seeds.join(pages, "url").select("event_id", "page_id")


@query(
    "win6_batches",
    f"""WITH {TWEET_CTE}, u AS (SELECT DISTINCT url FROM tweets), r AS (SELECT url, row_number() OVER (ORDER BY url) - 1 AS i FROM u)
    SELECT url, i // 1000 AS batch FROM r""",
)
def win6(spark, sf):
    return od.batches(tw.distinct_urls(tweets(spark, sf)), [F.col("url")], 1000)


@query(
    "win5_sequential_ids",
    "SELECT event_id, row_number() OVER (ORDER BY value DESC, event_id) - 1 AS page_id FROM events",
)
def win5(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "value")
    return od.positions(rows, [F.desc("value"), F.asc("event_id")], "page_id").select("event_id", "page_id")


@query("top5_sort_by_field", "SELECT event_id, value FROM events ORDER BY value DESC, event_id")
def top5(spark, sf):
    return od.sort_by_field(table(spark, sf, "events").select("event_id", "value"), "value", "event_id")


LAYOUTS = [
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%d %H:%M:%S"),
    ("yyyyMMddHHmm", "%Y-%m-%d %H:%M:00"),
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    ("yyyy-MM-dd", "%Y-%m-%d 00:00:00"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS'+05:30'", "%Y-%m-%d %H:%M:%S"),
    ("EEEE, MMMM d, yyyy,  h:mm a", "%Y-%m-%d %H:%M:00"),
    ("yyyy-MM-dd'T'HH:mm'Z'", "%Y-%m-%d %H:%M:00"),
    ("MM/dd/yyyy hh:mma", "%Y-%m-%d %H:%M:00"),
    ("hh:mm:ss a EEEE, MMMM d, yyyy", "%Y-%m-%d %H:%M:%S"),
]


@query(
    "dt1_parse_date",
    f"""SELECT event_id, CASE event_id % {len(LAYOUTS) + 1} """
    + " ".join(f"WHEN {i} THEN strftime(ts, '{f}')" for i, (_, f) in enumerate(LAYOUTS))
    + " END AS parsed FROM events",
)
def dt1(spark, sf):
    """Event times written in many layouts (and once as junk), read back."""
    case = F.lit("not a date")
    for i, (layout, _) in enumerate(LAYOUTS):
        case = F.when(F.col("event_id") % (len(LAYOUTS) + 1) == i, F.date_format("ts", layout)).otherwise(case)
    texts = table(spark, sf, "events").select("event_id", case.alias("s"))
    return texts.select("event_id", F.date_format(dx.parse_date(F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


# Layouts outside the fixed list: their parts in other orders, with other separators.
LENIENT = [
    ("EEE MMM dd HH:mm:ss yyyy", "%Y-%m-%d %H:%M:%S"), ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "%Y-%m-%d %H:%M:%S"),
    ("yyyy.MM.dd HH:mm", "%Y-%m-%d %H:%M:00"), ("MMM-dd-yyyy", "%Y-%m-%d 00:00:00"), ("yyyy-MMM-dd H:mm", "%Y-%m-%d %H:%M:00"),
    ("d MMMM, yyyy 'at' h:mm a", "%Y-%m-%d %H:%M:00"), ("HH:mm 'on' MMMM d, yyyy", "%Y-%m-%d %H:%M:00"), ("h a, d MMM yyyy", "%Y-%m-%d %H:00:00"),
    ("yyyyMMdd HHmmss", "%Y-%m-%d %H:%M:%S"), ("yyyyMMdd'T'HH:mm", "%Y-%m-%d %H:%M:00"), ("MM-dd-yyyy HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    ("dd_MMM_yyyy", "%Y-%m-%d 00:00:00"), ("MMMM yyyy, d", "%Y-%m-%d 00:00:00"), ("HH:mm:ss dd.MM.yyyy", "%Y-%m-%d %H:%M:%S"),
    ("yyyy MMMM d HH:mm", "%Y-%m-%d %H:%M:00"), ("ddMMMyyyy", "%Y-%m-%d 00:00:00"), ("MM.dd.yyyy", None), ("MMMM d HH:mm", None),
    ("yyyy-MM-dd 'or' HH:mm", None), ("yyyy/MM/dd HH:mm HH:mm", None),
]


@query(
    "dt1_lenient_dates",
    f"SELECT event_id, CASE event_id % {len(LENIENT)} " + " ".join(f"WHEN {i} THEN strftime(ts, '{f}')" for i, (_, f) in enumerate(LENIENT) if f)
    + f""" WHEN {[n for n, _ in LENIENT].index("MM.dd.yyyy")} THEN CASE WHEN day(ts) <= 12 THEN strftime(make_date(year(ts), day(ts), month(ts)), '%Y-%m-%d 00:00:00')
      ELSE strftime(ts, '%Y-%m-%d 00:00:00') END END AS parsed FROM events""",
)
def dt1_lenient(spark, sf):
    """Event times in layouts that only the grammar reads, some of them not dates."""
    case = F.lit(None).cast("string")
    for i, (layout, _) in enumerate(LENIENT):
        case = F.when(F.col("event_id") % len(LENIENT) == i, F.date_format("ts", layout)).otherwise(case)
    texts = table(spark, sf, "events").select("event_id", case.alias("s"))
    return texts.select("event_id", F.date_format(dx.parse_date(F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "dt2_relabel_utc",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc FROM events",
)
def dt2(spark, sf):
    zones = F.when(F.col("event_id") % 3 == 0, "+02:00").when(F.col("event_id") % 3 == 1, "Z").otherwise(" -0800")
    texts = table(spark, sf, "events").select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), zones).alias("s"))
    return texts.select("event_id", dx.drop_offset(F.col("s")).alias("utc"))


EVENT_DAY = "2024-01-12 06:00:00"


@query(
    "dt4_date_score",
    f"""WITH d AS (SELECT event_id, event_type, CAST(floor((epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '{EVENT_DAY}')) / 86400) AS BIGINT)
      + event_id % 50 - 25 AS days FROM events)
    SELECT event_id, CASE WHEN days > 30 THEN 0.0 WHEN days >= 0 THEN 1.0 - days // 30
      WHEN event_type = 'signup' THEN round(1 + days / 30.0, 9) ELSE 0.0 END AS score FROM d""",
)
def dt4(spark, sf):
    day = F.lit(EVENT_DAY).cast("timestamp")
    kind = F.when(F.col("event_type") == "signup", "Hurricane").otherwise("Shooting")
    moved = F.col("ts") + F.make_dt_interval((F.col("event_id") % 50 - 25).cast("int"))
    return table(spark, sf, "events").select("event_id", F.round(dx.date_score(moved, day, kind), 9).alias("score"))


@query("dt5_unix_seconds", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def dt5(spark, sf):
    return table(spark, sf, "events").select("event_id", F.unix_timestamp("ts").alias("seconds"))


@query(
    "agg8_event_date",
    "SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS event_date FROM events WHERE value IS NOT NULL",
)
def agg8(spark, sf):
    dates = table(spark, sf, "events").select(F.when(F.col("value").isNotNull(), F.col("ts")).alias("pub_date"))
    return dates.agg(F.date_format(F.min("pub_date"), "yyyy-MM-dd HH:mm:ss").alias("event_date"))


@query(
    "agg9_date_frequency",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL",
)
def agg9(spark, sf):
    from pagemill.plans.relevance import date_frequency

    days = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return date_frequency(days, "day")

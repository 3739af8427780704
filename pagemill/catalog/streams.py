"""Streaming queries: each runs its stream over a given table to the end and
returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalog.base import FETCH_COLUMNS, SQL_TEXT_CODE, TEXT_CTE, query, sql_tokens, table
from pagemill.operators.tables import latest_by_key
from pagemill.session import scratch_path
from pagemill.streaming import flows
from pagemill.streaming.state import CHANGES, crawl_state, source_totals, visits_of


def stream(spark, sf, name):
    """A given table as a stream. The pattern lets the table be one file or a
    folder of files."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return flows.table_stream(spark, f"{sf}/{name}.parque[t]", schema)


def fetch_stream(spark, sf):
    return stream(spark, sf, "pages").select("page_id", *[F.expr(e).alias(n) for n, e in FETCH_COLUMNS.items()]).withColumn(
        "fetch_time", F.timestamp_seconds(F.col("stamp").cast("bigint"))
    )


def _finish(spark, df, name):
    path = scratch_path(spark, name)
    flows.append_stream(df, f"{path}/table", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/table")


@query("src9_url_stream", "SELECT url FROM pages")
def src9(spark, sf):
    path = scratch_path(spark, "url-lines")
    table(spark, sf, "pages").select(F.concat("url", F.lit("\r"))).write.text(path)
    return _finish(spark, flows.url_stream(spark, path), "url-stream")


SQL_STREAM = f"""WITH {TEXT_CTE}, c AS (SELECT *, {SQL_TEXT_CODE} AS status_code FROM texts)
  SELECT url || '-' || stamp AS row_key, status_code, CASE WHEN status_code = '0200' THEN array_to_string({sql_tokens('clean_text')}, ',') END AS tokens
  FROM c"""


@query("stm1_clean_stream", SQL_STREAM)
def stm1(spark, sf):
    cleaned = flows.clean_stream(fetch_stream(spark, sf)).select("row_key", "status_code", F.array_join("tokens", ",").alias("tokens"))
    return _finish(spark, cleaned, "clean-stream")


@query("stm2_pass_through", "SELECT event_id, event_type FROM events")
def stm2(spark, sf):
    return _finish(spark, stream(spark, sf, "events").select("event_id", "event_type"), "pass-through")


@query("stm3_micro_batches", SQL_STREAM.replace(" END AS tokens", " ELSE '' END AS tokens"))
def stm3(spark, sf):
    path = scratch_path(spark, "micro-batches")
    flows.foreach_clean(fetch_stream(spark, sf), f"{path}/table", f"{path}/checkpoint", once=True).awaitTermination()
    back = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("maxCharsPerColumn", -1).csv(f"{path}/table")
    return back.select("row_key", "status_code", F.coalesce("tokens", F.lit("")).alias("tokens"))


@query("stm4_restart_append", "SELECT page_id, url FROM pages")
def stm4(spark, sf):
    """The same stream started twice over one checkpoint appends once."""
    path = scratch_path(spark, "restart")
    df = stream(spark, sf, "pages").select("page_id", "url")
    for _ in range(2):
        flows.append_stream(df, f"{path}/table", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/table")


def visit_stream(spark, sf):
    return stream(spark, sf, "events").select(
        F.concat(F.lit("https://"), "event_type", F.lit(".org/"), (F.col("user_id") % 300).cast("string")).alias("url"),
        F.col("ts").cast("timestamp").alias("fetch_time"),
    )


SQL_VISITS = "SELECT DISTINCT 'https://' || event_type || '.org/' || CAST(user_id % 300 AS STRING) AS url FROM events"


@query("stm5_first_visits", SQL_VISITS)
def stm5(spark, sf):
    return _finish(spark, flows.first_visits(visit_stream(spark, sf), delay="400 days").select("url"), "first-visits")


@query("stm5_first_visits_unbounded", SQL_VISITS)
def stm5_unbounded(spark, sf):
    return _finish(spark, flows.first_visits(visit_stream(spark, sf).select("url"), None), "first-visits")


@query(
    "stm6_running_source_counts",
    """SELECT 'u' || CAST(user_id % 40 AS STRING) || '.org' AS domain, 1.0 + CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS rel,
    1.0 + CAST(count(*) FILTER (WHERE event_type <> 'purchase') AS DOUBLE) AS nonrel FROM events GROUP BY 1""",
)
def stm6(spark, sf):
    path = scratch_path(spark, "source-counts")
    pages = stream(spark, sf, "events").select(
        F.concat(F.lit("https://u"), (F.col("user_id") % 40).cast("string"), F.lit(".org/x")).alias("url"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"),
    )
    flows.update_stream(flows.running_source_counts(pages), f"{path}/table", f"{path}/checkpoint", once=True).awaitTermination()
    changes = spark.read.schema("domain string, rel double, nonrel double, version bigint").parquet(f"{path}/table")
    return latest_by_key(changes, "domain", F.col("version")).select("domain", "rel", "nonrel")


def _crawl_changes(spark, sf, name):
    """First visits of the event table, read by one file a batch and started twice."""
    path = scratch_path(spark, name)
    table(spark, sf, "events").repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(f"{path}/in")
    visits = flows.table_stream(spark, f"{path}/in", table(spark, sf, "events").schema, max_files=1).select(
        F.concat(F.lit("https://"), "event_type", F.lit(".org/"), (F.col("user_id") % 300).cast("string")).alias("url"),
        F.col("ts").cast("timestamp").alias("fetch_time"), (F.col("value") > 50).cast("int").alias("label"),
    )
    for _ in range(2):
        flows.update_stream(crawl_state(visits, "400 days"), f"{path}/table", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(CHANGES).parquet(f"{path}/table")


CRAWL_CTE = """v AS (SELECT 'https://' || event_type || '.org/' || CAST(user_id % 300 AS STRING) AS url, event_type || '.org' AS domain, ts,
  CASE WHEN value > 50 THEN 1 ELSE 0 END AS label FROM events),
firsts AS (SELECT domain, url, min(ts) AS ts, arg_max(label, (-epoch_us(ts), label)) AS label FROM v GROUP BY ALL)"""


@query("stm5_crawl_state_visits", f"WITH {CRAWL_CTE} SELECT url, epoch_us(ts) AS first_visit FROM firsts")
def stm5_state(spark, sf):
    return visits_of(_crawl_changes(spark, sf, "crawl-visits")).select("url", F.unix_micros("first_visit").alias("first_visit"))


@query(
    "stm6_crawl_state_counts",
    f"""WITH {CRAWL_CTE} SELECT domain, CAST(1 + count(*) FILTER (WHERE label = 1) AS DOUBLE) AS rel,
    CAST(1 + count(*) FILTER (WHERE label = 0) AS DOUBLE) AS nonrel FROM firsts GROUP BY domain""",
)
def stm6_state(spark, sf):
    return source_totals(_crawl_changes(spark, sf, "crawl-counts"))

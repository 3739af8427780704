"""Fetch status, record assembly, source and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.catalog.base import FETCH_CTE, SQL_CODE, SQL_TEXT_CODE, TEXT_CTE, TOPIC_CTE, fetches, model_docs, query, sql_list, table
from pagemill.functions import html as hx
from pagemill.functions import text as tx
from pagemill.functions.urls import is_image_url
from pagemill.operators import records as rc
from pagemill.operators import status as st
from pagemill.operators import tables as tb
from pagemill.operators.tweets import event_label
from pagemill.plans.clean import extract_pages
from pagemill.plans.relevance import build_topic_model
from pagemill.session import scratch_path, spread
from pagemill.sinks import files as snk
from pagemill.sources import files as src
from pagemill.sources import warc


# ---- status ----------------------------------------------------------------------------
@query("flt1_image_urls", f"WITH {FETCH_CTE} SELECT page_id, url LIKE '%.jpg' AS image FROM fetches")
def flt1(spark, sf):
    return fetches(spark, sf).select("page_id", is_image_url(F.col("url")).alias("image"))


@query(
    "flt2_http_status",
    f"WITH {FETCH_CTE} SELECT page_id, '0' || CAST(status AS STRING) AS code FROM fetches WHERE status <> 200",
)
def flt2(spark, sf):
    code = st.fetch_status(F.lit(""), F.col("status"), F.lit(""), F.lit(None).cast("string"), check_type=False)
    return fetches(spark, sf).select("page_id", code.alias("code")).filter(F.col("code") != fixed.STATUS_OK)


@query(
    "flt3_content_type",
    f"WITH {FETCH_CTE} SELECT page_id, CASE WHEN content_type LIKE '%text/html%' THEN '0200' ELSE '1001' END AS code FROM fetches",
)
def flt3(spark, sf):
    code = st.fetch_status(F.lit(""), F.lit(200), F.col("content_type"), F.lit(None).cast("string"))
    return fetches(spark, sf).select("page_id", code.alias("code"))


@query("flt4_empty_text", f"WITH {TEXT_CTE} SELECT page_id, CASE WHEN clean_text = '' THEN '2000' ELSE '0200' END AS code FROM texts")
def flt4(spark, sf):
    df = spread(fetches(spark, sf)).select("page_id", hx.title(F.col("html")).alias("t"), hx.visible_text(F.col("html")).alias("v"))
    text = hx.clean_text(F.col("t"), F.col("v"))
    return df.select("page_id", st.text_status(F.lit(fixed.STATUS_OK), text).alias("code"))


@query("flt5_failures", f"WITH {FETCH_CTE} SELECT page_id, CASE WHEN error IS NULL THEN '0200' ELSE '2001' END AS code FROM fetches")
def flt5(spark, sf):
    code = st.fetch_status(F.lit(""), F.lit(200), F.lit("text/html"), F.col("error"))
    return fetches(spark, sf).select("page_id", code.alias("code"))


@query("flt6_classify_fetch", f"WITH {TEXT_CTE} SELECT page_id, {SQL_TEXT_CODE} AS status_code FROM texts")
def flt6(spark, sf):
    return extract_pages(fetches(spark, sf)).select("page_id", "status_code")


@query(
    "flt7_valid_failed_split",
    f"""WITH {TEXT_CTE}, c AS (SELECT page_id, {SQL_TEXT_CODE} AS status_code FROM texts)
    SELECT page_id, status_code, CASE WHEN status_code = '0200' THEN 'page' ELSE 'failed' END AS side FROM c""",
)
def flt7(spark, sf):
    coded = extract_pages(fetches(spark, sf)).select("page_id", "status_code")
    return st.valid_rows(coded).withColumn("side", F.lit("page")).unionByName(
        st.failed_rows(coded).withColumn("side", F.lit("failed"))
    )


@query(
    "agg16_count_by_status",
    f"WITH {TEXT_CTE}, c AS (SELECT {SQL_TEXT_CODE} AS status_code FROM texts) SELECT status_code, count(*) AS n FROM c GROUP BY ALL",
)
def agg16(spark, sf):
    return st.count_by_status(extract_pages(fetches(spark, sf)))


# ---- records ---------------------------------------------------------------------------
LABEL_CTE = "labelled AS (SELECT page_id, url, html, '#Event' || CAST(page_id % 4 AS STRING) || '#x' AS name FROM pages)"


def flat_pages(spark, sf):
    """Flat record columns that need no text work, one row per page."""
    p = table(spark, sf, "pages").withColumn("name", F.concat(F.lit("#Event"), (F.col("page_id") % 4).cast("string"), F.lit("#x")))
    return p.select(
        rc.row_key(F.col("url"), F.col("page_id").cast("string")).alias("row_key"),
        F.lit(fixed.DOC_TYPE).alias("doc_type"), F.lit("7").alias("collection_id"), F.col("name").alias("collection_name"),
        F.lit(fixed.DATABASE).alias("database"), F.lit(fixed.SOURCE).alias("source"),
        "url", hx.title(F.col("html")).alias("title"), F.lit(fixed.STATUS_OK).alias("status_code"),
        tx.clean_control(F.col("html")).alias("clean_text"), F.array(F.lit("a"), F.lit("b")).alias("tokens"),
        event_label(F.col("name")).alias("real_world_events"), "page_id",
    )


SQL_FLAT = f"""WITH {LABEL_CTE} SELECT url || '-' || CAST(page_id AS STRING) AS row_key, 'webpage' AS doc_type, '7' AS collection_id,
  name AS collection_name, '{fixed.DATABASE}' AS database, '{fixed.SOURCE}' AS source, url, length(html) AS n_chars,
  '0200' AS status_code, 'a,b' AS tokens, replace(name, '#', '') AS real_world_events FROM labelled"""


def _summary(df, spark=None):
    return df.select(
        "row_key", "doc_type", "collection_id", "collection_name", "database", "source", "url",
        F.length("clean_text").cast("bigint").alias("n_chars"), "status_code", "tokens", "real_world_events",
    )


@query("prj1_assemble_record", SQL_FLAT)
def prj1(spark, sf):
    record = rc.assemble_record(flat_pages(spark, sf))
    return _summary(rc.flatten_record(record).withColumn("tokens", F.array_join("tokens", ",")))


@query("prj2_row_key", "SELECT page_id, url || '-' || CAST(page_id AS STRING) AS row_key FROM pages")
def prj2(spark, sf):
    return flat_pages(spark, sf).select("page_id", "row_key")


@query(
    "prj3_constant_tags",
    f"SELECT page_id, 'webpage' AS doc_type, '{fixed.DATABASE}' AS database, '{fixed.SOURCE}' AS source FROM pages",
)
def prj3(spark, sf):
    return flat_pages(spark, sf).select("page_id", "doc_type", "database", "source")


@query("prj4_event_label", f"WITH {LABEL_CTE} SELECT page_id, replace(name, '#', '') AS label FROM labelled")
def prj4(spark, sf):
    return flat_pages(spark, sf).select("page_id", F.col("real_world_events").alias("label"))


@query("prj5_add_event_info", "SELECT page_id, url, 'db' AS database, 'feed' AS source, 'flood' AS event FROM pages")
def prj5(spark, sf):
    return tb.add_event_info(table(spark, sf, "pages").select("page_id", "url"), "db", "feed", "flood")


@query(
    "prj6_error_records",
    f"""WITH {TEXT_CTE}, c AS (SELECT *, {SQL_TEXT_CODE} AS status_code FROM texts)
    SELECT url || '-' || stamp AS row_key, url, status_code, CASE WHEN url LIKE '%.jpg' THEN 'image/jpg'
      WHEN status_code IN ('1001', '2000') THEN content_type ELSE '' END AS mime_type, CAST(NULL AS STRING) AS title
    FROM c WHERE status_code <> '0200'""",
)
def prj6(spark, sf):
    from pagemill.plans.clean import clean_flat

    return st.failed_rows(clean_flat(fetches(spark, sf))).select("row_key", "url", "status_code", "mime_type", "title")


# ---- sources and sinks -------------------------------------------------------------------
@query("src1_url_list", "SELECT url FROM pages")
def src1(spark, sf):
    path = scratch_path(spark, "urls")
    lines = table(spark, sf, "pages").select(F.explode(F.array(F.concat(F.lit(" "), "url", F.lit("\r")), F.lit("  "))).alias("value"))
    lines.write.text(path)
    return src.read_url_list(spark, path)


@query("src3_stored_fetches", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def src3(spark, sf):
    return src.read_fetches(spark, f"{sf}/pages.parquet").select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


def warc_file(spark, sf, name):
    """The page table as an archive."""
    path = scratch_path(spark, name)
    pages = spread(table(spark, sf, "pages")).select(
        F.col("url").alias("target_uri"), F.timestamp_seconds(F.col("page_id") + 1704067200).alias("warc_date"),
        F.lit("text/html").alias("http_content_type"), F.encode("html", "UTF-8").alias("payload"),
    )
    warc.write_warc(pages, path)
    return path


def _warc(spark, sf, name):
    # Small ranges, so that records have to be found inside a file.
    return warc.read_warc(spark, warc_file(spark, sf, name), split_bytes=50_000)


SQL_WARC = """SELECT url, 1704067200 + page_id AS seconds, 'application/http; msgtype=response' AS content_type,
  200 AS http_status, 'text/html' AS http_content_type, md5(html) AS digest FROM pages"""


def _warc_columns(df):
    return df.select(
        F.col("target_uri").alias("url"), F.unix_timestamp("warc_date").alias("seconds"), "content_type",
        F.col("http_status").cast("bigint").alias("http_status"), "http_content_type", F.md5("payload").alias("digest"),
    )


@query("src4_warc_records", SQL_WARC)
def src4(spark, sf):
    return _warc_columns(_warc(spark, sf, "warc"))


# In every page a complete record of its own, with a length that fits.
FAKE_RECORD = ["", "", "WARC/1.0", "WARC-Type: response", "WARC-Target-URI: http://not.there/", "Content-Length: 3", "", "xyz"]


@query("src4_plain_archive", f"SELECT url, md5(html || array_to_string({sql_list(FAKE_RECORD)}, chr(13) || chr(10))) AS digest FROM pages")
def src4_plain(spark, sf):
    """An archive without compression, cut into small ranges."""
    path = scratch_path(spark, "warc-plain")
    fake = "\r\n".join(FAKE_RECORD)
    pages = spread(table(spark, sf, "pages")).select(
        F.col("url").alias("target_uri"), F.timestamp_seconds(F.col("page_id") + 1704067200).alias("warc_date"),
        F.lit("text/html").alias("http_content_type"), F.encode(F.concat("html", F.lit(fake)), "UTF-8").alias("payload"),
    )
    warc.write_warc(pages, path, compression="none")
    found = warc.read_warc(spark, path, split_bytes=20_000)
    return found.select(F.col("target_uri").alias("url"), F.md5("payload").alias("digest"))


@query("src5_warc_responses", SQL_WARC)
def src5(spark, sf):
    return _warc_columns(warc.response_records(_warc(spark, sf, "warc")))


@query("snk8_warc_writer", "SELECT count(*) AS records, CAST(sum(strlen(html)) AS BIGINT) AS bytes FROM pages")
def snk8(spark, sf):
    return _warc(spark, sf, "warc").agg(
        F.count("*").alias("records"), F.sum(F.octet_length("payload")).cast("bigint").alias("bytes")
    )


@query(
    "src6_select_columns",
    "SELECT url AS long_url, CAST(page_id % 4 AS STRING) AS collection_id, CAST(page_id AS STRING) AS tweet_id FROM pages",
)
def src6(spark, sf):
    stored = table(spark, sf, "pages").select(
        F.struct(F.col("url").alias("long_url"), F.col("html").alias("text")).alias("clean_tweet"),
        F.struct((F.col("page_id") % 4).cast("string").alias("collection_id"), F.col("page_id").cast("string").alias("tweet_id")).alias("tweet"),
    )
    path = scratch_path(spark, "store")
    stored.write.parquet(path)
    return src.select_columns(spark.read.parquet(path), ["clean-tweet:long-url", "tweet:collection-id", "tweet:tweet-id"])


@query("src7_scan_where", f"WITH {LABEL_CTE} SELECT page_id, url FROM labelled WHERE name = '#Event2#x'")
def src7(spark, sf):
    path = scratch_path(spark, "store")
    df = flat_pages(spark, sf)
    df.select("page_id", F.struct("collection_name").alias("metadata"), F.struct("url").alias("webpage")).write.parquet(path)
    return src.scan_where(spark.read.parquet(path), "metadata", "collection-name", "#Event2#x").select("page_id", "webpage.url")


SQL_URL_HTML = "SELECT url, translate(html, ',' || chr(10) || chr(13), '') AS html FROM pages"


@query("src8_url_html_csv", SQL_URL_HTML)
def src8(spark, sf):
    path = scratch_path(spark, "url-html")
    snk.write_url_html_csv(table(spark, sf, "pages"), path)
    return src.read_url_html_csv(spark, path, header=True)


@query("snk5_url_html_rows", SQL_URL_HTML)
def snk5(spark, sf):
    return snk.url_html_rows(table(spark, sf, "pages"))


@query(
    "src10_word_list",
    "SELECT DISTINCT trim(w) AS word FROM (SELECT unnest(string_split(translate(text, chr(10), ' '), ' ')) AS w FROM benchmark) WHERE trim(w) <> ''",
)
def src10(spark, sf):
    path = scratch_path(spark, "words")
    words = table(spark, sf, "benchmark").select(F.explode(F.split(F.translate("text", "\n", " "), " ")).alias("w"))
    words.select(F.concat("w", F.lit("\r"))).write.text(path)
    return src.read_words(spark, path).distinct()


DIMENSION = {"click": "11", "view": "12", "purchase": "13"}
SQL_DIMENSION = """SELECT event_id, event_type, CASE event_type WHEN 'click' THEN '11' WHEN 'view' THEN '12'
  WHEN 'purchase' THEN '13' END AS collection_id FROM events"""


@query("src11_collection_dimension", "SELECT event_type AS collection_name, any_value(CASE event_type WHEN 'click' THEN '11' WHEN 'view' THEN '12' WHEN 'purchase' THEN '13' END) AS collection_id FROM events GROUP BY event_type")
def src11(spark, sf):
    names = table(spark, sf, "events").select(F.col("event_type").alias("collection_name")).distinct()
    return src.with_collection_id(names, src.collections_table(spark, DIMENSION))


@query("jn2_collection_id_join", SQL_DIMENSION)
def jn2(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return src.with_collection_id(events, src.collections_table(spark, DIMENSION), "event_type")


def _saved_model(spark, sf):
    path = scratch_path(spark, "model")
    if src.load_model(spark, path) is None:
        snk.save_model(build_topic_model(model_docs(spark, sf)), path)
    return src.load_model(spark, path)


SQL_MODEL = f"WITH {TOPIC_CTE} SELECT term, round(weight, 9) AS weight FROM model"


@query("src12_load_model", SQL_MODEL)
def src12(spark, sf):
    return _saved_model(spark, sf).select("term", F.round("weight", 9).alias("weight"))


@query("snk12_save_model", f"WITH {TOPIC_CTE} SELECT count(*) AS terms, CAST(sum(score) AS BIGINT) AS score FROM model")
def snk12(spark, sf):
    return _saved_model(spark, sf).agg(F.count("*").alias("terms"), F.sum("score").alias("score"))


@query("snk1_tsv", SQL_FLAT)
def snk1(spark, sf):
    path = scratch_path(spark, "tsv")
    snk.write_tsv(rc.assemble_record(flat_pages(spark, sf)), path)
    back = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("maxCharsPerColumn", -1).csv(path)
    return _summary(back)


@query("snk2_family_table", SQL_FLAT)
def snk2(spark, sf):
    path = scratch_path(spark, "families")
    snk.write_family_table(rc.assemble_record(flat_pages(spark, sf)), path)
    return _summary(rc.flatten_record(spark.read.parquet(path)).withColumn("tokens", F.array_join("tokens", ",")))


@query(
    "snk3_family_files",
    f"""WITH flat AS ({SQL_FLAT}) SELECT 'metadata' AS family, row_key, collection_name AS value FROM flat
    UNION ALL SELECT 'webpage', row_key, url FROM flat UNION ALL SELECT 'clean_webpage', row_key, tokens FROM flat""",
)
def snk3(spark, sf):
    path = scratch_path(spark, "family-files")
    snk.write_family_files(rc.assemble_record(flat_pages(spark, sf)), path)
    out = None
    for family, column in (("metadata", "collection_name"), ("webpage", "url"), ("clean_webpage", "tokens")):
        back = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("maxCharsPerColumn", -1).csv(f"{path}/{family}")
        part = back.select(F.lit(family).alias("family"), "row_key", F.col(column).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


SQL_SUMMARY = f"""WITH {TEXT_CTE} SELECT translate(url, ',' || chr(10) || chr(13), '') AS "URL",
  translate(html, ',' || chr(10) || chr(13), '...') AS "Raw", translate(clean_text, ',' || chr(10) || chr(13), '...') AS "Text"
  FROM texts WHERE clean_text <> ''"""


def _texts(spark, sf):
    df = spread(fetches(spark, sf)).select("url", "html", hx.title(F.col("html")).alias("title"), hx.visible_text(F.col("html")).alias("v"))
    return df.select("url", "html", "title", hx.clean_text(F.col("title"), F.col("v")).alias("clean_text")).filter("clean_text <> ''")


@query("snk4_summary_csv", SQL_SUMMARY)
def snk4(spark, sf):
    path = scratch_path(spark, "summary")
    snk.write_summary_csv(_texts(spark, sf), path)
    return spark.read.option("header", True).option("quote", "").option("escape", "").option("maxCharsPerColumn", -1).csv(path)


@query("snk6_json", f"WITH {TEXT_CTE} SELECT url, title, clean_text FROM texts WHERE clean_text <> ''")
def snk6(spark, sf):
    path = scratch_path(spark, "json")
    snk.write_json(_texts(spark, sf).drop("html"), path)
    return spark.read.schema("url string, title string, clean_text string").json(path)


@query(
    "snk7_page_files",
    f"""WITH {TEXT_CTE} SELECT translate(translate(string_split(url, '://')[2], '/ ?,<>', '______'), ':' || chr(13) || chr(10), '') AS file_name,
    replace(clean_text, chr(10), '.') AS text FROM texts WHERE clean_text <> ''""",
)
def snk7(spark, sf):
    path = scratch_path(spark, "page-files")
    snk.write_page_files(_texts(spark, sf), path)
    return spark.read.text(path, wholetext=True).select(
        F.url_decode(F.element_at(F.split("_metadata.file_path", "/"), -1)).alias("file_name"), F.col("value").alias("text")
    )


@query("snk13_run_counters", "SELECT count(*) AS rows FROM pages")
def snk13(spark, sf):
    path = scratch_path(spark, "counted")
    seen = snk.run_counters(table(spark, sf, "pages"), lambda df: df.write.parquet(path))
    return spark.createDataFrame([(int(seen["rows"]),)], "rows bigint")


# ---- sets ----------------------------------------------------------------------------------
@query("set1_concatenate", "SELECT url FROM pages UNION ALL SELECT url FROM pages UNION ALL SELECT 'https://x/' || source FROM documents")
def set1(spark, sf):
    pages = table(spark, sf, "pages").select("url")
    return tb.concatenate(pages, pages, table(spark, sf, "documents").select(F.concat(F.lit("https://x/"), "source").alias("url")))


@query(
    "set2_merge_schemas",
    "SELECT doc_id, lang, CAST(NULL AS INT) AS quality FROM documents UNION ALL SELECT doc_id, NULL, quality FROM labels",
)
def set2(spark, sf):
    return tb.merge_schemas(
        table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels").select("doc_id", "quality")
    )


@query("set3_success_and_failure", f"WITH {FETCH_CTE} SELECT page_id, {SQL_CODE} AS status_code FROM fetches")
def set3(spark, sf):
    code = st.fetch_status(F.col("url"), F.col("status"), F.col("content_type"), F.col("error"))
    coded = fetches(spark, sf).select("page_id", code.alias("status_code"))
    return tb.concatenate(st.valid_rows(coded), st.failed_rows(coded))


@query("set4_distinct_union", "SELECT source AS url FROM documents UNION SELECT event_type FROM events")
def set4(spark, sf):
    return tb.distinct_union(
        table(spark, sf, "documents").select(F.col("source").alias("url")), table(spark, sf, "events").select(F.col("event_type").alias("url"))
    )


@query(
    "agg15_last_write_wins",
    "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id",
)
def agg15(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "value", "ts")
    return tb.latest_by_key(events, "user_id", F.struct("ts", "event_id")).select("user_id", "event_id", "value")

"""Composite jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.catalog.base import (
    FETCH_CTE, MODEL_STOP, PHRASES, SCORED_CTE, SQL_TEXT_CODE, STOP, TEXT_CTE, TOKEN_CTE, TOPIC_CTE, TWEET_CTE,
    fetches, model_docs, query, scored, sql_list, sql_mask, sql_model_words, sql_stems, sql_title, sql_tokens, sql_visible,
    sql_words, table, tweets,
)
from pagemill.catalog.documents import (
    GAZETTEER_CTE, GRAM_CTE, LEMMA_CTE, LEXICON_CTE, LINK_TERM_CTE, LOCATION_CTE, SQL_FALLBACK, TAG_CTE, gazetteer, lemma_table, lexicon,
    page_link_rows, places,
)
from pagemill.catalog.markup import META_CTE, META_HTML, SQL_DATE_NAMES, SQL_DOMAIN, SQL_LOCATION, _last
from pagemill.catalog.records import warc_file
from pagemill.catalog.scoring import graph_links, graph_pages
from pagemill.functions import html as hx
from pagemill.functions.arrays import term_counts
from pagemill.operators import tables as tb
from pagemill.operators.language import SMOOTHING, train_profiles
from pagemill.operators.versions import VersionedTable
from pagemill.plans import clean as cl
from pagemill.plans import evaluate as ev
from pagemill.plans import frontier as fr
from pagemill.plans import relevance as rv
from pagemill.session import scratch_path, settle

CTL = "chr(10) || chr(13) || chr(9)"

# ---- fetches whose pages carry meta tags ------------------------------------------------
_RICH_FETCH = FETCH_CTE.replace("fetches AS", "plain AS") + f""",
fetches AS (SELECT page_id, url, status, content_type, error, stamp, {META_HTML} AS html FROM plain)"""
RICH_CTE = TEXT_CTE.replace(FETCH_CTE, _RICH_FETCH) + f""",
coded AS (SELECT *, {SQL_TEXT_CODE} AS status_code, {sql_mask('clean_text')} AS masked FROM texts)"""
_RICH_META = META_CTE.split(",\nfound AS")[1].replace(" FROM mp)", " FROM coded)")
RECORD_CTE = f"""{RICH_CTE}, found AS{_RICH_META},
metas AS (SELECT page_id, {_last("name = 'author'")} AS author, {_last("name = 'copyright'")} AS organization_name,
  {_last(SQL_DATE_NAMES)} AS create_time, {_last("name = 'keywords'")} AS keywords,
  {_last("name = 'og:url' OR property = 'og:url'")} AS og FROM tags GROUP BY page_id),
domains AS (SELECT *, {SQL_DOMAIN} AS domain_name FROM coded)"""


def rich_fetches(spark, sf):
    return fetches(spark, sf).withColumn("html", F.expr(META_HTML))


def _options(**more):
    return cl.CleanOptions(phrases=PHRASES, collection_name="#Harbour Fire", collection_id="31", **more)


@query(
    "job1_page_summary",
    f"""WITH {TEXT_CTE}, c AS (SELECT *, {SQL_TEXT_CODE} AS status_code, {SQL_DOMAIN} AS domain FROM texts)
    SELECT page_id, status_code, CASE WHEN status_code = '0200' THEN title END AS title,
    CASE WHEN status_code = '0200' THEN domain END AS domain_name,
    CASE WHEN status_code = '0200' THEN {SQL_LOCATION.format('domain')} END AS domain_location,
    CASE WHEN status_code = '0200' THEN len({sql_tokens('clean_text')}) END AS n_tokens FROM c""",
)
def job1_summary(spark, sf):
    stored = fetches(spark, sf).withColumn("stamp", F.col("page_id").cast("string"))
    flat = cl.clean_flat(stored)
    return flat.select(
        F.col("fetch_time").cast("bigint").alias("page_id"), "status_code", "title", "domain_name", "domain_location",
        F.size("tokens").cast("bigint").alias("n_tokens"),
    )


@query(
    "job1_clean_pages",
    f"""WITH {RECORD_CTE}
    SELECT CASE WHEN status_code = '0200' THEN coalesce(nullif(og, ''), url) ELSE url END || '-' || stamp AS row_key, status_code,
    CASE WHEN url LIKE '%.jpg' THEN 'image/jpg' WHEN status_code IN ('0200', '1001', '2000') THEN content_type ELSE '' END AS mime_type,
    CASE WHEN status_code = '0200' THEN translate(title, {CTL}, '...') END AS title,
    CASE WHEN status_code = '0200' THEN author END AS author,
    CASE WHEN status_code = '0200' THEN organization_name END AS organization_name,
    CASE WHEN status_code = '0200' THEN create_time END AS create_time,
    CASE WHEN status_code = '0200' THEN keywords END AS keywords,
    CASE WHEN status_code = '0200' THEN domain_name END AS domain_name,
    CASE WHEN status_code = '0200' THEN {SQL_LOCATION.format('domain_name')} END AS domain_location,
    CASE WHEN status_code = '0200' THEN translate(clean_text, {CTL}, '...') END AS clean_text,
    CASE WHEN status_code = '0200' THEN translate(masked, {CTL}, '...') END AS clean_text_profanity,
    CASE WHEN status_code = '0200' THEN array_to_string({sql_tokens('masked')}, ',') END AS tokens,
    CASE WHEN status_code = '0200' THEN 'Harbour Fire' END AS real_world_events
    FROM domains LEFT JOIN metas USING (page_id)""",
)
def job1(spark, sf):
    record = cl.clean_pages(rich_fetches(spark, sf), _options())
    return record.select(
        "row_key", "webpage.status_code", "webpage.mime_type", "webpage.title", "webpage.author", "webpage.organization_name",
        "webpage.create_time", "clean_webpage.keywords", "webpage.domain_name", "webpage.domain_location",
        "clean_webpage.clean_text", "clean_webpage.clean_text_profanity",
        F.array_join("clean_webpage.tokens", ",").alias("tokens"), "clean_webpage.real_world_events",
    )


PAGE_TOKEN_CTE = f"""{RICH_CTE},
docs AS (SELECT page_id AS doc_id, stamp, status_code, {sql_tokens('masked')} AS tokens FROM coded WHERE status_code = '0200'),
tok AS (SELECT doc_id, generate_subscripts(tokens, 1) - 1 AS pos, unnest(tokens) AS token FROM docs)"""


def _kind(kind):
    return f"coalesce(string_agg(token, ';' ORDER BY pos) FILTER (WHERE tag = '{kind}'), '')"


@query(
    "job1_full_record",
    f"""WITH {TAG_CTE.replace(TOKEN_CTE, PAGE_TOKEN_CTE)}, {LEMMA_CTE}, {LEXICON_CTE.replace('lexicon AS', 'lex AS')}, {sql_stems('tok')}
    SELECT stamp AS fetch_time, string_agg(stem, ',' ORDER BY pos) AS stemmed, string_agg(coalesce(lemma, token), ',' ORDER BY pos) AS lemmatized,
    string_agg(token || ':' || coalesce(lex.tag, {SQL_FALLBACK}), ',' ORDER BY pos) AS pos,
    {_kind('PERSON').replace('tag =', 'g.tag =').replace('token, ', 'token, ')} AS ner_people,
    {_kind('ORGANIZATION').replace('tag =', 'g.tag =')} AS ner_organization, {_kind('LOCATION').replace('tag =', 'g.tag =')} AS ner_location
    FROM docs JOIN tagged g USING (doc_id) JOIN st_stems USING (token) LEFT JOIN lemmas ON form = token LEFT JOIN lex USING (token)
    GROUP BY stamp""",
)
def job1_full(spark, sf):
    options = _options(
        lemmas=lemma_table(spark, sf), lexicon=lexicon(spark, sf), gazetteer=gazetteer(spark, sf)
    )
    flat = cl.clean_flat(rich_fetches(spark, sf), options).filter(F.col("status_code") == fixed.STATUS_OK)
    comma = lambda c: F.array_join(c, ",").alias(c)
    semi = lambda c: F.array_join(c, ";").alias(c)
    return flat.select(
        "fetch_time", comma("stemmed"), comma("lemmatized"), comma("pos"), semi("ner_people"), semi("ner_organization"),
        semi("ner_location"),
    )


@query(
    "job1_language",
    f"""WITH {GRAM_CTE}, {TEXT_CTE}, coded AS (SELECT *, {SQL_TEXT_CODE} AS status_code FROM texts),
    plw AS (SELECT page_id, unnest(list_transform({sql_words('clean_text')}, lambda w: ' ' || lower(w) || ' ')) AS w FROM coded WHERE status_code = '0200'),
    pwc AS (SELECT page_id, w, count(*) AS n FROM plw GROUP BY ALL),
    pwg AS (SELECT w, g, count(*) AS k FROM (SELECT w, substr(w, i, n) AS g FROM (SELECT w, n, unnest(range(1, length(w) - n + 2)) AS i
      FROM (SELECT DISTINCT w FROM pwc), (VALUES (1), (2), (3)) v(n))) GROUP BY ALL),
    pdg AS (SELECT page_id, g, CAST(sum(n * k) AS BIGINT) AS tf FROM pwc JOIN pwg USING (w) GROUP BY ALL),
    pscores AS (SELECT page_id, tot.lang AS cand, sum(tf * coalesce(lp, ln({SMOOTHING} / t))) AS s
      FROM pdg CROSS JOIN tot LEFT JOIN logp ON logp.g = pdg.g AND logp.cand = tot.lang GROUP BY ALL),
    best AS (SELECT page_id, max(s) AS m FROM pscores GROUP BY page_id),
    pw2 AS (SELECT page_id, cand, exp(s - m) AS w FROM pscores JOIN best USING (page_id)),
    pp AS (SELECT page_id, cand, w / sum(w) OVER (PARTITION BY page_id) AS p FROM pw2),
    j AS (SELECT page_id, string_agg(cand, ',' ORDER BY p DESC, cand DESC) AS language FROM pp WHERE p >= 0.1 GROUP BY page_id)
    SELECT url || '-' || stamp AS row_key, status_code, CASE WHEN status_code = '0200' THEN coalesce(language, '') END AS language
    FROM coded LEFT JOIN j USING (page_id)""",
)
def job1_language(spark, sf):
    """Language column of the page record, trained on the labelled documents."""
    options = _options(profiles=train_profiles(table(spark, sf, "documents")))
    flat = cl.clean_flat(fetches(spark, sf), options)
    return flat.select("row_key", "status_code", F.array_join("language", ",").alias("language"))


@query(
    "job2_tweet_pages",
    f"""WITH {TWEET_CTE}, {TEXT_CTE}, c AS (SELECT *, {SQL_TEXT_CODE} AS status_code FROM texts),
    t AS (SELECT url, arg_min(collection_id, seq) AS collection_id, arg_min(collection_name, seq) AS collection_name,
      string_agg(tweet_id, ',' ORDER BY seq) AS tweet_ids FROM tweets GROUP BY url)
    SELECT c.url || '-' || stamp AS row_key, status_code, '{fixed.TWEET_DATABASE}' AS database, collection_id, collection_name, tweet_ids,
    CASE WHEN status_code = '0200' THEN replace(collection_name, '#', '') END AS real_world_events,
    CASE WHEN status_code = '0200' THEN array_to_string({sql_tokens('clean_text')}, ',') END AS tokens
    FROM c JOIN t ON c.url = t.url""",
)
def job2(spark, sf):
    record = cl.clean_tweet_pages(tweets(spark, sf), fetches(spark, sf))
    return record.select(
        "row_key", "webpage.status_code", "metadata.database", "metadata.collection_id", "metadata.collection_name",
        F.array_join("webpage.tweet_ids", ",").alias("tweet_ids"), "clean_webpage.real_world_events",
        F.array_join("clean_webpage.tokens", ",").alias("tokens"),
    )


@query(
    "job2_tweet_ids",
    f"""WITH {TWEET_CTE}, {FETCH_CTE}, hot AS (SELECT tweet_id, seq, CASE WHEN seq % 3 = 0 THEN (SELECT min(url) FROM fetches) ELSE url END AS url FROM tweets),
    t AS (SELECT *, count(*) OVER (PARTITION BY url) AS n_tweets, (row_number() OVER (PARTITION BY url ORDER BY seq) - 1) // 3 AS chunk FROM hot)
    SELECT f.url || '-' || stamp AS row_key, n_tweets, chunk, string_agg(tweet_id, ',' ORDER BY seq) AS tweet_ids
    FROM fetches f JOIN t ON f.url = t.url GROUP BY ALL""",
)
def job2_ids(spark, sf):
    """All tweet ids of the records, three in a row; one page has a third of them."""
    stored = fetches(spark, sf)
    hottest = stored.agg(F.min("url")).first()[0]
    hot = tweets(spark, sf).withColumn("url", F.when(F.col("seq") % 3 == 0, hottest).otherwise(F.col("url")))
    _, ids = cl.clean_tweet_tables(hot, stored, ids_per_row=3)
    return ids.withColumn("tweet_ids", F.array_join("tweet_ids", ","))


_ALL_PAGES = TEXT_CTE.replace(FETCH_CTE, "fetches AS (SELECT * FROM pages)")


@query(
    "job3_warc_pages",
    f"""WITH {_ALL_PAGES} SELECT url || '-' || strftime(to_timestamp(1704067200 + page_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS row_key,
    '3200' AS status_code, 'application/http; msgtype=response' AS mime_type, translate(title, {CTL}, '...') AS title,
    array_to_string({sql_tokens('clean_text')}, ',') AS tokens FROM texts""",
)
def job3(spark, sf):
    record = cl.clean_warc(spark, warc_file(spark, sf, "warc-job"), split_bytes=50_000)
    return record.select(
        "row_key", "webpage.status_code", "webpage.mime_type", "webpage.title", F.array_join("clean_webpage.tokens", ",").alias("tokens")
    )


@query("job4_topic_model", f"WITH {TOPIC_CTE} SELECT term, df, cf, score, round(weight, 9) AS weight FROM model")
def job4(spark, sf):
    return rv.build_topic_model(model_docs(spark, sf)).withColumn("weight", F.round("weight", 9))


# ---- event model: documents with a publication date each --------------------------------
PUB_DATE = "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE DATE '2024-01-10' END"


def event_docs(spark, sf):
    day = F.to_timestamp(F.lit("2024-01-10")) + F.make_dt_interval((F.col("doc_id") % 45).cast("int"))
    return model_docs(spark, sf).withColumn("pub_date", F.when(F.col("doc_id") % 5 != 0, day))


EVENT_CTE = f"""{TOPIC_CTE}, {LOCATION_CTE},
dlw AS (SELECT term, weight, list_transform(list_filter(regexp_extract_all(term, '[\\p{{L}}\\p{{N}}_]+'),
  lambda t: length(t) > 2 AND NOT list_contains({sql_list(STOP[:-1] + fixed.MODEL_STOP_WORDS)}, t)), lambda t: lower(t)) AS words FROM locs),
dlt AS (SELECT weight, unnest(words) AS token FROM dlw), {sql_stems('dlt', 'dl')},
loctok AS (SELECT stem AS term, sum(weight) AS weight FROM dlt JOIN dl_stems USING (token)
  WHERE NOT list_contains({sql_list(STOP[:-1] + fixed.MODEL_STOP_WORDS)}, stem) GROUP BY stem),
pub AS (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN doc_id % 45 END AS day FROM documents),
evd AS (SELECT min(day) AS day0 FROM pub)"""


@query(
    "job5_event_model",
    f"""WITH {EVENT_CTE} SELECT 'topic' AS part, term, round(weight, 9) AS weight FROM model
    UNION ALL SELECT 'location', term, round(weight, 9) FROM locs UNION ALL SELECT 'location_token', term, round(weight, 9) FROM loctok
    UNION ALL SELECT 'event_date', strftime(DATE '2024-01-10' + CAST(day0 AS INTEGER), '%Y-%m-%d'), 0.0 FROM evd""",
)
def job5(spark, sf):
    model = rv.build_event_model(event_docs(spark, sf), places(spark))
    parts = [("topic", model.topic), ("location", model.locations), ("location_token", model.location_tokens)]
    out = spark.createDataFrame([("event_date", model.event_date.strftime("%Y-%m-%d"), 0.0)], "part string, term string, weight double")
    for name, frame in parts:
        out = out.unionByName(frame.select(F.lit(name).alias("part"), "term", F.round("weight", 9).alias("weight")))
    return out


@query(
    "job6_event_page_scores",
    f"""WITH {EVENT_CTE},
    td AS (SELECT doc_id, sum(tf * weight) AS dot FROM tf JOIN model USING (term) GROUP BY doc_id),
    tn AS (SELECT doc_id, sqrt(sum(tf * tf)) AS norm FROM tf GROUP BY doc_id),
    lc AS (SELECT doc_id, entity AS term, count(*) AS tf FROM mentions GROUP BY ALL),
    ld AS (SELECT doc_id, sum(tf * weight) AS dot FROM lc JOIN locs USING (term) GROUP BY doc_id),
    ln AS (SELECT doc_id, sqrt(sum(tf * tf)) AS norm FROM lc GROUP BY doc_id),
    s AS (SELECT doc_id, coalesce(td.dot / (tn.norm * (SELECT sqrt(sum(weight * weight)) FROM model)), 0.0) AS topic,
      coalesce(ld.dot / (ln.norm * (SELECT sqrt(sum(weight * weight)) FROM locs)), 0.0) AS location, day - day0 AS days
      FROM documents LEFT JOIN td USING (doc_id) LEFT JOIN tn USING (doc_id) LEFT JOIN ld USING (doc_id) LEFT JOIN ln USING (doc_id)
      LEFT JOIN pub USING (doc_id) CROSS JOIN evd)
    SELECT doc_id, round(CASE WHEN days IS NULL THEN 0.4 / (0.4 + 0.2) * topic + 0.2 / (0.4 + 0.2) * location
      WHEN days >= 30 THEN 0.0 ELSE 0.4 * topic + 0.2 * location + 0.4 END, 9) AS score FROM s""",
)
def job6_pages(spark, sf):
    # Stems and mentions serve the model and the scores: made once.
    docs = settle(event_docs(spark, sf).select("doc_id", "text", "tokens", "pub_date"), "event-docs")
    mentions = settle(rv.location_mentions(docs, places(spark)), "mentions")
    model = rv.build_event_model(docs, places(spark), mentions=mentions)
    # Of the tokens only the topic score goes into the join with the mentions.
    scorer = rv.EventScorer(model)
    topical = scorer.with_topic(docs.select("doc_id", "pub_date", term_counts(F.col("tokens")).alias("terms")), "doc_id").drop("terms")
    return scorer.page_scores(rv.with_locations(topical, mentions), "doc_id").select("doc_id", F.round("score", 9).alias("score"))


DATED_LINK_CTE = LINK_TERM_CTE.replace("(url || href)", "('http://a.org/2024/01/' || lpad(CAST(1 + page_id % 28 AS STRING), 2, '0') || '/' || url || href)")


@query(
    "mth7_event_link_scores",
    f"""WITH {EVENT_CTE}, {DATED_LINK_CTE}, ltf AS (SELECT page_id, pos, term, count(*) AS tf FROM ltok GROUP BY ALL),
    ln2 AS (SELECT page_id, pos, sqrt(sum(tf * tf)) AS norm FROM ltf GROUP BY ALL),
    t1 AS (SELECT page_id, pos, sum(tf * weight) AS dot FROM ltf JOIN model USING (term) GROUP BY ALL),
    t2 AS (SELECT page_id, pos, sum(tf * weight) AS dot FROM ltf JOIN loctok USING (term) GROUP BY ALL),
    s AS (SELECT page_id, pos, coalesce(t1.dot / (norm * (SELECT sqrt(sum(weight * weight)) FROM model)), 0.0) AS topic,
      coalesce(t2.dot / (norm * (SELECT sqrt(sum(weight * weight)) FROM loctok)), 0.0) AS location, page_id % 28 - (9 + day0) AS days
      FROM ltext LEFT JOIN ln2 USING (page_id, pos) LEFT JOIN t1 USING (page_id, pos) LEFT JOIN t2 USING (page_id, pos) CROSS JOIN evd)
    SELECT page_id, pos, round(CASE WHEN days < 0 OR days >= 30 THEN 0.0 ELSE 0.4 * topic + 0.2 * location + 0.4 END, 9) AS score FROM s""",
)
def mth7(spark, sf):
    model = rv.build_event_model(event_docs(spark, sf), places(spark))
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    links = page_link_rows(spark, sf).withColumn("href", F.concat(F.lit("http://a.org/2024/01/"), day, F.lit("/"), "href"))
    scored_links = rv.EventScorer(model).link_scores(rv.link_terms(links))
    return scored_links.select("page_id", "pos", F.round("link_score", 9).alias("score"))


# ---- focused expansion ---------------------------------------------------------------------
ONE_ROUND_CTE = """ids AS (SELECT doc_id, source, 'https://' || source || '.example.org/' || CAST(doc_id AS STRING) AS url,
  (doc_id * 37 % 101) / 100.0 AS score FROM documents),
graph AS (SELECT a.url AS src_url, b.url AS dst_url, ((a.doc_id * 13 + k * 29) % 97) / 96.0 AS link_score
  FROM ids a, (VALUES (1), (3), (7)) v(k), ids b WHERE b.doc_id = (a.doc_id * (k + 1) + k) % (SELECT count(*) FROM documents)),
first AS (SELECT url, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS label, row_number() OVER (ORDER BY url) - 1 AS page_id
  FROM ids WHERE source = 'src1'),
counts AS (SELECT string_split(string_split(url, '//')[2], '/')[1] AS domain, 1.0 + sum(label) AS rel, 1.0 + sum(1 - label) AS nonrel FROM first GROUP BY 1),
cand AS (SELECT f.page_id AS parent_id, f.score, f.label, g.dst_url AS url, g.link_score, coalesce(rel, 1.0) / coalesce(nonrel, 1.0) AS ratio
  FROM first f JOIN graph g ON f.url = g.src_url LEFT JOIN counts c ON string_split(string_split(g.dst_url, '//')[2], '/')[1] = c.domain
  WHERE f.score >= 0.1 AND g.dst_url NOT IN (SELECT url FROM first) AND f.score * link_score >= 0.1),
pushed AS (SELECT url, parent_id, CASE WHEN label = 1 THEN score * link_score * ratio ELSE score * link_score END AS score FROM cand)"""


@query(
    "job7_first_round",
    f"""WITH {ONE_ROUND_CTE} SELECT 'page' AS kind, url, page_id AS number, round(score, 9) AS score FROM first
    UNION ALL SELECT 'link', url, parent_id, round(score, 9) FROM pushed WHERE score >= 0.1""",
)
def job7_round(spark, sf):
    """One round from the pages of one source: scored pages and pushed links."""
    pages = graph_pages(spark, sf)
    n = pages.count()
    seeds = pages.filter(F.col("url").startswith("https://src1.example.org/")).select("url")
    out = fr.focused_expand(
        seeds, pages, graph_links(spark, sf), fr.CrawlOptions(page_limit=n, batch=n, max_rounds=1, exact=False)
    )
    return out.scored.select(F.lit("page").alias("kind"), "url", F.col("page_id").alias("number"), F.round("score", 9).alias("score")).unionByName(
        out.frontier.select(F.lit("link").alias("kind"), "url", F.col("parent_id").alias("number"), F.round("score", 9).alias("score"))
    )


ROUNDS, ROUND_PAGES = 4, 500


def rounds_sql() -> str:
    """SQL of a crawl in rounds: what is popped, scored and pushed in each of them."""
    ctes = [ONE_ROUND_CTE.split("first AS")[0].rstrip().rstrip(",")]
    ctes.append("""v0 AS (SELECT url FROM ids WHERE false), s0 AS (SELECT 0 AS page_id, url, 0 AS parent_id, score, 0 AS label FROM ids WHERE false),
    f0 AS (SELECT CAST(1.0 AS DOUBLE) AS score, url, -1 AS parent_id FROM ids WHERE source = 'src1')""")
    for r in range(1, ROUNDS + 1):
        p = r - 1
        ctes.append(f"""o{r} AS MATERIALIZED (SELECT count(*) AS done FROM s{p}),
    p{r} AS MATERIALIZED (SELECT url, max(score) AS score, arg_min(parent_id, (-score, parent_id)) AS parent_id FROM f{p}
      WHERE url NOT IN (SELECT url FROM v{p}) AND (SELECT done FROM o{r}) < {fixed.PAGE_LIMIT}
      GROUP BY url ORDER BY max(score) DESC, url LIMIT {ROUND_PAGES}),
    n{r} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY p.score DESC, url, parent_id) - 1 + (SELECT done FROM o{r}) AS page_id, url, parent_id,
      ids.score, CASE WHEN ids.score >= 0.5 THEN 1 ELSE 0 END AS label FROM p{r} p JOIN ids USING (url)
      QUALIFY page_id < {fixed.PAGE_LIMIT}),
    v{r} AS MATERIALIZED (SELECT * FROM v{p} UNION ALL SELECT url FROM p{r}),
    s{r} AS MATERIALIZED (SELECT * FROM s{p} UNION ALL SELECT * FROM n{r}),
    c{r} AS MATERIALIZED (SELECT string_split(string_split(url, '//')[2], '/')[1] AS domain, 1.0 + sum(label) AS rel, 1.0 + sum(1 - label) AS nonrel
      FROM s{r} GROUP BY 1),
    l{r} AS (SELECT n.page_id AS parent_id, g.dst_url AS url, CASE WHEN n.label = 1 THEN n.score * g.link_score * (coalesce(rel, 1.0) / coalesce(nonrel, 1.0))
      ELSE n.score * g.link_score END AS score FROM n{r} n JOIN graph g ON n.url = g.src_url
      LEFT JOIN c{r} c ON string_split(string_split(g.dst_url, '//')[2], '/')[1] = c.domain
      WHERE n.score >= 0.1 AND n.score * g.link_score >= 0.1 AND g.dst_url NOT IN (SELECT url FROM v{r})),
    f{r} AS MATERIALIZED (SELECT * FROM f{p} UNION ALL SELECT score, url, parent_id FROM l{r} WHERE score >= 0.1)""")
    return f"WITH {', '.join(ctes)} SELECT page_id, url, parent_id, round(score, 9) AS score, label FROM s{ROUNDS}"


@query("job7_focused_expand", rounds_sql())
def job7(spark, sf):
    """Expansion from one source up to the default page limit, in rounds."""
    pages = graph_pages(spark, sf)
    seeds = pages.filter(F.col("url").startswith("https://src1.example.org/")).select("url")
    options = fr.CrawlOptions(batch=ROUND_PAGES, exact=False, max_rounds=ROUNDS)
    scored = fr.focused_expand(seeds, pages, graph_links(spark, sf), options).scored
    return scored.select("page_id", "url", "parent_id", F.round("score", 9).alias("score"), F.col("label"))


EXACT_PAGES = 108
# One page at a time: the state of the heap is a row of lists.
HEAP_SQL = f"""WITH RECURSIVE {ONE_ROUND_CTE.split("first AS")[0].rstrip().rstrip(",")},
crawl AS (SELECT 0 AS step, CAST([] AS VARCHAR[]) AS visited, list({{'neg': CAST(-1.0 AS DOUBLE), 'url': url, 'parent': CAST(-1 AS BIGINT)}}) AS front,
    CAST([] AS STRUCT(page_id BIGINT, url VARCHAR, parent_id BIGINT, score DOUBLE, label BIGINT, domain VARCHAR)[]) AS scored FROM ids WHERE source = 'src1'
  UNION ALL
  SELECT any_value(step) + 1, any_value(list_append(visited, best.url)), list_concat(any_value(front), coalesce(list({{'neg': -total, 'url': dst_url, 'parent': CAST(step AS BIGINT)}})
      FILTER (WHERE best_score >= 0.1 AND plain >= 0.1 AND total >= 0.1), [])), any_value(scored)
  FROM (SELECT *, CASE WHEN label = 1 THEN plain * (1.0 + len(list_filter(scored, lambda x: x.domain = domain AND x.label = 1)))
        / (1.0 + len(list_filter(scored, lambda x: x.domain = domain AND x.label = 0))) ELSE plain END AS total
    FROM (SELECT step, visited, front, best, best_score, label, dst_url, string_split(string_split(dst_url, '//')[2], '/')[1] AS domain, best_score * link_score AS plain,
        list_append(scored, {{'page_id': CAST(step AS BIGINT), 'url': best.url, 'parent_id': best.parent, 'score': best_score, 'label': label,
          'domain': string_split(string_split(best.url, '//')[2], '/')[1]}}) AS scored
      FROM (SELECT t.*, ids.score AS best_score, CAST(CASE WHEN ids.score >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS label
          FROM (SELECT *, list_sort(list_filter(front, lambda x: NOT list_contains(visited, x.url)))[1] AS best FROM crawl WHERE step < {EXACT_PAGES}) t
          JOIN ids ON ids.url = t.best.url)
      LEFT JOIN graph ON graph.src_url = best.url AND NOT list_contains(list_append(visited, best.url), graph.dst_url)))
  HAVING count(*) > 0),
ended AS (SELECT unnest(scored) AS s FROM (SELECT scored FROM crawl ORDER BY step DESC LIMIT 1))
SELECT s.page_id AS page_id, s.url AS url, s.parent_id AS parent_id, round(s.score, 9) AS score, s.label AS label FROM ended"""


@query("job7_exact_batches", HEAP_SQL)
def job7_exact(spark, sf):
    """The first pages of the same expansion in heap order, popped in batches."""
    pages = graph_pages(spark, sf)
    seeds = pages.filter(F.col("url").startswith("https://src1.example.org/")).select("url")
    options = fr.CrawlOptions(batch=64, page_limit=EXACT_PAGES)
    scored = fr.focused_expand(seeds, pages, graph_links(spark, sf), options).scored
    return scored.select("page_id", "url", "parent_id", F.round("score", 9).alias("score"), F.col("label"))


PAGE_TERM_CTE = f"""seen AS (SELECT page_id, {sql_title('html')} AS title, {sql_visible('html')} AS visible FROM pages),
pw AS (SELECT page_id, {sql_model_words("title || ' ' || title || chr(10) || visible")} AS words FROM seen
  WHERE trim(title || visible, ' ' || chr(10)) <> ''),
pwords AS (SELECT page_id, unnest(words) AS token FROM pw),
{sql_stems('pwords', 'ps')},
ptf AS (SELECT page_id, stem AS term, count(*) AS tf FROM pwords JOIN ps_stems USING (token)
  WHERE NOT list_contains({sql_list(MODEL_STOP)}, stem) GROUP BY ALL),
size AS (SELECT sqrt(sum(weight * weight)) AS norm FROM model),
pscore AS (SELECT page_id, coalesce(sum(tf * weight), 0.0) / (any_value(n) * (SELECT norm FROM size)) AS score
  FROM ptf LEFT JOIN model USING (term) JOIN (SELECT page_id, sqrt(sum(tf * tf)) AS n FROM ptf GROUP BY page_id) USING (page_id) GROUP BY page_id),
ltf AS (SELECT page_id, pos, term, count(*) AS tf FROM ltok GROUP BY ALL),
lscore AS (SELECT page_id, pos, coalesce(sum(tf * weight), 0.0) / (any_value(n) * (SELECT norm FROM size)) AS score
  FROM ltf LEFT JOIN model USING (term) JOIN (SELECT page_id, pos, sqrt(sum(tf * tf)) AS n FROM ltf GROUP BY page_id, pos) USING (page_id, pos)
  GROUP BY page_id, pos)"""


@query(
    "job7_pages_round",
    f"""WITH {TOPIC_CTE}, {LINK_TERM_CTE}, {PAGE_TERM_CTE}, rated AS (SELECT page_id, pos, coalesce(p.score, 0.0) AS page_score,
      coalesce(l.score, 0.0) AS link_score FROM ltext LEFT JOIN pscore p USING (page_id) LEFT JOIN lscore l USING (page_id, pos))
    SELECT page_id, pos, round(page_score, 9) AS page_score, round(link_score, 9) AS link_score,
      round(page_score * link_score, 9) AS total FROM rated""",
)
def job7_pages(spark, sf):
    """From stored pages to the priorities of their links: text, terms, page score,
    links, link score, total."""
    scorer = rv.TopicScorer(rv.build_topic_model(model_docs(spark, sf)))
    stored = table(spark, sf, "pages").select(
        "page_id", hx.clean_text(hx.title(F.col("html")), hx.visible_text(F.col("html"))).alias("clean_text")
    )
    scores = scorer.page_scores(rv.page_terms(stored)).select("page_id", F.col("score").alias("page_score"))
    rated = scorer.link_scores(rv.link_terms(page_link_rows(spark, sf))).join(scores, "page_id")
    total = fr.link_total(F.col("page_score"), F.col("link_score"), F.lit(1.0), F.lit(0))
    return rated.select(
        "page_id", "pos", F.round("page_score", 9).alias("page_score"), F.round("link_score", 9).alias("link_score"),
        F.round(total, 9).alias("total"),
    )


@query(
    "job8_evaluate",
    f"""WITH {SCORED_CTE}, l AS (SELECT page_id, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS label FROM scored)
    SELECT page_id, CAST(sum(label) OVER (ORDER BY page_id) AS BIGINT) AS rel, row_number() OVER (ORDER BY page_id) AS tot FROM l""",
)
def job8(spark, sf):
    return ev.harvest_curve(ev.label_pages(scored(spark, sf)))


CONSOLIDATED_SQL = f"""WITH {TWEET_CTE}, merged AS (
      SELECT url AS row_key, page_id AS fetch_time, 0 AS o, CAST(NULL AS STRING) AS tweet_id, length(html) AS n FROM pages
      UNION ALL SELECT url, seq, 1, tweet_id, NULL FROM tweets)
    SELECT row_key, arg_max(fetch_time, (fetch_time, o)) AS fetch_time, max_by(struct_pack(t := tweet_id), (fetch_time, o)).t AS tweet_id,
    max_by(struct_pack(n := n), (fetch_time, o)).n AS n FROM merged GROUP BY row_key"""


def _old_and_new(spark, sf):
    old = table(spark, sf, "pages").select(
        F.col("url").alias("row_key"), F.col("page_id").alias("fetch_time"), F.length("html").cast("bigint").alias("n")
    )
    return old, tweets(spark, sf).select(F.col("url").alias("row_key"), F.col("seq").alias("fetch_time"), "tweet_id")


@query("job9_consolidate", CONSOLIDATED_SQL)
def job9(spark, sf):
    return tb.consolidate(*_old_and_new(spark, sf)).select("row_key", "fetch_time", "tweet_id", "n")


@query("job9_incremental", CONSOLIDATED_SQL)
def job9_incremental(spark, sf):
    """The same rows by three upserts and two merges."""
    old, new = _old_and_new(spark, sf)
    stored = VersionedTable(spark, scratch_path(spark, "versions"), buckets=16)
    for rows in (old, new.where("tweet_id < '5'"), new.where("tweet_id >= '5'")):
        stored.upsert(rows)
        stored.compact(most=1)
    return stored.read().select("row_key", "fetch_time", "tweet_id", "n")

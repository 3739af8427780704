"""HTML, meta and URL queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.catalog.base import (
    FETCH_CTE, SQL_HIDDEN, SQL_TAG, TEXT_CTE, fetches, query, sql_decode, sql_list, sql_title, sql_visible, table,
)
from pagemill.functions import dates as dx
from pagemill.functions import html as hx
from pagemill.functions import meta as mx
from pagemill.functions import urls as ux
from pagemill.plans.frontier import page_links
from pagemill.session import spread



def pages(spark, sf):
    return spread(table(spark, sf, "pages"))


@query("htm1_visible_text", f"SELECT page_id, {sql_visible('html')} AS visible FROM pages")
def htm1(spark, sf):
    return pages(spark, sf).select("page_id", hx.visible_text(F.col("html")).alias("visible"))


@query("htm1_visible_text_parser", f"SELECT page_id, {sql_visible('html')} AS visible FROM pages")
def htm1_parser(spark, sf):
    return pages(spark, sf).select("page_id", hx.parsed_visible_text(F.col("html")).alias("visible"))


@query("htm2_title", f"SELECT page_id, {sql_title('html')} AS title FROM pages")
def htm2(spark, sf):
    return table(spark, sf, "pages").select("page_id", hx.title(F.col("html")).alias("title"))


@query("htm3_clean_text", f"WITH {TEXT_CTE} SELECT page_id, clean_text FROM texts")
def htm3(spark, sf):
    df = spread(fetches(spark, sf)).select("page_id", hx.title(F.col("html")).alias("t"), hx.visible_text(F.col("html")).alias("v"))
    return df.select("page_id", hx.clean_text(F.col("t"), F.col("v")).alias("clean_text"))


@query("htm4_decode_utf8", "SELECT page_id, html, CASE WHEN page_id % 3 <> 0 THEN html END AS strict FROM pages")
def htm4(spark, sf):
    bad = F.when(F.col("page_id") % 3 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    body = pages(spark, sf).select("page_id", F.concat(F.col("html").cast("binary"), bad).alias("body"))
    return body.select(
        "page_id", hx.decode_utf8(F.col("body")).alias("html"), hx.decode_utf8(F.col("body"), strict=True).alias("strict")
    )


@query("htm5_entities", f"SELECT page_id, {sql_decode('html')} AS decoded FROM pages")
def htm5(spark, sf):
    return pages(spark, sf).select("page_id", hx.decode_entities(F.col("html")).alias("decoded"))


SQL_LINKS = rf"""bare AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(html, '{SQL_HIDDEN}', '<!>', 'g'),
    '(?i)<a([\s>/])', chr(1) || '\1', 'g'), chr(1))[2:] AS pieces FROM %s),
linked AS (SELECT page_id, url, generate_subscripts(pieces, 1) - 1 AS pos, unnest(pieces) AS p FROM bare),
links AS (SELECT page_id, url, pos,
  {sql_decode(rf"regexp_replace(regexp_split_to_array(regexp_replace(p, '^[^>]*>', ''), '(?i)</a\s*>')[1], '{SQL_TAG}', '', 'g')")} AS anchor,
  nullif({sql_decode(r'''regexp_extract(p, '(?i)^[^>]*\shref="([^"]*)"', 1)''')}, '') AS href FROM linked)"""


@query("htm6_links", f"WITH {SQL_LINKS % 'pages'} SELECT page_id, pos, anchor, href FROM links")
def htm6(spark, sf):
    return pages(spark, sf).select("page_id", F.explode(hx.links(F.col("html"))).alias("k")).select(
        "page_id", "k.pos", "k.anchor", "k.href"
    )


# Absolute addresses: links rewritten from relative ones, some with a query.
ABSOLUTE = """replace(html, '<a href="/', '<a href="https://site' || CAST(page_id % 5 AS STRING)
  || '.example.org/a-b?go=http://next.example.com/x_y/')"""


@query(
    "htm7_sub_urls",
    rf"""WITH abs AS (SELECT page_id, url, {ABSOLUTE} AS html FROM pages), {SQL_LINKS % 'abs'}
    SELECT page_id, coalesce(array_to_string(flatten(list(u ORDER BY pos)), ';'), '') AS sub_urls
    FROM (SELECT page_id, pos, regexp_extract_all(href, 'https?://[a-zA-Z0-9./-]+') AS u FROM links) GROUP BY page_id""",
)
def htm7(spark, sf):
    df = pages(spark, sf).select("page_id", F.expr(ABSOLUTE).alias("html"))
    return df.select("page_id", F.array_join(hx.sub_urls(hx.links(F.col("html")), fixed.SUB_URL_PATTERN), ";").alias("sub_urls"))


# ---- meta tags: pages with tags written into their head -----------------------------
_DAY = "'2015-11-' || lpad(CAST(1 + page_id % 28 AS STRING), 2, '0')"
_DATE_TEXT = f"""CASE page_id % 7 WHEN 0 THEN {_DAY} || 'T07:11:02Z' WHEN 1 THEN replace({_DAY}, '-', '') || '1006'
  WHEN 2 THEN {_DAY} || ' 22:40:25' WHEN 3 THEN {_DAY} WHEN 4 THEN {_DAY} || 'T00:10:33+02:00'
  WHEN 5 THEN '11/' || CAST(1 + page_id % 28 AS STRING) || '/2015 01:05AM' ELSE 'soon' END"""
_DATE_TAG = "CASE page_id % 18 " + " ".join(
    f"WHEN {i} THEN '{a}'"
    for i, a in enumerate(
        [f'name="{n}"' for n in fixed.DATE_META_NAMES]
        + [f'property="{n}"' for n in fixed.DATE_META_PROPERTIES]
        + [f'itemprop="{n}"' for n in fixed.DATE_META_ITEMPROPS]
        + [f'http-equiv="{n}"' for n in fixed.DATE_META_HTTP_EQUIV]
    )
) + " END"
META_HTML = f"""replace(html, '<meta charset="utf-8">', '<meta charset="utf-8">'
  || '<META name="Author" content=" Writer ' || CAST(page_id % 7 AS STRING) || ' "><meta name="author">'
  || '<meta name="keywords" content="k' || CAST(page_id % 5 AS STRING) || ', news &amp; more">'
  || '<meta name="copyright" content="Org ' || CAST(page_id % 3 AS STRING) || '">'
  || CASE WHEN page_id % 2 = 0 THEN '<meta name="copyright" content="Org last">' ELSE '' END
  || CASE page_id % 3 WHEN 0 THEN '<meta name="og:url" content="' || url || '/og">'
       WHEN 1 THEN '<meta property="og:url" content="' || url || '/prop">' ELSE '' END
  || '<meta ' || {_DATE_TAG} || ' content="' || {_DATE_TEXT} || '">'
  || CASE WHEN page_id % 4 = 1 THEN '<meta name="date" content="2016-01-01">' ELSE '' END)"""


def meta_pages(spark, sf):
    df = pages(spark, sf).select("page_id", "url", F.expr(META_HTML).alias("html"))
    return df.select("page_id", "url", "html", mx.meta_tags(F.col("html")).alias("tags"))


def _attr(name: str) -> str:
    return rf"""regexp_extract(m, '(?i)(?:^|\s){name}="([^"]*)"', 1)"""


SQL_DATE_NAMES = f"""(name IN {tuple(fixed.DATE_META_NAMES)} OR property IN {tuple(fixed.DATE_META_PROPERTIES)}
  OR itemprop IN {tuple(fixed.DATE_META_ITEMPROPS)} OR http_equiv = 'date')"""
META_CTE = rf"""mp AS (SELECT page_id, url, {META_HTML} AS html FROM pages),
found AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<meta\b([^>]*)>', 1) AS ms FROM mp),
rows AS (SELECT page_id, generate_subscripts(ms, 1) - 1 AS pos, unnest(ms) AS m FROM found),
tags AS (SELECT page_id, pos, lower({_attr('name')}) AS name, lower({_attr('property')}) AS property,
  lower({_attr('itemprop')}) AS itemprop, lower({_attr('http-equiv')}) AS http_equiv,
  trim(replace(nullif({_attr('content')}, ''), '&amp;', '&')) AS content FROM rows)"""


@query("htm8_meta_tags", f"WITH {META_CTE} SELECT * FROM tags")
def htm8(spark, sf):
    return meta_pages(spark, sf).select("page_id", F.explode("tags").alias("m")).select("page_id", "m.*")


def _last(condition: str) -> str:
    return f"coalesce(max_by(content, pos) FILTER (WHERE content IS NOT NULL AND {condition}), '')"


for _name, _fn, _condition in (
    ("htm9_meta_author", mx.meta_author, "name = 'author'"),
    ("htm10_meta_copyright", mx.meta_copyright, "name = 'copyright'"),
    ("htm11_meta_keywords", mx.meta_keywords, "name = 'keywords'"),
    ("htm13_publish_date_text", mx.meta_publish_date, SQL_DATE_NAMES),
):

    def _run(spark, sf, fn=_fn):
        return meta_pages(spark, sf).select("page_id", fn(F.col("tags")).alias("value"))

    query(_name, f"WITH {META_CTE} SELECT page_id, {_last(_condition)} AS value FROM tags GROUP BY page_id")(_run)


@query(
    "win3_last_meta_wins",
    f"""WITH {META_CTE} SELECT page_id, {_last("name = 'author'")} AS author, {_last("name = 'copyright'")} AS copyright,
    {_last(SQL_DATE_NAMES)} AS publish_date, {_last("name = 'keywords'")} AS keywords,
    {_last("name = 'og:url' OR property = 'og:url'")} AS url FROM tags GROUP BY page_id""",
)
def win3(spark, sf):
    return meta_pages(spark, sf).select("page_id", mx.meta_record(F.col("tags")).alias("m")).select("page_id", "m.*")


@query(
    "htm12_canonical_url",
    f"""WITH {META_CTE}, og AS (SELECT page_id, {_last("name = 'og:url' OR property = 'og:url'")} AS og,
    {_last("name = 'og:url'")} AS named FROM tags GROUP BY page_id)
    SELECT page_id, coalesce(nullif(og, ''), url) AS url, coalesce(nullif(named, ''), url) AS url_by_name
    FROM pages JOIN og USING (page_id)""",
)
def htm12(spark, sf):
    over = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.col("url"))
    return meta_pages(spark, sf).select(
        "page_id", over(mx.meta_url(F.col("tags"))).alias("url"),
        over(mx.meta_url(F.col("tags"), by_property=False)).alias("url_by_name"),
    )


_PARSED = """strftime(CASE WHEN v LIKE '____-__-__T__:__:__%' THEN try_strptime(left(v, 19), '%Y-%m-%dT%H:%M:%S')
  WHEN v LIKE '____-__-__ %' THEN try_strptime(v, '%Y-%m-%d %H:%M:%S') WHEN v LIKE '____-__-__' THEN try_strptime(v, '%Y-%m-%d')
  WHEN v LIKE '%M' THEN try_strptime(v, '%m/%d/%Y %I:%M%p') ELSE try_strptime(v, '%Y%m%d%H%M') END, '%Y-%m-%d %H:%M:%S')"""
_STAMP = "yyyy-MM-dd HH:mm:ss"


@query(
    "htm14_publish_date",
    f"""WITH {META_CTE} SELECT page_id, {_PARSED} AS published FROM
    (SELECT page_id, min_by(content, pos) FILTER (WHERE {SQL_DATE_NAMES}) AS v FROM tags GROUP BY page_id)""",
)
def htm14(spark, sf):
    return meta_pages(spark, sf).select("page_id", F.date_format(mx.meta_date(F.col("tags")), _STAMP).alias("published"))


# A third of the addresses has a day of its own; it comes before the meta tags.
DAY_ADDRESS = "CASE WHEN page_id % 3 = 0 THEN regexp_replace(url, '^(https?://[^/]*)/.*$', 'M1') || '/2019/0' || (1 + page_id % 9) || '/1' || (page_id % 10) || '/news' ELSE 'http://news.example.org/story' END"


@query(
    "dt3_article_date",
    f"""WITH {META_CTE}, v AS (SELECT page_id, {_PARSED} AS published FROM
    (SELECT page_id, min_by(content, pos) FILTER (WHERE {SQL_DATE_NAMES}) AS v FROM tags GROUP BY page_id))
    SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '2019-0' || (1 + page_id % 9) || '-1' || (page_id % 10) || ' 00:00:00' ELSE published END AS published
    FROM v""",
)
def dt3(spark, sf):
    """Publication date of a page from its address or its meta tags."""
    urls = table(spark, sf, "pages").select("page_id", F.expr(DAY_ADDRESS.replace("M1", "$1")).alias("address"))
    dated = meta_pages(spark, sf).select("page_id", "tags").join(urls, "page_id")
    return dated.select("page_id", F.date_format(mx.article_date(F.col("address"), F.col("tags")), _STAMP).alias("published"))


@query(
    "win4_first_date_meta_wins",
    f"""WITH {META_CTE} SELECT page_id, min_by(content, pos) FILTER (WHERE {SQL_DATE_NAMES}) AS value
    FROM tags GROUP BY page_id""",
)
def win4(spark, sf):
    return meta_pages(spark, sf).select("page_id", mx.first_content(F.col("tags"), mx.is_date_tag).alias("value"))


LD_HTML = f"""replace(html, '</head>', '<script type="application/ld+json">{{"datePublished": "' || {_DAY} || '"'
  || CASE WHEN page_id % 2 = 0 THEN ', "dateCreated": "' || {_DAY} || 'T10:00:00Z"' ELSE '' END || '}}</script></head>')"""


@query(
    "htm15_json_ld_date",
    f"SELECT page_id, {_DAY} || CASE WHEN page_id % 2 = 0 THEN ' 10:00:00' ELSE ' 00:00:00' END AS published FROM pages",
)
def htm15(spark, sf):
    df = pages(spark, sf).select("page_id", F.expr(LD_HTML).alias("html"))
    return df.select("page_id", F.date_format(mx.json_ld_date(F.col("html")), _STAMP).alias("published"))


TIME_HTML = f"""replace(html, '<h1>', CASE page_id % 4
  WHEN 0 THEN '<time class="x" datetime="' || {_DAY} || '">today</time>'
  WHEN 1 THEN '<span itemprop="datePublished" content="' || {_DAY} || '">x</span>'
  WHEN 2 THEN '<div class="post-date">soon</div><p class="PubDate">' || {_DAY} || '</p>'
  ELSE '' END || '<h1>')"""


@query(
    "htm16_tag_date",
    f"SELECT page_id, CASE WHEN page_id % 4 < 3 AND html LIKE '%<h1>%' THEN {_DAY} || ' 00:00:00' END AS published FROM pages",
)
def htm16(spark, sf):
    df = pages(spark, sf).select("page_id", F.expr(TIME_HTML).alias("html"))
    return df.select("page_id", F.date_format(mx.tag_date(F.col("html")), _STAMP).alias("published"))


# ---- URLs -----------------------------------------------------------------------------
# Addresses of many shapes, derived from the page URLs.
URL_SHAPE = """CASE page_id % 9 WHEN 0 THEN url WHEN 1 THEN replace(url, '.example', '.example.co.uk:8080/x')
  WHEN 2 THEN regexp_replace(url, '^(https?://[^/]*)/.*$', 'M1') WHEN 3 THEN url || '#frag?x=1'
  WHEN 4 THEN '  ' || url || '/?id=7  ' WHEN 5 THEN replace(url, 'http', 'HTTP') WHEN 6 THEN 'mailto:someone'
  WHEN 7 THEN url || '/2017_a b,c<d>' ELSE replace(url, '.com', '.fr') END"""
SQL_SHAPES = f"shaped AS (SELECT page_id, {URL_SHAPE.replace('M1', chr(92) + '1')} AS url FROM pages)"


def shaped(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.expr(URL_SHAPE.replace("M1", "$1")).alias("url"))


SQL_DOMAIN = r"""lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1)) || '://'
  || regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1) || '/'"""
SQL_LOCATION = f"""CASE WHEN list_contains({sql_list(fixed.GENERIC_DOMAINS)}, regexp_replace(string_split({{0}}, '.')[-1], '/$', ''))
  THEN '' ELSE regexp_replace(string_split({{0}}, '.')[-1], '/$', '') END"""


@query("url1_domain_name", f"WITH {SQL_SHAPES} SELECT page_id, {SQL_DOMAIN} AS domain FROM shaped")
def url1(spark, sf):
    return shaped(spark, sf).select("page_id", ux.domain_name(F.col("url")).alias("domain"))


@query(
    "url2_domain_location",
    f"WITH {SQL_SHAPES}, d AS (SELECT page_id, {SQL_DOMAIN} AS domain FROM shaped) "
    f"SELECT page_id, {SQL_LOCATION.format('domain')} AS location FROM d",
)
def url2(spark, sf):
    return shaped(spark, sf).select("page_id", ux.domain_location(ux.domain_name(F.col("url"))).alias("location"))


@query(
    "url3_host",
    rf"""WITH {SQL_SHAPES}, r AS (SELECT page_id, regexp_extract(url, '//(.*)$', 1) AS r FROM shaped)
    SELECT page_id, string_split(r, '/')[1] AS host,
    CASE WHEN contains(r, '/') THEN string_split(r, '/')[1] ELSE left(r, greatest(length(r) - 1, 0)) END AS strict_host FROM r""",
)
def url3(spark, sf):
    return shaped(spark, sf).select("page_id", ux.host(F.col("url")).alias("host"), ux.host(F.col("url"), strict=True).alias("strict_host"))


# Addresses that carry a date.
DATED_URL = """url || CASE page_id % 6 WHEN 0 THEN '/2017/08/' || CAST(1 + page_id % 28 AS STRING) || '/x.html'
  WHEN 1 THEN '/2018-5-14-report' WHEN 2 THEN '/2016/nov/09/vote' WHEN 3 THEN '/2018-river-bridge'
  WHEN 4 THEN '/news/20170821/' ELSE '' END"""


@query(
    "url4_url_date",
    """SELECT page_id, CASE page_id % 6 WHEN 0 THEN '2017-08-' || lpad(CAST(1 + page_id % 28 AS STRING), 2, '0')
    WHEN 1 THEN '2018-05-14' WHEN 2 THEN '2016-11-09' WHEN 4 THEN '2017-08-21' END AS url_date FROM pages""",
)
def url4(spark, sf):
    df = table(spark, sf, "pages").select("page_id", F.expr(DATED_URL).alias("url"))
    # Addresses of the given table hold no dates of their own.
    return df.select("page_id", F.date_format(dx.url_date(F.col("url")), "yyyy-MM-dd").alias("url_date"))


SQL_CANONICAL = r"regexp_replace(string_split(string_split(trim({0}), '?')[1], '#')[1], '/$', '')"


@query(
    "url5_canonical_link",
    f"""WITH {SQL_SHAPES} SELECT page_id, {SQL_CANONICAL.format('url')} AS canonical,
    regexp_replace(string_split(CASE WHEN regexp_matches(trim(url), '^[^?]*\\?(?:id=|v=|tid=)') THEN trim(url)
      ELSE string_split(trim(url), '?')[1] END, '#')[1], '/$', '') AS with_ids FROM shaped""",
)
def url5(spark, sf):
    return shaped(spark, sf).select(
        "page_id", ux.canonical_link(F.col("url")).alias("canonical"), ux.canonical_link(F.col("url"), keep_id_params=True).alias("with_ids")
    )


_SUFFIX = "|".join(s.replace(".", r"\.") for s in fixed.BLOCKED_SUFFIXES)
TAILED_URL = """url || CASE page_id % 8 WHEN 0 THEN '/feed/' WHEN 1 THEN '.pdf' WHEN 2 THEN '/report-a-typo/x'
  WHEN 3 THEN '/share?x=1' WHEN 4 THEN '/comments' WHEN 5 THEN '.rss' ELSE '' END"""


@query(
    "url6_blocked_links",
    f"""WITH t AS (SELECT page_id, {TAILED_URL} AS url FROM pages)
    SELECT page_id, regexp_matches({SQL_CANONICAL.format('url')}, '(?:{_SUFFIX})$') OR contains(url, 'report-a-typo')
      OR contains(url, 'm.tempo.co/') AS blocked FROM t""",
)
def url6(spark, sf):
    df = table(spark, sf, "pages").select("page_id", F.expr(TAILED_URL).alias("url"))
    return df.select("page_id", ux.is_blocked_link(F.col("url"), ux.canonical_link(F.col("url"))).alias("blocked"))


SQL_URL_TEXT = rf"""trim({{anchor}}) || ' ' || array_to_string(list_filter(regexp_extract_all(replace({{href}}, '_', ' '),
  '[\p{{{{L}}}}\p{{{{N}}}}_]+'), lambda w: NOT list_contains({sql_list(fixed.URL_STOP_WORDS)}, w)), ' ') || ' '"""


@query(
    "url7_url_text",
    f"""WITH {SQL_LINKS % 'pages'} SELECT page_id, pos, {SQL_URL_TEXT.format(anchor='anchor', href="(url || href)")} AS txt
    FROM links WHERE href IS NOT NULL""",
)
def url7(spark, sf):
    df = pages(spark, sf).select("page_id", "url", F.explode(hx.links(F.col("html"))).alias("k")).filter("k.href IS NOT NULL")
    return df.select("page_id", "k.pos", ux.url_text(F.col("k.anchor"), F.concat("url", "k.href")).alias("txt"))


@query(
    "url9_file_name",
    f"""WITH {SQL_SHAPES} SELECT page_id, translate(translate(string_split(url, '://')[2], '/ ?,<>', '______'),
    ':' || chr(13) || chr(10), '') AS file_name FROM shaped""",
)
def url9(spark, sf):
    return shaped(spark, sf).select("page_id", ux.file_name(F.col("url")).alias("file_name"))


@query(
    "flt13_link_candidates",
    rf"""WITH abs AS (SELECT page_id, url, {ABSOLUTE} AS html FROM pages), {SQL_LINKS % 'abs'},
    c AS (SELECT url AS src_url, pos, href, {SQL_CANONICAL.format('href')} AS dst_url FROM links WHERE href IS NOT NULL)
    SELECT src_url, pos, href, dst_url FROM c WHERE dst_url LIKE 'http%' AND NOT regexp_matches(dst_url, '(?:{_SUFFIX})$')
    AND NOT contains(href, 'report-a-typo') AND NOT contains(href, 'm.tempo.co/')""",
)
def flt13(spark, sf):
    from pagemill.plans.frontier import link_candidates

    df = pages(spark, sf).select("url", F.expr(ABSOLUTE).alias("html"))
    return link_candidates(page_links(df)).select("src_url", "pos", "href", "dst_url")


@query(
    "flt8_visible_nodes",
    f"""WITH {FETCH_CTE}, v AS (SELECT page_id, {sql_visible('html')} AS v FROM fetches)
    SELECT page_id, CAST(len(string_split(v, chr(10))) AS BIGINT) AS n_lines, CAST(length(v) AS BIGINT) AS n_chars
    FROM v WHERE v <> ''""",
)
def flt8(spark, sf):
    df = spread(fetches(spark, sf)).select("page_id", hx.visible_text(F.col("html")).alias("v"))
    return df.filter(F.col("v") != "").select(
        "page_id", F.size(F.split("v", "\n")).cast("bigint").alias("n_lines"), F.length("v").cast("bigint").alias("n_chars")
    )

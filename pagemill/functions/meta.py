"""Meta tags and publication dates of a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions.arrays import let, let_sql
from pagemill.functions.dates import parse_date, url_date
from pagemill.functions.html import ATTRS, COMMENT, DECODE_SQL, attribute, attribute_sql

META_FIELDS = ["author", "copyright", "keywords"]


_TAGS = "v -> transform(v, (m, n) -> named_struct('pos', n, {fields}, 'content', get(transform(array({content}), s -> trim({decode})), 0)))"


def meta_tags(html: Column) -> Column:
    """Meta tags in document order as array<struct<pos, name, property, itemprop,
    http_equiv, content>>; the key fields in lower case."""
    keys = {"name": "name", "property": "property", "itemprop": "itemprop", "http_equiv": "http-equiv"}
    fields = ", ".join(f"'{k}', coalesce(lower({attribute_sql('m', a)}), '')" for k, a in keys.items())
    found = F.regexp_extract_all(
        F.regexp_replace(html, f"(?s){COMMENT}", ""), F.lit(rf"(?is)<meta\b({ATTRS})(?:>|\z)"), F.lit(1)
    )
    return let_sql(found, _TAGS.format(fields=fields, content=attribute_sql("m", "content"), decode=DECODE_SQL))


def last_content(tags: Column, match) -> Column:
    """Content of the last matching tag that has content; empty when none."""
    hits = F.filter(tags, lambda m: match(m) & m["content"].isNotNull())
    return F.coalesce(F.try_element_at(hits, F.lit(-1))["content"], F.lit(""))


def first_content(tags: Column, match) -> Column:
    """Content of the first matching tag, null when none."""
    return F.get(F.filter(tags, match), F.lit(0))["content"]


def is_date_tag(m: Column) -> Column:
    return (
        m["name"].isin(fixed.DATE_META_NAMES)
        | m["property"].isin(fixed.DATE_META_PROPERTIES)
        | m["itemprop"].isin(fixed.DATE_META_ITEMPROPS)
        | m["http_equiv"].isin(fixed.DATE_META_HTTP_EQUIV)
    )


def meta_author(tags: Column) -> Column:
    return last_content(tags, lambda m: m["name"] == "author")


def meta_copyright(tags: Column) -> Column:
    return last_content(tags, lambda m: m["name"] == "copyright")


def meta_keywords(tags: Column) -> Column:
    return last_content(tags, lambda m: m["name"] == "keywords")


def meta_url(tags: Column, by_property: bool = True) -> Column:
    """og:url of the page, empty when none; read from `name`, and from
    `property` as well unless switched off."""

    def match(m: Column) -> Column:
        hit = m["name"] == "og:url"
        return hit | (m["property"] == "og:url") if by_property else hit

    return last_content(tags, match)


def meta_publish_date(tags: Column) -> Column:
    """Raw text of the last date tag."""
    return last_content(tags, is_date_tag)


def meta_record(tags: Column, meta_guard: str = "attributes", by_property: bool = True) -> Column:
    """All meta fields as a struct. With meta_guard="children" they stay empty,
    the form in which the content attribute is never seen."""
    if meta_guard == "children":
        blank = F.lit("")
        return F.struct(*[blank.alias(n) for n in ("author", "copyright", "publish_date", "keywords", "url")])
    return F.struct(
        meta_author(tags).alias("author"),
        meta_copyright(tags).alias("copyright"),
        meta_publish_date(tags).alias("publish_date"),
        meta_keywords(tags).alias("keywords"),
        meta_url(tags, by_property).alias("url"),
    )


def meta_date(tags: Column) -> Column:
    """Timestamp of the first date tag; null when it cannot be read."""
    return parse_date(first_content(tags, is_date_tag))


def json_ld_date(html: Column) -> Column:
    """dateCreated, else datePublished, of the first JSON-LD block."""
    block = F.regexp_extract(html, r"(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script", 1)
    return let(
        block,
        lambda b: F.coalesce(
            parse_date(F.get_json_object(b, "$.dateCreated")), parse_date(F.get_json_object(b, "$.datePublished"))
        ),
    )


def tag_date(html: Column) -> Column:
    """Date from <time datetime>, then span itemprop, then date-like classes. A
    <time> with a datetime decides even when it cannot be read."""

    def body(h: Column) -> Column:
        time_text = F.regexp_extract(h, r"(?is)<time\b[^>]*\sdatetime\s*=\s*[\"']?([^\"'>]+)", 1)
        stamp = F.regexp_extract(h, r"(?is)<time\b[^>]*\sclass\s*=\s*[\"']?timestamp\b[^>]*>([^<]*)<", 1)
        span = F.regexp_extract(h, r"(?is)<span\b[^>]*\sitemprop\s*=\s*[\"']?datePublished[\"']?[^>]*>([^<]*)<", 1)
        span_tag = F.regexp_extract(h, r"(?is)<span\b([^>]*\sitemprop\s*=\s*[\"']?datePublished[\"']?[^>]*)>", 1)
        span_text = F.coalesce(attribute(span_tag, "content"), span)
        classed = F.regexp_extract_all(
            h,
            F.lit(r"(?is)<(?:span|p|div)\b[^>]*\sclass\s*=\s*[\"'][^\"']*(?:pubdate|timestamp|date)[^\"']*[\"'][^>]*>([^<]*)<"),
            F.lit(1),
        )
        parsed = F.filter(F.transform(classed, parse_date), lambda d: d.isNotNull())
        return (
            F.when(time_text != "", parse_date(time_text))
            .when(stamp != "", parse_date(stamp))
            .when(span_tag != "", parse_date(span_text))
            .otherwise(F.get(parsed, F.lit(0)))
        )

    return let(html, body)


def article_date(url: Column, tags: Column) -> Column:
    """Publication date: the address first, then the meta tags."""
    return F.coalesce(url_date(url), meta_date(tags))

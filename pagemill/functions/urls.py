"""URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill import fixed

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def domain_name(url: Column) -> Column:
    """`scheme://authority/`, port kept."""
    return F.concat(
        F.lower(F.regexp_extract(url, _SCHEME, 1)), F.lit("://"), F.regexp_extract(url, _AUTHORITY, 1), F.lit("/")
    )


def domain_location(name: Column) -> Column:
    """Last dot-separated piece of a `domain_name`, empty for generic labels."""
    last = F.regexp_replace(F.substring_index(name, ".", -1), r"/$", "")
    return F.when(last.isin(fixed.GENERIC_DOMAINS), F.lit("")).otherwise(last)


def host(url: Column, strict: bool = False) -> Column:
    """Text after `//` up to the next slash. With `strict` a URL without a slash
    after the host loses its last letter, as the crawler's own form does."""
    rest = F.regexp_extract(url, r"//(.*)$", 1)
    if not strict:
        return F.substring_index(rest, "/", 1)
    return F.when(rest.contains("/"), F.substring_index(rest, "/", 1)).otherwise(
        F.regexp_replace(rest, r"(?s).$", "")
    )


def url_date_text(url: Column) -> Column:
    """First date-like stretch of an address, empty when there is none."""
    return F.regexp_extract(url, fixed.URL_DATE_PATTERN, 0)


def canonical_link(href: Column, keep_id_params: bool = False) -> Column:
    """Trim, cut the query and the fragment, drop one trailing slash. The id
    parameters survive only with `keep_id_params`."""
    trimmed = F.regexp_replace(href, r"^\s+|\s+$", "")
    cut = F.substring_index(trimmed, "?", 1)
    if keep_id_params:
        cut = F.when(trimmed.rlike(r"^[^?]*\?(?:id=|v=|tid=)"), trimmed).otherwise(cut)
    return F.regexp_replace(F.substring_index(cut, "#", 1), r"/$", "")


def is_blocked_link(raw: Column, canonical: Column) -> Column:
    """True for addresses that are never followed."""
    suffixes = "|".join(s.replace(".", r"\.") for s in fixed.BLOCKED_SUFFIXES)
    blocked = canonical.rlike(f"(?:{suffixes})$")
    for part in fixed.BLOCKED_PARTS:
        blocked = blocked | raw.contains(part)
    return blocked


def url_text(anchor: Column, href: Column, context: Column | None = None) -> Column:
    """Anchor plus the address words that are not generic, plus the context."""
    words = F.filter(
        F.regexp_extract_all(F.translate(href, "_", " "), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)),
        lambda w: ~w.isin(fixed.URL_STOP_WORDS),
    )
    return F.concat(
        F.regexp_replace(anchor, r"^\s+|\s+$", ""), F.lit(" "), F.array_join(words, " "), F.lit(" "),
        context if context is not None else F.lit(""),
    )


def file_name(url: Column) -> Column:
    """File name of a page; null when the URL has no `://`."""
    rest = F.get(F.split(url, "://"), F.lit(1))
    return F.translate(F.translate(rest, "/ ?,<>", "______"), ":\r\n", "")


def clean_url(url: Column) -> Column:
    """URL without newline, carriage return and tab."""
    return F.translate(url, "\n\r\t", "")


def is_image_url(url: Column) -> Column:
    return url.endswith(".jpg")



"""HTML extraction with native expressions."""

from __future__ import annotations

import html.entities as _entities

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pagemill.functions.arrays import let_sql, quoted

# Attribute area of a tag; quoted values may hold '>'. Possessive, so linear. What
# is never closed (tag, comment, block) runs to the end of the page and is taken
# with it: it must not be looked at again from every later start.
ATTRS = r"(?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+"
TAG = rf"<[/!?a-zA-Z]{ATTRS}(?:>|\z)"
COMMENT = r"<!--.*?(?:-->|\z)"
CUT = "<!>"


def _block(name: str) -> str:
    return rf"<{name}\b[^>]*+(?:>.*?(?:</{name}\s*>|\z)|\z)"


def strip_hidden(html: Column, hide_iframe: bool = True, drop_comments: bool = True) -> Column:
    """Replace script, style, iframe and comment blocks by a cut mark, leftmost
    block first, so a comment inside a script is not a comment."""
    names = ["script", "style"] + (["iframe"] if hide_iframe else [])
    parts = [COMMENT] if drop_comments else []
    parts += [_block(n) for n in names]
    hidden = F.regexp_replace(html, "(?is)" + "|".join(parts), CUT)
    if not drop_comments:
        hidden = F.regexp_replace(hidden, r"(?s)<!--(.*?)(?:-->|\z)", f"{CUT}$1{CUT}")
    return hidden


def _entity_table() -> str:
    """Named and remapped numeric references, from the standard library, as a
    map expression that folds to a constant."""
    table = {k: v for k, v in _entities.html5.items() if "\x01" not in v and "\x02" not in v}
    for code in range(128, 160):
        try:
            table[f"#{code}"] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            continue
    text = "\x01".join(f"{k}\x02{v}" for k, v in table.items())
    return f"str_to_map({quoted(text)}, '\x01', '\x02')"


_LEGACY = "|".join(sorted((n for n in _entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))

# `p` is the text after an ampersand, `m` the reference at its start.
_NUMERIC = """get(transform(array(coalesce(try_cast(
      CASE WHEN substr(m, 2, 1) IN ('x', 'X') THEN conv(regexp_replace(m, '[#xX;]', ''), 16, 10)
      ELSE regexp_replace(m, '[#;]', '') END AS bigint), 65533)),
    c -> concat(coalesce(try_element_at(e, concat('#', cast(c AS string))),
      decode(unhex(lpad(hex(CASE WHEN c BETWEEN 1 AND 1114111 AND NOT c BETWEEN 55296 AND 57343 THEN c ELSE 65533 END),
        8, '0')), 'UTF-32')), substr(p, length(m) + 1))), 0)"""
_NAMED = f"""get(transform(array(regexp_extract(p, '^(?:{_LEGACY})', 0)),
    k -> CASE WHEN try_element_at(e, m) IS NOT NULL THEN concat(try_element_at(e, m), substr(p, length(m) + 1))
      WHEN k <> '' THEN concat(try_element_at(e, k), substr(p, length(k) + 1)) ELSE concat('&', p) END), 0)"""
_REFERENCE = quoted(r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;)")
# The usual references are told apart before the whole table is searched.
_USUAL = (
    "lt; gt; quot; apos; nbsp; copy; reg; trade; middot; bull; ndash; mdash; lsquo; rsquo; ldquo; rdquo; laquo; raquo; hellip; "
    "times; euro; pound; deg; eacute; egrave; agrave; ccedil; auml; ouml; uuml; szlig; ntilde; #39; #34; #38; #160; #8217; #8211;"
).split()
_USUAL_SQL = "CASE m " + " ".join(
    f"WHEN {quoted(n)} THEN {quoted(_entities.html5[n] if n in _entities.html5 else chr(int(n[1:-1])))}" for n in _USUAL
) + " END"
_PIECE = f"""CASE WHEN startswith(p, 'amp;') THEN concat('&', substr(p, 5))
    ELSE get(transform(array(regexp_extract(p, {_REFERENCE}, 0)),
      m -> CASE WHEN m IN ({', '.join(quoted(n) for n in _USUAL)}) THEN concat({_USUAL_SQL}, substr(p, length(m) + 1))
        WHEN startswith(m, '#') THEN {_NUMERIC} ELSE {_NAMED} END), 0) END""".replace(
    "try_element_at(e, ", f"try_element_at({_entity_table()}, "
)
# `s` is a text; a text without an ampersand is returned as it is.
DECODE_SQL = f"""CASE WHEN contains(s, '&') THEN get(transform(array(split(s, '&')), q -> concat(get(q, 0),
    array_join(transform(slice(q, 2, size(q)), p -> {_PIECE}), ''))), 0) ELSE s END"""


def decode_entities(text: Column) -> Column:
    """Character references to characters (numeric, named, and the legacy names
    that need no semicolon)."""
    return let_sql(text, f"s -> {DECODE_SQL}")


_NODES = f"""h -> get(transform(array(split(h, {quoted(r"(?i)</head\s*>")}, 2)),
    d -> CASE WHEN size(d) > 1 THEN concat(
        filter(split(get(d, 0), {quoted(TAG)}), x -> trim(translate(x, {quoted(chr(10) + chr(13) + chr(9) + chr(12))}, '    ')) <> ''),
        filter(split(get(d, 1), {quoted(TAG)}), x -> x <> ''))
      ELSE filter(split(h, {quoted(TAG)}), x -> x <> '') END), 0)"""


def visible_of(stripped: Column) -> Column:
    """Visible text of a page that went through `strip_hidden`."""
    return decode_entities(F.array_join(let_sql(stripped, _NODES), "\n"))


def visible_text(html: Column, hide_iframe: bool = True, drop_comments: bool = True) -> Column:
    """Visible text nodes joined by newlines. Text directly under <head> is
    dropped; the <title> text stays."""
    return visible_of(strip_hidden(html, hide_iframe, drop_comments))


def title(html: Column) -> Column:
    """Text of the first <title>; empty when missing or nested."""
    return decode_entities(F.regexp_extract(html, r"(?is)<title\b[^<>]*+>([^<]*+)</title", 1))


def clean_text(title_text: Column, visible: Column) -> Column:
    """Page text: the title, a space, the title again, a newline, the nodes
    (which hold the title a third time). Empty when there is no text at all."""
    full = F.concat(title_text, F.lit(" "), title_text, F.lit("\n"), visible)
    return F.when(F.trim(F.translate(F.concat(title_text, visible), "\n\r\t", "   ")) != "", full).otherwise("")


def decode_utf8(body: Column, strict: bool = False) -> Column:
    """Bytes to text. Strict: null on bad bytes. Otherwise bad bytes vanish."""
    if strict:
        return F.try_validate_utf8(body.cast("string"))
    return F.replace(F.make_valid_utf8(body.cast("string")), F.lit("�"), F.lit(""))


def attribute_sql(attrs: str, name: str) -> str:
    """SQL for the value of an attribute, null when missing or empty."""
    pattern = rf"(?is)(?:^|[\s\"'/]){name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
    raw = f"regexp_extract({attrs}, {quoted(pattern)}, 1)"
    return f"""nullif(regexp_replace({raw}, {quoted(r"^[\"']|[\"']$")}, ''), '')"""


def attribute(attrs: Column, name: str) -> Column:
    """Value of an attribute, null when missing or empty."""
    return let_sql(attrs, f"a -> {attribute_sql('a', name)}")


# `p` is the text after "<a".
_LINKS = f"""v -> transform(slice(v, 2, size(v)), (p, n) -> get(transform(array(regexp_extract(p, {quoted(f"^{ATTRS}>")}, 0)),
    g -> named_struct('pos', n,
      'anchor', get(transform(array(regexp_replace(get(split(substr(p, length(g) + 1), {quoted(r"(?i)</a\s*>")}, 2), 0),
        {quoted(TAG)}, '')), s -> {DECODE_SQL}), 0),
      'href', get(transform(array({attribute_sql('g', 'href')}), s -> {DECODE_SQL}), 0))), 0))"""


def links_of(stripped: Column) -> Column:
    """Links of a page that went through `strip_hidden`."""
    return let_sql(F.split(stripped, r"(?i)<a(?=[\s>/])"), _LINKS)


def links(html: Column) -> Column:
    """Anchors in document order as array<struct<pos, anchor, href>>."""
    return links_of(strip_hidden(html))


def sub_urls(page_links: Column, pattern: str) -> Column:
    """Absolute addresses inside href values, document order, duplicates kept."""
    hrefs = F.filter(F.transform(page_links, lambda k: k["href"]), lambda h: h.isNotNull())
    return F.flatten(F.transform(hrefs, lambda h: F.regexp_extract_all(h, F.lit(pattern), F.lit(0))))


@F.pandas_udf(StringType())
def parsed_visible_text(pages: pd.Series) -> pd.Series:
    """Visible text through the standard library's HTML parser, for input that
    the expression form cannot follow (engine="parser")."""
    from html.parser import HTMLParser

    hidden = {"script", "style", "iframe"}
    void = {"meta", "link", "base", "br", "img", "hr", "input", "source", "wbr", "area", "col", "embed", "track"}

    class Walk(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.stack, self.nodes, self.open = [], [], False

        def handle_starttag(self, tag, attrs):
            self.open = False
            if tag not in void:
                self.stack.append(tag)

        def handle_startendtag(self, tag, attrs):
            self.open = False

        def handle_endtag(self, tag):
            self.open = False
            if tag in self.stack:
                while self.stack.pop() != tag:
                    pass

        def handle_comment(self, data):
            self.open = False

        def handle_data(self, data):
            parent = self.stack[-1] if self.stack else "[document]"
            if parent in hidden or (parent in ("head", "html", "[document]") and not data.strip()):
                return
            if self.open and self.nodes:
                self.nodes[-1] += data
            else:
                self.nodes.append(data)
            self.open = True

    def run(page):
        if page is None:
            return None
        walk = Walk()
        walk.feed(page)
        walk.close()
        return "\n".join(walk.nodes)

    return pages.map(run)

import html as html_lib

import pytest
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions import html as hx
from pagemill.functions import meta as mx

S = lambda: F.col("s")

PAGE = """<!DOCTYPE html><html>
<head>
<title>A &amp; B</title>
<style>p{margin:0}</style><script>var t="</p><!-- x"; go(0);</script>
</head>
<body><!-- gone --><p>one<b>two</b></p>
<iframe>frame</iframe><a href="x>y" title=it's>three &eacute;</a></body></html>"""


def test_visible_text_drops_hidden_blocks(one):
    text = one(PAGE, hx.visible_text(S()))
    assert [t for t in text.split("\n") if t.strip()] == ["A & B", "one", "two", "three é"]


def test_visible_text_variants(one):
    assert "frame" in one(PAGE, hx.visible_text(S(), hide_iframe=False))
    assert " gone " in one(PAGE, hx.visible_text(S(), drop_comments=False))


def test_parser_engine_agrees(one):
    assert one(PAGE, hx.visible_text(S())).split() == one(PAGE, hx.parsed_visible_text(S())).split()


def test_title_and_clean_text_hold_title_three_times(one):
    assert one(PAGE, hx.title(S())) == "A & B"
    assert one("<html><title></title><p>x</html>", hx.title(S())) == ""
    text = one(PAGE, hx.clean_text(hx.title(S()), hx.visible_text(S())))
    assert text.startswith("A & B A & B\nA & B") and text.count("A & B") == 3
    assert one("<p> </p>", hx.clean_text(hx.title(S()), hx.visible_text(S()))) == ""


def test_unclosed_script_hides_the_rest(one):
    assert one("<p>a</p><script>b<p>c", hx.visible_text(S())) == "a"


def test_entities_match_the_standard_library(one):
    for text in ("a &amp; b", "&#233;&#xE9;&#150;&#0;&#x110000;", "&nbsp;x&ampfoo &copy 2017", "&& &; &notanent; &notit;", "plain"):
        assert one(text, hx.decode_entities(S())) == html_lib.unescape(text)


def test_links(one):
    page = "<a href='/a?x=1&amp;y=2'>one <b>two</b></a><A name=z>no</A><a href=http://b.com/c>d<a href=\"\">e</a>"
    rows = one(page, hx.links(S()))
    assert [(r.pos, r.anchor, r.href) for r in rows] == [
        (0, "one two", "/a?x=1&y=2"), (1, "no", None), (2, "d", "http://b.com/c"), (3, "e", None),
    ]


def test_sub_urls(one):
    page = '<a href="http://a.com/x_y?z">1</a><a href="/rel">2</a><a href="http://b.com/go?u=https://c.org/d">3</a>'
    assert one(page, hx.sub_urls(hx.links(S()), fixed.SUB_URL_PATTERN)) == [
        "http://a.com/x", "http://b.com/go", "https://c.org/d",
    ]


def test_utf8(spark):
    df = spark.createDataFrame([(b"ok \xc3\xa9",), (b"bad \xff!",)], "b binary")
    rows = df.select(hx.decode_utf8(F.col("b")).alias("x"), hx.decode_utf8(F.col("b"), strict=True).alias("y")).collect()
    assert [(r.x, r.y) for r in rows] == [("ok é", "ok é"), ("bad !", None)]


def tags(*metas):
    return "<html><head>" + "".join(metas) + "</head></html>"


def test_meta_last_wins_and_missing_content_is_skipped(one):
    page = tags('<meta name="AUTHOR" content=" a ">', "<meta name=author content='b'>", '<meta name="author">')
    assert one(page, mx.meta_author(mx.meta_tags(S()))) == "b"
    assert one(tags(), mx.meta_keywords(mx.meta_tags(S()))) == ""


def test_every_date_condition(one):
    cases = (
        [f'<meta name="{n}" content="2015-11-26">' for n in fixed.DATE_META_NAMES]
        + [f'<meta property="{n}" content="2015-11-26">' for n in fixed.DATE_META_PROPERTIES]
        + [f'<meta itemprop="{n}" content="2015-11-26">' for n in fixed.DATE_META_ITEMPROPS]
        + ['<meta http-equiv="Date" content="2015-11-26">']
    )
    assert len(cases) == 18
    for case in cases:
        assert one(tags(case), mx.meta_publish_date(mx.meta_tags(S()))) == "2015-11-26", case
    assert one(tags('<meta name="revised" content="2015-11-26">'), mx.meta_publish_date(mx.meta_tags(S()))) == ""


def test_first_and_last_date(one):
    page = tags('<meta name="date" content="2015-01-02">', '<meta name="pubdate" content="2016-01-02">')
    assert one(page, mx.meta_publish_date(mx.meta_tags(S()))) == "2016-01-02"
    assert str(one(page, mx.meta_date(mx.meta_tags(S())))) == "2015-01-02 00:00:00"


def test_og_url_by_name_and_property(one):
    by_property = tags('<meta property="og:url" content="http://p">')
    assert one(by_property, mx.meta_url(mx.meta_tags(S()))) == "http://p"
    assert one(by_property, mx.meta_url(mx.meta_tags(S()), by_property=False)) == ""
    assert one(tags('<meta name="og:url" content="http://n">'), mx.meta_url(mx.meta_tags(S()), by_property=False)) == "http://n"


def test_meta_guard_children_is_empty(one):
    page = tags('<meta name="author" content="a">')
    assert one(page, mx.meta_record(mx.meta_tags(S()), meta_guard="children")).author == ""


def test_json_ld_and_tag_dates(one):
    ld = '<script type="application/ld+json">{"datePublished": "2015-01-02", "dateCreated": "2015-01-03"}</script>'
    assert str(one(ld, mx.json_ld_date(S())))[:10] == "2015-01-03"
    assert str(one('<time datetime="2015-01-02">x</time>', mx.tag_date(S())))[:10] == "2015-01-02"
    assert one('<time datetime="soon">x</time><p class="pubdate">2015-01-02</p>', mx.tag_date(S())) is None
    assert str(one('<p class="pubdate">x</p><div class="date">2015-01-04</div>', mx.tag_date(S())))[:10] == "2015-01-04"


@pytest.mark.parametrize("unclosed", ["<!-- ", "<a href=x ", "<script ", "<title ", "<meta name=a ", "<style x>"])
def test_unclosed_markup_is_linear(spark, unclosed):
    """A megabyte of one unclosed form; the quadratic scan took hours."""
    import time

    from pagemill.functions import meta as mx

    page = "<p>text</p>" + unclosed * (1_000_000 // len(unclosed))
    df = spark.createDataFrame([(page,)], "s string").select(
        hx.visible_text(F.col("s")).alias("v"), hx.title(F.col("s")).alias("t"), mx.meta_tags(F.col("s")).alias("m"), hx.links(F.col("s")).alias("l")
    )
    started = time.time()
    assert df.first()["v"].startswith("text")
    assert time.time() - started < 30

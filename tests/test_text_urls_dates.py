import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.functions import dates as dx
from pagemill.functions import porter
from pagemill.functions import text as tx
from pagemill.functions import urls as ux

S = lambda: F.col("s")
MASK = '{"profanity"}'


@pytest.mark.parametrize(
    "text, expected",
    [
        ("bad", MASK), ("so bad.", f"so {MASK}."), ("a-bad x.bad abad badly", "a-bad x.bad abad badly"),
        ("_bad ébad", f"_{MASK} é{MASK}"), ("BAD bad bad", f"{MASK} {MASK} {MASK}"), ("very Bad word!", f"{MASK}!"),
        ("a+b", MASK), ("line\nbad", f"line\n{MASK}"),
    ],
)
def test_mask(one, text, expected):
    assert one(text, tx.mask_phrases(S(), ["very bad word", "bad", "a+b"])) == expected


def test_mask_order_flag(one):
    # After cleaning, a word at the start of a line follows a dot and is not masked.
    clean = tx.clean_control(S())
    assert one("x\nbad", tx.mask_phrases(clean, ["bad"])) == "x.bad"
    assert one("x\nbad", tx.clean_control(tx.mask_phrases(S(), ["bad"]))) == f"x.{MASK}"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abd -._é\n", max_size=30), min_size=20, max_size=40))
def test_mask_is_idempotent_and_tokens_are_words(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    masked = df.select(tx.mask_phrases(S(), ["bad", "d a"]).alias("s"))
    rows = masked.select("s", tx.mask_phrases(S(), ["bad", "d a"]).alias("again"), tx.tokens(S(), ["a"]).alias("t")).collect()
    for row in rows:
        assert row.s == row.again
        assert all(t.isalnum() and t == t.lower() and t != "a" for t in row.t)


def test_tokens(one):
    assert one("The foo_bar it's 42 Émile profanity", tx.tokens(S())) == ["42", "émile"]
    assert one("It's", tx.tokens(S(), [])) == ["it", "s"]


def test_model_tokens_keep_capitalised_stop_words(one):
    assert one("This this The tornadoes said ox running", tx.model_tokens(S())) == ["thi", "tornado", "run"]


STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky",
    "skies": "sky", "enjoy": "enjoy", "relational": "relat", "conditional": "condit", "rational": "ration", "radicalli": "radic",
    "geology": "geolog", "vietnamization": "vietnam", "sensibiliti": "sensibl", "triplicate": "triplic", "electrical": "electr",
    "hopefulness": "hope", "revival": "reviv", "adoption": "adopt", "replacement": "replac", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "dying": "die", "news": "news",
    "died": "die", "flies": "fli", "by": "by", "say": "say", "cry": "cri", "is": "is", "innings": "inning",
}


def test_stems(spark):
    words = list(STEMS)
    got = spark.createDataFrame([(words,)], "w array<string>").select(porter.stems(F.col("w"))).first()[0]
    assert dict(zip(words, got)) == STEMS


def test_sentences(one):
    text = "One two three four. Too short. Five six seven more.Eight nine ten eleven!\nTen eleven twelve thirteen? a b"
    assert one(text, tx.sentences(S())) == ["One two three four.", "Five six seven more.", "Eight nine ten eleven!", "Ten eleven twelve thirteen?"]


URLS = [
    # url, domain, location, host, strict host, canonical, file name
    ("http://a.com:8080/x", "http://a.com:8080/", "com:8080", "a.com:8080", "a.com:8080", "http://a.com:8080/x", "a.com8080_x"),
    ("https://b.co.uk", "https://b.co.uk/", "uk", "b.co.uk", "b.co.u", "https://b.co.uk", "b.co.uk"),
    ("HTTP://C.org/p?q=1#f", "http://C.org/", "", "C.org", "C.org", "HTTP://C.org/p", "C.org_p_q=1#f"),
    ("nothing", ":///", ":///"[:-1], "", "", "nothing", None),
    (" http://d.net/e/ ", ":///", ":///"[:-1], "d.net", "d.net", "http://d.net/e", "d.net_e__"),
]


@pytest.mark.parametrize("url, domain, location, host, strict, canonical, name", URLS)
def test_urls(one, url, domain, location, host, strict, canonical, name):
    assert one(url, ux.domain_name(S())) == domain
    assert one(url, ux.domain_location(ux.domain_name(S()))) == location
    assert one(url, ux.host(S())) == host
    assert one(url, ux.host(S(), strict=True)) == strict
    assert one(url, ux.canonical_link(S())) == canonical
    assert one(url, ux.file_name(S())) == name


def test_id_parameters(one):
    assert one("http://a/x?id=1#f", ux.canonical_link(S())) == "http://a/x"
    assert one("http://a/x?id=1#f", ux.canonical_link(S(), keep_id_params=True)) == "http://a/x?id=1"


def test_url_text(one):
    text = ux.url_text(F.lit(" Big Storm "), S())
    assert one("http://www.a.com/big_storm/2017.html", text) == "Big Storm a big storm 2017 "


DATES = {
    "2015-11-26T07:11:02Z": "2015-11-26 07:11:02", "201511261006": "2015-11-26 10:06:00", "2015-11-25 22:40:25": "2015-11-25 22:40:25",
    "2015-11-26": "2015-11-26 00:00:00", "2015-11-26T00:10:33+02:00": "2015-11-26 00:10:33", "2015-11-25T19:56:04+0000": "2015-11-25 19:56:04",
    "2015-11-26T11:53:00.000Z": "2015-11-26 11:53:00", "Thursday, November 26, 2015,  6:42 AM": "2015-11-26 06:42:00",
    "2015-11-26T14:42Z": "2015-11-26 14:42:00", "11/24/2015 01:05AM": "2015-11-24 01:05:00",
    "10:27:15 AM Thursday, November 26, 2015": "2015-11-26 10:27:15", "junk": "None", "": "None", "2015-13-45": "None",
}


@pytest.mark.parametrize("text, expected", DATES.items())
def test_parse_date(one, text, expected):
    assert str(one(text, dx.parse_date(S()))) == expected


@pytest.mark.parametrize(
    "url, expected",
    [("http://a/2017/08/21/x", "2017-08-21"), ("http://a/2017/aug/21/", "2017-08-21"), ("http://a/2017-total-x", "None"),
     ("http://a/x", "None"), ("http://a/20170821/", "2017-08-21")],
)
def test_url_date(one, url, expected):
    assert str(one(url, dx.url_date(S())))[:10] == expected


@pytest.mark.parametrize(
    "days, kind, expected",
    [(0, "Shooting", 1.0), (29, "Shooting", 1.0), (30, "Shooting", 0.0), (31, "Shooting", 0.0), (-1, "Shooting", 0.0),
     (-15, "Hurricane", 0.5), (-31, "Hurricane", 1 - 31 / 30), (None, "Shooting", 0.0)],
)
def test_date_score(spark, days, kind, expected):
    event = F.lit("2020-06-01 12:00:00").cast("timestamp")
    page = F.lit(None).cast("timestamp") if days is None else event + F.make_dt_interval(F.lit(days))
    assert spark.range(1).select(dx.date_score(page, event, kind)).first()[0] == pytest.approx(expected)


@pytest.mark.parametrize(
    "text, day",
    [
        ("Nov. 26, 2015", "2015-11-26 00:00"), ("Sept 3, 2015", "2015-09-03 00:00"), ("26.11.2015", "2015-11-26 00:00"),
        ("November 26th, 2015", "2015-11-26 00:00"), ("26-Nov-2015", "2015-11-26 00:00"), ("11/26/15", "2015-11-26 00:00"),
        ("26 November 2015 14:42", "2015-11-26 14:42"), ("2015-11-26 14:42 EST", "2015-11-26 14:42"),
    ],
)
def test_more_date_layouts(one, text, day):
    assert one(text, F.date_format(dx.parse_date(F.col("s")), "yyyy-MM-dd HH:mm")) == day

"""Long phrase lists: every route gives the same rows."""

import random

import pytest
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.operators import entities as en
from pagemill.operators import phrases as ph

MASK = fixed.MASK_TEXT
ROUTES = {"pattern": (10**6, 0), "trie": (-1, 10**6), "join": (-1, -1)}
WORDS = ["bad", "very bad", "Very Bad Word", "a+b", "#tag", "  spaced  ", "x_y", "é ü", "bad", "", "  ", None, "-d", "ends.", "$"]
CASES = {
    "so bad, BAD; a very bad word": f"so {MASK}, {MASK}; a {MASK}",
    "very badly very bad-ly": f"very badly {MASK}-ly",
    "x.bad y-bad z_bad bad_z": f"x.bad y-bad z_{MASK} bad_z",
    "a+b aa+b a+bc #tag c#tag": f"{MASK} aa+b a+bc {MASK} c#tag",
    "spaced x_y xx_y é ü É ü": f"{MASK} {MASK} xx_y {MASK} É ü",
    "bad bad\nvery\nbad": f"{MASK} {MASK}\nvery\n{MASK}",
    "é ü\U0001f600bad\U0001f600": f"{MASK}\U0001f600{MASK}\U0001f600",
    "ends. ends.x -d x-d $ 5$": f"{MASK} ends.x {MASK} x-d {MASK} 5$",
}


@pytest.fixture(scope="module")
def listed(spark):
    return spark.createDataFrame([(w,) for w in WORDS], "word string")


@pytest.mark.parametrize("route", ROUTES)
def test_masks(spark, listed, route):
    pattern, trie = ROUTES[route]
    rows = [(i % 3, t) for i, t in enumerate(CASES)] + [(1, None), (2, ""), (2, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = ph.mask_listed(df, "text", listed, pattern=pattern, trie=trie)
    assert got.columns == ["id", "text", "masked"]
    found = sorted(((r.text, r.masked) for r in got.collect()), key=str)
    assert found == sorted([*CASES.items(), (None, None), ("", ""), ("", "")], key=str)


def test_routes_agree_on_random_texts(spark):
    rng = random.Random(4)
    pieces = ["a", "b", "ab", " ", " ", "-", ".", "_", "é", "A", "+"]
    make = lambda n: "".join(rng.choice(pieces) for _ in range(n))
    texts = spark.createDataFrame([(make(60),) for _ in range(80)], "text string")
    words = spark.createDataFrame([(make(rng.randint(1, 5)),) for _ in range(60)], "word string")
    ways = [sorted(map(tuple, ph.mask_listed(texts, "text", words, pattern=p, trie=t).collect())) for p, t in ROUTES.values()]
    assert ways[0] == ways[1] == ways[2]


@pytest.mark.parametrize("route", ROUTES)
def test_empty_lists_and_tables(spark, listed, route):
    pattern, trie = ROUTES[route]
    df = spark.createDataFrame([("bad",)], "text string")
    assert ph.mask_listed(df, "text", listed.where("word = ''"), pattern=pattern, trie=trie).first().masked == "bad"
    assert ph.mask_listed(df.limit(0), "text", listed, pattern=pattern, trie=trie).count() == 0


def test_clean_options_take_a_table(spark, listed):
    from pagemill.plans.clean import CleanOptions, clean_flat

    fetched = spark.createDataFrame(
        [("http://a.org/x", "<html><title>t</title><p>so bad, very bad word</p></html>", 200, "text/html", None, "1")],
        "url string, html string, status int, content_type string, error string, stamp string",
    )
    for after in (False, True):
        row = clean_flat(fetched, CleanOptions(phrases=listed, mask_after_clean=after)).first()
        assert row.clean_text_profanity.endswith(f"so {MASK}, {MASK}")


def test_large_gazetteer_builds_grams_at_first_words_only(spark):
    rng = random.Random(8)
    names = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3_000)]
    docs = spark.createDataFrame([(i, [rng.choice(names) for _ in range(200)]) for i in range(20)], "doc_id long, tokens array<string>")
    long = docs.first().tokens[20:50]
    phrases = [" ".join(rng.choice(names[:100]) for _ in range(2)) for _ in range(20_000)] + [" ".join(long)]
    phrases += [" ".join(r.tokens[k : k + 2]) for r in docs.collect() for k in (3, 90)]
    gaz = spark.createDataFrame([(p, "PERSON") for p in phrases], "phrase string, type string")
    ways = [sorted(map(tuple, en.match_phrases(docs, "doc_id", "tokens", gaz, limit=n).collect())) for n in (10**6, 0)]
    assert ways[0] == ways[1] and len(ways[0]) >= 41
    assert [h for h in ways[0] if h[2] == 30] == [(0, 20, 30, " ".join(long), "PERSON")]
    # Of 4,000 places, those of first words become grams: not thirty for each.
    entries = en._entries(gaz, None)
    firsts = {p.split()[0] for p in phrases}
    places = sum(t in firsts for r in docs.collect() for t in r.tokens)
    arrays = docs.withColumnRenamed("doc_id", "_k")
    plan = ph.listed_grams(arrays, "_k", "tokens", entries, " ")
    assert plan.count() == len(ways[0])
    heads = {r["head"]: r["sizes"] for r in ph.heads(entries).collect()}
    assert set(heads) == firsts and sum(len(s) for s in heads.values()) <= len(firsts) + 1 and places < 400

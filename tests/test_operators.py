import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pagemill.functions.arrays import runs, term_counts
from pagemill.operators import entities as en
from pagemill.operators import language as lg
from pagemill.operators import lookup as lk
from pagemill.operators import ordering as od
from pagemill.operators import tables as tb
from pagemill.operators import terms as tm
from pagemill.operators import tweets as tw


def test_runs_and_term_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b", "b"],), ([],), (None,)], "t array<string>")
    rows = df.select(runs(F.col("t")).alias("r"), term_counts(F.col("t")).alias("c")).collect()
    assert [tuple(x) for x in rows[0].r] == [(0, 1), (1, 1), (2, 2)]
    assert [tuple(x) for x in rows[0].c] == [("a", 1), ("b", 3)]
    assert rows[1].c == [] and not rows[2].c


def test_running_totals_match_a_plain_loop(spark):
    rng = random.Random(1)
    # One value on a third of all rows; the id breaks ties.
    rows = [(i, 5 if i % 3 == 0 else rng.randrange(20), rng.randrange(2)) for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, v bigint, label bigint").repartition(7)
    got = od.running_totals(df, [F.desc("v"), F.asc("id")], {"rel": F.col("label")}).collect()
    total, expected = 0, {}
    for n, (i, v, label) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0]))):
        total += label
        expected[i] = (n, total)
    assert {r.id: (r.position, r.rel) for r in got} == expected


def test_batches_have_no_empty_batch(spark):
    df = spark.range(20).withColumnRenamed("id", "k")
    assert Counter(r.batch for r in od.batches(df, [F.col("k")], 5).collect()) == {0: 5, 1: 5, 2: 5, 3: 5}


@pytest.mark.parametrize("ids_per_row", [3, 1000])
def test_tweets_by_url_keeps_every_tweet(spark, ids_per_row):
    rng = random.Random(2)
    rows = [(str(i), f"c{i % 4}", f"#n{i % 4}", "hot" if i % 3 == 0 else f"u{rng.randrange(40)}", i) for i in range(200)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "tweet_id string, collection_id string, collection_name string, url string, seq bigint")
    got = tw.tweets_by_url(df, ids_per_row=ids_per_row).collect()
    assert all(len(r.tweet_ids) <= ids_per_row for r in got)
    lists = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.url, r.chunk)):
        lists[r.url] += r.tweet_ids
    expected, first = defaultdict(list), {}
    for t, c, n, u, _ in sorted(rows, key=lambda r: r[4]):
        expected[u].append(t)
        first.setdefault(u, c)
    assert lists == expected
    assert all(first[r.url] == r.collection_id and r.n_tweets == len(expected[r.url]) for r in got)
    assert {r.chunk for r in got if r.url != "hot"} >= {0}


GAZETTEER = [("new york", "LOCATION"), ("new york times", "ORGANIZATION"), ("paris", "PERSON"), ("hilton", "PERSON"), ("texas", "LOCATION")]
TOKENS = ["New", "York", "times", "x", "paris", "hilton", "texas", "york", "new", "york"]


@pytest.mark.parametrize("limit", [1000, 0])
def test_entity_tags_both_routes(spark, limit):
    docs = spark.createDataFrame([(1, TOKENS), (2, ["nothing"]), (3, []), (4, None)], "doc_id bigint, tokens array<string>")
    gaz = spark.createDataFrame(GAZETTEER, "phrase string, type string")
    out = en.tag_arrays(docs, "doc_id", "tokens", gaz, limit=limit)
    phrases = en.merge_phrases(F.col("tokens"), F.col("tags"), "PERSON")
    rows = {r.doc_id: r for r in out.select("doc_id", "tags", phrases.alias("people"),
                                            en.tokens_with_tag(F.col("tokens"), F.col("tags"), "LOCATION").alias("where")).collect()}
    o, p, loc = "ORGANIZATION", "PERSON", "LOCATION"
    assert rows[1].tags == [o, o, o, "O", p, p, loc, "O", loc, loc]
    # Two neighbouring people merge.
    assert rows[1].people == ["paris hilton"] and rows[1]["where"] == ["texas", "new", "york"]
    assert rows[2].tags == ["O"] and rows[3].tags == [] and rows[4].tags is None


def test_phrase_hits_are_the_same_on_every_route(spark, monkeypatch):
    docs = spark.createDataFrame([(1, TOKENS), (2, [])], "doc_id bigint, tokens array<string>")
    gaz = spark.createDataFrame(GAZETTEER, "phrase string, type string")
    ways = []
    for literal, limit in ((10, 100), (0, 100), (0, 0)):
        monkeypatch.setattr(en, "LITERAL_PHRASES", literal)
        ways.append(sorted(map(tuple, en.match_phrases(docs, "doc_id", "tokens", gaz, limit=limit).collect())))
    assert ways[0] == ways[1] == ways[2] and len(ways[0]) == 6


def test_merge_tagged_rows(spark):
    tags = ["PERSON", "PERSON", "O", "PERSON", "LOCATION", "LOCATION"]
    rows = [(1, i, f"t{i}", t) for i, t in enumerate(tags)]
    df = spark.createDataFrame(rows, "doc_id bigint, pos bigint, token string, tag string")
    for source in (df, df.filter("tag <> 'O'")):
        got = {(r.start, r.tag, r.phrase) for r in en.merge_tagged_rows(source).collect()}
        assert got == {(0, "PERSON", "t0 t1"), (3, "PERSON", "t3"), (4, "LOCATION", "t4 t5")}


@pytest.mark.parametrize("limit", [1000, 0])
def test_lookups_both_routes(spark, limit):
    docs = spark.createDataFrame([(1, ["cats", "run", "cats", "7", "slowly"]), (2, []), (3, None)], "doc_id bigint, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "cat")], "form string, lemma string")
    lexicon = spark.createDataFrame([("run", "VB")], "token string, tag string")
    df = lk.pos_tags(lk.lemmatize(docs, "doc_id", "tokens", lemmas, limit=limit), "doc_id", "tokens", lexicon, limit=limit)
    rows = {r.doc_id: r for r in df.collect()}
    assert rows[1].lemmatized == ["cat", "run", "cat", "7", "slowly"]
    assert rows[1].pos == ["cats:NNS", "run:VB", "cats:NNS", "7:CD", "slowly:RB"]
    assert rows[2].lemmatized == [] and rows[3].pos is None


def test_language_both_routes_agree(spark):
    docs = spark.createDataFrame(
        [(1, "en", "the cat and the dog went with them"), (2, "de", "der hund und die katze gehen nicht"),
         (3, "fr", "le chat et la souris sont dans la maison"), (4, "fr", "!!!")], "doc_id bigint, lang string, text string",
    )
    profiles = lg.train_profiles(docs)
    ways = [
        {r.doc_id: [(s.lang, round(s.prob, 9)) for s in r.languages] for r in lg.detect_language(docs, profiles, limit=n).collect()}
        for n in (10_000, 0)
    ]
    assert ways[0] == ways[1]
    assert [ways[0][i][0][0] for i in (1, 2, 3)] == ["en", "de", "fr"] and ways[0][4] == []


def test_vocabulary_ties_and_vectors(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "a"]), (2, ["b", "a", "c"]), (3, ["a", "b"])], "doc_id bigint, tokens array<string>")
    vocab = tm.vocabulary(docs)
    assert [(r.term, r.df, r.cf) for r in tm.top_terms(vocab, 2).collect()] == [("a", 3, 4), ("b", 3, 3)]
    assert {r.doc_id: r.max_tf for r in tm.document_max_tf(docs).collect()} == {1: 2, 2: 1, 3: 1}


def test_stop_join_shuffle_route(spark):
    tokens = spark.createDataFrame([(1, 0, "the"), (1, 1, "cat")], "doc_id bigint, pos int, token string")
    stop = spark.createDataFrame([("the",), ("the",)], "token string")
    for limit in (0, 10):
        assert [r.token for r in tm.remove_stop_tokens(tokens, stop, limit).collect()] == ["cat"]


def test_consolidate_last_write_wins(spark):
    old = spark.createDataFrame([("k", 1, "old"), ("m", 5, "keep")], "row_key string, fetch_time bigint, title string")
    new = spark.createDataFrame([("k", 2, "0200"), ("m", 5, "tie")], "row_key string, fetch_time bigint, status_code string")
    rows = {r.row_key: r for r in tb.consolidate(old, new).collect()}
    assert rows["k"].title is None and rows["k"].status_code == "0200"
    assert rows["m"].status_code == "tie"


@pytest.mark.parametrize("limit", [1000, 0])
def test_lookups_with_repeated_ids(spark, limit):
    docs = spark.createDataFrame([(1, ["cats", "x"]), (1, ["dog"]), (1, ["dog"]), (None, ["cats"])], "doc_id bigint, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "cat")], "form string, lemma string")
    rows = lk.lemmatize(docs, "doc_id", "tokens", lemmas, limit=limit).select("lemmatized").collect()
    assert sorted(r.lemmatized for r in rows) == [["cat"], ["cat", "x"], ["dog"], ["dog"]]


@pytest.mark.parametrize("limit", [1000, 0])
def test_long_phrases_and_repeated_ids(spark, limit):
    from pagemill.functions.text import tokens

    text = "Visit O'Hare and the united states of america today"
    docs = spark.createDataFrame([(1, text), (1, text), (1, "o hare")], "doc_id bigint, text string").withColumn("tokens", tokens(F.col("text")))
    listed = spark.createDataFrame(
        [("O'Hare", "PLACE"), ("The United States of America today", "EVENT"), ("of the", "NONE")], "phrase string, type string"
    )
    rows = en.tag_arrays(docs, "doc_id", "tokens", listed, limit=limit, cut=tokens).select("tokens", "tags").collect()
    found = sorted([(t, g) for t, g in zip(r.tokens, r.tags) if g != "O"] for r in rows)
    place, event = [("hare", "PLACE")], [(w, "EVENT") for w in ("united", "states", "america", "today")]
    assert found == sorted([place + event, place + event, place])


def test_cosine_routes_agree_on_repeated_urls(spark):
    from pagemill.plans.relevance import cosine_to_model

    rows = [("u", [("a", 2), ("b", 1)]), ("u", [("c", 1)]), ("u", [("a", 2), ("b", 1)]), ("v", []), ("w", None)]
    docs = spark.createDataFrame(rows, "url string, terms array<struct<term:string,tf:bigint>>")
    model = spark.createDataFrame([("a", 0.5), ("c", 0.25)], "term string, weight double")
    ways = [
        sorted((r.url, round(r.score, 9)) for r in cosine_to_model(docs.where("terms is not null"), "no_such_column", "terms", model, "score", n).collect())
        for n in (10, 0)
    ]
    assert ways[0] == ways[1] and len(ways[0]) == 4


def test_language_pairs(spark):
    df = spark.createDataFrame([([(0.75, "en"), (0.25, "fr")],)], "languages array<struct<prob:double,lang:string>>")
    row = df.select(lg.language_pairs(F.col("languages")).alias("p"), lg.language_codes(F.col("languages")).alias("c")).first()
    assert row.p == ["en:0.75", "fr:0.25"] and row.c == ["en", "fr"]

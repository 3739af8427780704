import heapq
import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagemill.functions.arrays import term_counts
from pagemill.plans import clean as cl
from pagemill.plans import evaluate as ev
from pagemill.plans import frontier as fr
from pagemill.plans import relevance as rv

FETCHES = [
    ("http://a.com/p", 200, "text/html", "<title>T</title><p>bad cats\nrun</p>", 10, None),
    ("http://a.com/i.jpg", 200, "text/html", "<p>x</p>", 11, "boom"),
    ("http://a.fr/e", 200, "text/html", "<p>x</p>", 12, "boom"),
    ("http://a.fr/n", 404, "text/html", "<p>x</p>", 13, None),
    ("http://a.fr/pdf", 200, "application/pdf", "x", 14, None),
    ("http://a.fr/empty", 200, "text/html", "<html> </html>", 15, None),
    ("http://a.fr/og", 200, "text/html; charset=x", '<meta name="og:url" content="http://real/\tx"><p>y</p>', 16, None),
]


@pytest.fixture
def fetched(spark):
    df = spark.createDataFrame(FETCHES, "url string, status int, content_type string, html string, t bigint, error string")
    return df.withColumn("fetch_time", F.timestamp_seconds("t")).drop("t")


def test_clean_pages_statuses_and_fields(fetched):
    rows = {r.row_key: r for r in cl.clean_flat(fetched, cl.CleanOptions(phrases=["bad"], collection_name="#E")).collect()}
    assert len(rows) == len(FETCHES)
    codes = {k: r.status_code for k, r in rows.items()}
    assert codes == {
        "http://a.com/p-10": "0200", "http://a.com/i.jpg-11": "1001", "http://a.fr/e-12": "2001", "http://a.fr/n-13": "0404",
        "http://a.fr/pdf-14": "1001", "http://a.fr/empty-15": "2000", "http://real/x-16": "0200",
    }
    page = rows["http://a.com/p-10"]
    assert page.clean_text == 'T T.T.bad cats.run' and page.clean_text_profanity == 'T T.T.{"profanity"} cats.run'
    assert page.tokens == ["cats", "run"] and page.stemmed == ["cat", "run"] and page.real_world_events == "E"
    assert rows["http://a.com/i.jpg-11"].mime_type == "image/jpg" and rows["http://a.fr/pdf-14"].mime_type == "application/pdf"
    assert rows["http://a.fr/n-13"].title is None and rows["http://a.fr/n-13"].url == "http://a.fr/n"
    # The domain is that of the fetched address.
    assert rows["http://real/x-16"].domain_name == "http://a.fr/" and rows["http://real/x-16"].domain_location == "fr"


def test_clean_variants(fetched):
    options = cl.CleanOptions(phrases=["bad"], mask_after_clean=True, strict_reference=True, empty_text_code="2001", meta_guard="children")
    rows = {r.fetch_time: r for r in cl.clean_flat(fetched, options).collect()}
    assert rows["10"].clean_text_profanity == "T T.T.bad cats.run"
    assert rows["13"].url is None and rows["15"].status_code == "2001"
    assert rows["16"].url == "http://a.fr/og"


def test_tweet_pages_have_one_record_and_all_ids(spark, fetched):
    rows = [(str(i), "7", "#E", "http://a.com/p", i) for i in range(7)] + [("99", "8", "#F", "http://gone", 99)]
    tweets = spark.createDataFrame(rows, "tweet_id string, collection_id string, collection_name string, url string, seq bigint")
    records, ids = cl.clean_tweet_tables(tweets, fetched, ids_per_row=3)
    out = records.select("row_key", "metadata.*", "webpage.tweet_ids").collect()
    pages = fetched.where("url = 'http://a.com/p'").count()
    assert len(out) == len({r.row_key for r in out}) == pages
    assert {(r.collection_id, r.collection_name, r.source) for r in out} == {("7", "#E", "yTK")}
    assert all(r.tweet_ids == ["0", "1", "2"] for r in out)
    lists = sorted((r.row_key, r.chunk, r.tweet_ids, r.n_tweets) for r in ids.collect())
    assert lists == sorted((r.row_key, k, [str(i) for i in range(3 * k, min(3 * k + 3, 7))], 7) for r in out for k in range(3))
    assert cl.clean_tweet_pages(tweets, fetched, ids_per_row=3).count() == pages


def test_cosine_routes_agree(spark):
    docs = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["z"]), (3, [])], "doc_id bigint, tokens array<string>")
    docs = docs.withColumn("terms", term_counts(F.col("tokens")))
    model = spark.createDataFrame([("a", 1.0), ("c", 2.0)], "term string, weight double")
    for literal_terms in (10, 0):
        got = {r.doc_id: r.c for r in rv.cosine_to_model(docs, "doc_id", "terms", model, "c", literal_terms).collect()}
        assert got[1] == pytest.approx(2 / (math.sqrt(5) * math.sqrt(5))) and got[2] == 0 and got[3] == 0
    same = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "term string, weight double")
    assert rv.cosine_to_model(docs, "doc_id", "terms", same, "c").filter("doc_id = 1").first().c == pytest.approx(1.0)


def test_topic_model_against_plain_python(spark):
    rng = random.Random(3)
    docs = [(i, [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 12))]) for i in range(30)]
    got = {r.term: r.weight for r in rv.build_topic_model(spark.createDataFrame(docs, "doc_id bigint, tokens array<string>"), k=4).collect()}
    counts = [{t: ts.count(t) for t in ts} for _, ts in docs]
    score = {}
    for t in "abcdefgh":
        with_t = [c[t] for c in counts if t in c]
        if len(with_t) >= 2:
            score[t] = len(with_t) * sum(with_t)
    top = sorted(score, key=lambda t: (-score[t], t))[:4]
    expected = {t: sum(c[t] / max(c.values()) for c in counts if t in c) / len(docs) for t in top}
    assert got == pytest.approx(expected)


def test_event_model_and_scores(spark):
    text = "The storm hit Texas and New York today. Then Texas was dark and wet again."
    docs = spark.createDataFrame(
        [(1, text, datetime(2020, 1, 5)), (2, text, datetime(2020, 1, 3)), (3, text, None)], "doc_id bigint, text string, pub_date timestamp"
    )
    from pagemill.functions.text import model_tokens

    docs = docs.withColumn("tokens", model_tokens(F.col("text")))
    gaz = spark.createDataFrame([("texas", "LOCATION"), ("new york", "LOCATION"), ("york", "LOCATION")], "phrase string, type string")
    model = rv.build_event_model(docs, gaz, min_count=3)
    assert str(model.event_date)[:10] == "2020-01-03"
    assert {r.term: r.weight for r in model.locations.collect()} == {"texas": 1.0, "new york": 0.5}
    ready = rv.with_locations(docs, rv.location_mentions(docs, gaz)).withColumn("terms", term_counts(F.col("tokens")))
    late = F.when(F.col("doc_id") == 1, F.lit(datetime(2020, 3, 1))).otherwise(F.col("pub_date"))
    failed = F.when(F.col("doc_id") != 3, F.col("locations"))
    rows = {r.doc_id: r.score for r in rv.EventScorer(model).page_scores(ready.withColumn("pub_date", late).withColumn("locations", failed), "doc_id").collect()}
    assert rows[1] == 0.0 and rows[3] == -1.0
    topic = rv.cosine_to_model(ready, "doc_id", "terms", model.topic, "c").filter("doc_id = 2").first().c
    assert rows[2] == pytest.approx(0.4 * topic + 0.2 * 1.0 + 0.4)


def host(url):
    return url.split("//", 1)[1].split("/")[0]


def heap_crawl(seeds, pages, links, limit, method, restricted):
    queue = [(-1.0, s, -1) for s in seeds]
    heapq.heapify(queue)
    visited, out, sources = set(), [], {}
    while len(out) < limit and queue:
        neg, url, parent = heapq.heappop(queue)
        if url in visited:
            continue
        visited.add(url)
        score = pages.get(url)
        if score is None or score == -1 or (restricted and score < 0.5):
            continue
        label = int(score >= 0.5)
        counts = sources.setdefault(host(url), [1.0, 1.0])
        counts[0 if label else 1] += 1
        page_id = len(out)
        out.append((page_id, url, parent, label))
        if score < 0.1:
            continue
        for src, dst, link in links:
            if src != url or dst in visited or score * link < 0.1:
                continue
            total = score * link
            rel, non = sources.get(host(dst), [1.0, 1.0])
            if method == 1 and label:
                total *= rel / non
            elif method == 2:
                total = 0.6 * total + 0.4 * rel / non
            if total >= 0.1:
                heapq.heappush(queue, (-total, dst, page_id))
    return out, visited


@pytest.mark.parametrize("method, restricted, batch", [(1, False, 1), (2, True, 1), (1, False, 4), (2, False, 12), (1, True, 12)])
def test_frontier_batches_equal_a_heap(spark, method, restricted, batch):
    rng = random.Random(method)
    urls = [f"http://h{i % 3}.org/{i}" for i in range(12)]
    pages = {u: rng.choice([-1.0, 0.05, 0.3, 0.6, 0.9]) for u in urls[:10]}
    links = [(rng.choice(urls), rng.choice(urls), rng.choice([0.2, 0.5, 0.9])) for _ in range(40)]
    seeds = urls[:2]
    for s in seeds:
        pages[s] = 0.8
    expected, visited = heap_crawl(seeds, pages, links, 7, method, restricted)
    out = fr.focused_expand(
        spark.createDataFrame([(s,) for s in seeds], "url string"),
        spark.createDataFrame(list(pages.items()), "url string, score double"),
        spark.createDataFrame(links, "src_url string, dst_url string, link_score double"),
        fr.CrawlOptions(page_limit=7, combine_method=method, restricted=restricted, buckets=4, batch=batch),
    )
    got = sorted((r.page_id, r.url, r.parent_id, r.label) for r in out.scored.collect())
    assert got == expected
    seen = [r.url for r in out.visited.collect()]
    assert len(seen) == len(set(seen)) and set(seen) == visited


def test_frontier_batches_visit_once_and_respect_the_limit(spark):
    urls = [f"http://h.org/{i}" for i in range(40)]
    pages = spark.createDataFrame([(u, 0.9) for u in urls], "url string, score double")
    # One page holds a third of all links.
    pairs = [(urls[0], u, 0.9) for u in urls] + [(urls[i], urls[(i * 7 + 1) % 40], 0.9) for i in range(40)] * 2
    links = spark.createDataFrame(pairs, "src_url string, dst_url string, link_score double")
    out = fr.focused_expand(spark.createDataFrame([(urls[0],)], "url string"), pages, links, fr.CrawlOptions(page_limit=25, batch=10, exact=False))
    rows = out.scored.collect()
    assert sorted(r.page_id for r in rows) == list(range(25)) and len({r.url for r in rows}) == 25


def test_batches_end_where_a_link_overtakes(spark):
    batch = spark.createDataFrame([(0, 0.9), (1, 0.8), (2, 0.5), (3, 0.5)], "rank long, score double")
    for links, stop in (([], 4), ([(0, 0.3)], 4), ([(0, 0.6)], 2), ([(0, 0.85)], 1), ([(2, 0.5)], 3), ([(3, 0.99)], 4), ([(0, 0.8)], 1)):
        assert fr.undisturbed(batch, spark.createDataFrame(links, "rank long, total double")) == stop


def test_large_batches_are_numbered_in_ranges(spark, monkeypatch):
    rows = [(0.5 if i % 3 else 0.9, f"u{i:03}", i % 2) for i in range(200)] * 2
    front = spark.createDataFrame(rows, "score double, url string, parent_id bigint")
    seen = spark.createDataFrame([("u000",), ("u007",)], "url string")
    ways = []
    for small in (1000, 10):
        monkeypatch.setattr(fr, "SMALL_BATCH", small)
        ways.append((sorted(map(tuple, fr.pop_best(front, seen, 50).collect())),
                     sorted(map(tuple, fr.first_rows(fr.pop_best(front, seen, None), fr._by("score"), 50, "n").select("n", "url").collect()))))
    assert ways[0] == ways[1] and [n for n, _ in ways[0][1]] == list(range(50))


def test_link_candidates(spark):
    hrefs = ["http://a/x?y#z", "http://a/b/", "http://a/f.pdf", "http://a/feed/", "/rel", "", None, "http://m.tempo.co/x", " https://ok/p "]
    links = spark.createDataFrame([("s", i, "t", h) for i, h in enumerate(hrefs)], "src_url string, pos int, anchor string, href string")
    assert [r.dst_url for r in fr.link_candidates(links).orderBy("pos").collect()] == ["http://a/x", "http://a/b", "https://ok/p"]


def test_evaluate(spark):
    scored = spark.createDataFrame([(0, 0.9), (1, 0.1), (2, 0.5)], "page_id bigint, score double")
    labelled = ev.label_pages(scored)
    assert [(r.rel, r.tot) for r in ev.harvest_curve(labelled).orderBy("page_id").collect()] == [(1, 1), (1, 2), (2, 3)]
    row = ev.harvest_summary(labelled).first()
    assert (row.relevant, row.total) == (2, 3)

"""What moves and how often things are worked out, on tables made here."""

import random
import time
from collections import Counter
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from pagemill.functions import porter as po
from pagemill.functions.arrays import few_at_once
from pagemill.operators import entities as en
from pagemill.operators import language as lg
from pagemill.operators import phrases as ph
from pagemill.operators import tagging as tg
from pagemill.operators import terms as tm
from pagemill.plans import relevance as rv
from pagemill.session import frequent_join, frequent_part, numbered, settle
from pagemill.streaming.state import CrawlState


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lists(spark):
    """Tokens in which every word begins a short and a long phrase."""
    rng = random.Random(7)
    docs = [(i % 9, [rng.choice("abcdefgh") for _ in range(80)]) for i in range(30)]
    docs += [(3, docs[3][1]), (None, docs[4][1]), (8, None), (8, [])]
    phrases = {" ".join(t[k:k + n]) for _, t in docs if t for k, n in ((0, 3), (5, 1), (9, 2), (20, 4), (30, 30))}
    gaz = spark.createDataFrame([(p, "A" if len(p) % 4 < 2 else "B") for p in sorted(phrases)], "phrase string, type string")
    return spark.createDataFrame(docs, "doc_id long, tokens array<string>"), gaz


@pytest.mark.parametrize("heads_fit", [True, False])
def test_listed_phrases_of_all_lengths_by_joins(lists, monkeypatch, heads_fit):
    docs, gaz = lists
    want = sorted(map(str, en.match_phrases(docs, "doc_id", "tokens", gaz).collect()))
    tags = sorted(map(str, en.tag_arrays(docs, "doc_id", "tokens", gaz).collect()))
    if not heads_fit:
        monkeypatch.setattr(ph, "fits", lambda *a: False)
    hits = en.match_phrases(docs, "doc_id", "tokens", gaz, limit=0)
    assert hits.columns == ["doc_id", "start", "words", "phrase", "type"]
    assert sorted(map(str, hits.collect())) == want and len(want) > 500
    assert sorted(map(str, en.tag_arrays(docs, "doc_id", "tokens", gaz, limit=0).collect())) == tags


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def test_places_of_a_large_gazetteer_move_in_rounds(spark, lists, monkeypatch):
    """They were all on the disks at one time. What a round moves is gone after it, and so
    are its entries; a phrase that comes twice counts once."""
    docs, gaz = lists
    gaz = gaz.union(gaz.withColumn("type", F.lit("Z")))
    want = sorted(map(str, en.match_phrases(docs, "doc_id", "tokens", gaz).collect()))
    monkeypatch.setattr(ph, "ROUND_PLACES", 100, raising=False)
    made, rows, write = [], [], settle
    monkeypatch.setattr(ph, "settle", lambda df, name, **k: made.append((name, write(df, name, **k))) or made[-1][1])
    before = shuffle_files(spark)
    hits = en.match_phrases(docs, "doc_id", "tokens", gaz, limit=0)
    for _ in range(50):
        rows = [r for name, df in made if name == "phrase-hits" for r in df.collect()]
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert [line for line in plan_of(hits).splitlines() if "Exchange" in line and "phrase" in line] == []
    assert shuffle_files(spark) <= before
    assert [name for name, _ in made].count("phrase-hits") == 8 + 4 and len(rows) >= len(want)
    path = spark._jvm.org.apache.hadoop.fs.Path
    left = [path(f) for name, df in made if name == "phrase-targets" for f in df.inputFiles()]
    assert left and not any(f.getFileSystem(spark._jsc.hadoopConfiguration()).exists(f) for f in left)
    assert sorted(map(str, hits.collect())) == want


def test_tags_of_a_large_gazetteer_move_no_tokens(spark, lists, monkeypatch):
    """A numbered table is not written again; only hits and sizes move for the tags."""
    docs, gaz = lists
    want = sorted(map(str, en.tag_arrays(docs, "doc_id", "tokens", gaz).collect()))
    kept = numbered(docs.withColumn("tokens", F.transform("tokens", F.upper)), "rows")
    monkeypatch.setattr(en, "numbered", None)
    tagged = en.tag_arrays(kept, "doc_id", "tokens", gaz, limit=0, row_col="_row")
    moved = [line for line in plan_of(tagged.select("doc_id", "tags")).splitlines() if "Exchange" in line]
    assert not any("tokens" in line for line in moved)
    low = tagged.select("doc_id", F.transform("tokens", F.lower).alias("tokens"), "tags")
    assert tagged.columns == ["doc_id", "tokens", "_row", "tags"] and sorted(map(str, low.collect())) == want
    hits = en.match_phrases(kept, "doc_id", "tokens", gaz, limit=0, row_col="_row")
    assert sorted(map(str, hits.collect())) == sorted(map(str, en.match_phrases(docs, "doc_id", "tokens", gaz).collect()))


def test_units_with_blanks_are_kept(spark):
    docs = spark.createDataFrame([(1, ["x", "a b", "c", "a", "b c"])], "doc_id long, tokens array<string>")
    gaz = spark.createDataFrame([("a b_c", "A"), ("a b_c", "B"), ("c_a", "C")], "phrase string, type string")
    cut = lambda c: F.split(c, "_")
    assert sorted({tuple(r.units) for r in en._entries(gaz, cut).collect()}) == [("a b", "c"), ("c", "a")]
    ways = [sorted(map(tuple, en.match_phrases(docs, "doc_id", "tokens", gaz, limit=n, cut=cut).collect())) for n in (0, 100)]
    assert ways[0] == [(1, 1, 2, "a b c", "A"), (1, 2, 2, "c a", "C")]


def test_a_phrase_is_cut_once(spark):
    """A filter on what was cut used to cut again, several times for every phrase."""
    cuts = spark.sparkContext.accumulator(0)

    @F.udf(ArrayType(StringType()))
    def cut(text):
        cuts.add(1)
        return text.split()

    gaz = spark.createDataFrame([(f"a{i} b", "X") for i in range(50)] + [("", "X")], "phrase string, type string")
    assert en._entries(gaz, cut).count() == 50
    assert cuts.value == 51


def test_arrays_stay_while_short_phrases_are_found(spark):
    """Only places move: no list of them for every row, no units beside it."""
    texts = spark.createDataFrame([("a b c d",), ("b c",), (None,)], "text string")
    masked = ph.mask_listed(texts, "text", spark.createDataFrame([("a b",), ("c",)], "word string"), pattern=0, trie=0)
    moved = [line for line in plan_of(masked).splitlines() if "collect_list(struct(pos" in line or "_units" in line and "Exchange" in line]
    assert not moved
    assert {r.text: r.masked for r in masked.collect()} == {"a b c d": "{\"profanity\"} {\"profanity\"} d", "b c": "b {\"profanity\"}", None: None}


def test_stems_of_tokens_without_a_known_ending(spark):
    """Tokens that no step looks for skip them; the plain chain gives the same."""
    rng = random.Random(5)
    ends = ["", *(s for s, _ in po.STEP_2 + po.STEP_3), *po.STEP_4, "ies", "sses", "eed", "ied", "ed", "ing", "y", "ll", "logi", "alli", "é"]
    tokens = ["".join(rng.choice("aeioubcdlnrstyz") for _ in range(rng.randint(0, 6))) + rng.choice(ends) for _ in range(3_000)]
    df = spark.createDataFrame([([*tokens, *po.IRREGULAR, None, "ab\x01", ""],)], "t array<string>")
    chain = "t"
    for step in po._STEPS:
        chain = f"transform({chain}, x -> {step})"
    odd = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in po.IRREGULAR.items())
    plain = f"zip_with(t, {chain}, (w, s) -> CASE WHEN length(w) <= 2 THEN w ELSE coalesce(CASE w {odd} END, s) END)"
    row = df.select(po.stems(F.col("t")).alias("got"), F.expr(plain).alias("want")).first()
    assert row.got == row.want
    letters, pairs = po._endings()
    assert all(e[-1] in letters or e[-2:] in pairs for e in ends if len(e) > 1)


def test_terms_are_counted_once(spark):
    """Of the size of a generator's column Spark makes a filter, and counted all terms
    again for it."""
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None)], "doc_id long, tokens array<string>")
    docs = docs.select("doc_id", F.filter("tokens", lambda t: t != "z").alias("tokens"))
    weights = tm.normalised_tf(docs)
    assert plan_of(weights).count("sort_array(") == 1
    assert sorted(map(tuple, weights.collect())) == [(1, "a", 1.0), (1, "b", 0.5)]


def test_frequent_keys_are_joined_in_the_tasks(spark):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else f"k{int(i ** 0.39)}") for i in range(900)], "i long, k string")
    side = settle(spark.createDataFrame([(f"k{i}", i) for i in range(15)] + [("unused", -1)], "k string, v long"), "side")
    want = sorted(map(tuple, rows.join(side, "k").select("i", "k", "v").collect()))
    common = {r.k for r in frequent_part(rows, side, "k", 8).collect()}
    counts = Counter(k for _, k, _ in want)
    assert 0 < len(common) <= 8 and min(counts[k] for k in common) >= max(counts[k] for k in counts if k not in common)
    for limit in (100, 8, 0):
        assert sorted(map(tuple, frequent_join(rows, side, "k", limit).select("i", "k", "v").collect())) == want


def test_cosines_move_no_arrays(spark):
    docs = spark.createDataFrame([("u", [("a", 2), ("b", 1)]), ("u", [("c", 1)]), ("v", []), (None, None)], "url string, terms array<struct<term:string,tf:bigint>>")
    model = spark.createDataFrame([("a", 1.0), ("c", 2.0)], "term string, weight double")
    scored = rv.cosine_to_model(docs, "url", "terms", model, "score", literal_terms=0).select("url", F.round("score", 6).alias("score"))
    assert "to_json" not in plan_of(scored)
    assert sorted(map(str, scored.collect())) == sorted(map(str, rv.cosine_to_model(docs, "url", "terms", model, "score").select("url", F.round("score", 6).alias("score")).collect()))


def test_topic_scores_go_into_a_join_without_terms(spark):
    docs = spark.createDataFrame([(1, [("a", 2)], [("x", 1)], None), (2, [("b", 1)], [], None)],
        "doc_id long, terms array<struct<term:string,tf:bigint>>, locations array<struct<term:string,tf:bigint>>, pub_date timestamp")
    one = lambda t: spark.createDataFrame([(t, 1.0)], "term string, weight double")
    scorer = rv.EventScorer(rv.EventModel(one("a"), one("x"), one("x"), None))
    early = scorer.page_scores(scorer.with_topic(docs, "doc_id").drop("terms"), "doc_id")
    assert early.columns == ["doc_id", "locations", "pub_date", "score"]
    assert early.select("doc_id", "score").collect() == scorer.page_scores(docs, "doc_id").select("doc_id", "score").collect()


def test_tags_with_some_tokens_in_the_tasks(spark):
    rng = random.Random(3)
    rows = [(i, [f"w{min(rng.randint(0, 30), rng.randint(0, 30))}" for _ in range(rng.randint(0, 9))]) for i in range(60)] + [(60, None)]
    df = spark.createDataFrame(rows, "i long, tokens array<string>")
    model = tg.learn_tagger(df.withColumn("tags", F.transform("tokens", lambda t: F.concat(F.lit("T"), (F.length(t) + F.ascii(F.substring(t, -1, 1))) % 3))))
    new = spark.createDataFrame([(i, t and [*t, "unseen"]) for i, t in rows], "i long, tokens array<string>").unionByName(df)
    ways = [sorted(map(str, tg.tag_in_context(new, model, limit=n).collect())) for n in (100, 12, 0)]
    assert ways[0] == ways[1] == ways[2]
    plan = plan_of(tg.tag_in_context(new, model, limit=12))
    assert "Union" in plan and "to_json" not in plan


def test_few_rows_of_a_batch_are_python_objects():
    rows = [["a"] * (i % 3) if i % 5 else None for i in range(1_000)]
    sizes = []

    class Batch:
        def __init__(self, of):
            self.of = of

        def __len__(self):
            return len(self.of)

        def slice(self, at, n):
            return Batch(self.of[at:at + n])

        def to_pandas(self):
            sizes.append(len(self.of))
            return self.of

    assert [*few_at_once(Batch(rows))] == rows and max(sizes) <= 256


def test_word_scores_join_by_frequency(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "en", "one two two three"), (1, "en", "four"), (2, "de", "eins zwei zwei"), (3, "de", ""), (None, "en", None)],
        "doc_id long, lang string, text string")
    profiles = lg.train_profiles(docs)
    want = sorted((r.doc_id, r.n_grams, [round(s, 6) for s in r.scores]) for r in lg.language_scores(docs, profiles).collect())
    monkeypatch.setattr("pagemill.session.fits", lambda *a: False)
    assert sorted((r.doc_id, r.n_grams, [round(s, 6) for s in r.scores]) for r in lg.language_scores(docs, profiles).collect()) == want


def test_crawl_state_reads_a_url_once_a_batch():
    """Against one look at the state for every visit."""
    rng, delay = random.Random(9), timedelta(days=2)
    start = datetime(2024, 1, 1)

    class Handle:
        def __init__(self):
            self.store, self.value, self.reads, self.timers = {}, None, 0, set()

        def getMapState(self, *a):
            return self

        getValueState = getMapState

        def getValue(self, key):
            self.reads += 1
            return self.store.get(key)

        def updateValue(self, key, value):
            self.store[key] = value

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def registerTimer(self, when):
            self.timers.add(when)

    handle, state = Handle(), CrawlState(delay)
    state.init(handle)
    known, n, rel, nonrel = {}, 0, 0, 0
    for _ in range(6):
        batch = pd.DataFrame([(rng.choice(["a", "b", "c", None]), start + timedelta(hours=rng.randint(0, 200)), rng.randint(0, 1)) for _ in range(60)], columns=["url", "fetch_time", "label"])
        want = []
        for url, when, label in batch.sort_values(["fetch_time", "label"], ascending=[True, False], kind="stable").itertuples(index=False):
            when, old = when.to_pydatetime(), None
            if url in known and abs(when - known[url][0]) < delay:
                if (when, -label) >= (known[url][0], -known[url][1]):
                    continue
                old = known[url][0]
                rel, nonrel = rel - known[url][1], nonrel - 1 + known[url][1]
            elif url in known and when < known[url][0]:
                continue
            known[url] = (when, label)
            n, rel, nonrel = n + 1, rel + label, nonrel + 1 - label
            want.append((n, url, when, old, rel, nonrel))
        handle.reads = 0
        got = [r for out in state.handleInputRows(("d", 0), iter([batch[:20], batch[20:]]), None) for r in out.itertuples(index=False)]
        plain = lambda t: None if pd.isna(t) else t.to_pydatetime()
        assert [(r.n, r.url, plain(r.first_visit), plain(r.replaces), r.rel, r.nonrel) for r in got] == want
        assert handle.reads == batch["url"].nunique(dropna=False)
    assert handle.store == {(u,): v for u, v in known.items()}
    assert handle.timers >= {state.expiry(when) for when, _ in known.values()}

"""Compression classifier, compression bands, language."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
import zstandard as zs

import __spark_entry__ as entry
from pagemill.llm import bands, langid, quality
from tests.llm import brute
from tests.llm.conftest import prose

FOLDER = "/root/testdata/sf0.01"


def test_bands_equal_brute_force(edge, edge_rows):
    got = [r for r in bands.add_bands(edge).select("doc_id", "bands.*").collect()]
    want = [(d, *brute.rules_row(t).values()) for d, t in edge_rows]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:7]) for r in got)
    assert all(not (r["kept"] and r["base_failed"]) for r in got)


def test_bands_keep_other_columns_and_empty_tables(edge, empty):
    assert bands.add_bands(edge).columns == [*edge.columns, "bands"]
    assert bands.add_bands(edge, out="score").columns == edge.columns
    assert bands.add_bands(empty).count() == 0


def test_bands_verdicts():
    compress = zs.ZstdCompressor(level=3, write_content_size=False, write_checksum=False).compress
    rng = random.Random(1)
    letters = "".join(chr(rng.randrange(33, 127)) + (" " if i % 7 == 0 else "") for i in range(4000))
    assert bands.ratio_verdict(prose(rng, 700).encode(), compress)[3]
    assert not bands.ratio_verdict(("the same words again " * 90).encode(), compress)[3]
    assert not bands.ratio_verdict(letters.encode(), compress)[3]
    assert bands.ratio_verdict(b"", compress) == (0.0, 0, 0, True)


def test_band_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    compress = zs.ZstdCompressor(level=3, write_content_size=False, write_checksum=False).compress
    rows = entry.queries()["op5_compression_bands"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute.rules_row(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want
        assert r["kept"] == (not want["base_failed"] and bands.ratio_verdict(texts[r["doc_id"]].encode(), compress)[3])


def test_quality_held_out(spark):
    scored = entry.queries()["op1_quality"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows)
    assert right >= 0.9 * len(rows)
    assert scored.count() == 1000 and all(0 <= r["score"] <= 1 for r in rows)


def test_quality_edges(spark, edge, empty):
    labelled = spark.createDataFrame([(10, 1), (7, 0), (None, 1), (4, None)], "doc_id long, label int")
    model = quality.fit(edge, labelled)
    scored = quality.score(edge, model)
    assert scored.columns == edge.columns and scored.count() == edge.count()
    assert all(0 <= r["score"] <= 1 for r in scored.collect())
    nothing = quality.fit(empty, labelled.limit(0))
    assert [r["score"] for r in quality.score(edge, nothing).select("score").distinct().collect()] == [0.5]
    assert quality.score(empty, nothing).count() == 0


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab"]
    finder = langid.Pieces(pieces)
    rng = np.random.default_rng(0)
    probs = rng.random((len(pieces) + 1, 2))
    model = langid.UnigramModel(("x", "y"), tuple(pieces), probs, np.zeros(2))
    for word in ("a", "ab", "abba", "acb"):
        marked = "▁" + word
        total = np.zeros(2)
        for bits in itertools.product([0, 1], repeat=len(marked) - 1):
            parts, last = [], 0
            for i, b in enumerate(bits, 1):
                if b:
                    parts.append(marked[last:i])
                    last = i
            parts.append(marked[last:])
            if all(p in pieces or len(p) == 1 for p in parts):
                total += np.prod([probs[pieces.index(p)] if p in pieces else probs[-1] for p in parts], axis=0)
        assert np.allclose(np.exp(model.word_scores(finder, [marked])[0]), total)


def test_learning_raises_likelihood():
    words = Counter({"abab": 5, "aab": 2})
    flat = langid.learn({"x": words}, {"x": 1}, ["▁", "a", "b", "ab", "▁a"])
    finder = langid.Pieces(list(flat.pieces))
    start = langid.UnigramModel(("x",), flat.pieces, np.full_like(flat.probs, 1 / len(flat.probs)), flat.priors)
    score = lambda m: sum(n * m.word_scores(finder, ["▁" + w])[0, 0] for w, n in words.items())
    assert score(flat) > score(start) and math.isclose(flat.probs.sum(), 1)


def test_language_held_out(spark):
    rows = entry.queries()["op7_segmented_unigrams"](spark, FOLDER)
    langs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    held = rows.join(langs, "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)


def test_language_edges(spark, edge, empty):
    labelled = spark.createDataFrame([(10, "aa"), (4, "bb"), (5, None)], "doc_id long, lang string")
    model = langid.fit(edge, labelled)
    rows = langid.predict(edge, model).select("doc_id", "text", "language.lang", "language.score").collect()
    assert len(rows) == edge.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang"] != "und") == letters and 0 <= r["score"] <= 1
    assert {r["lang"] for r in langid.predict(edge, langid.fit(empty, labelled.limit(0))).select("language.lang").collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


@pytest.mark.parametrize("text", ["", "x", "a b " * 3])
def test_repeated_words_short(text):
    words = text.encode().split()
    assert bands.repeated_words(words) == brute.rules_row(text)["n_repeat_words"]


def test_letters_only():
    assert langid.letter_runs("a²b ½ x_y 12 É") == ["a", "b", "x", "y", "É"]


def test_letters_no_language_has_seen_leave_the_evidence(spark):
    rng = random.Random(21)
    word = {"aa": lambda: "".join(rng.choice("abcde") for _ in range(5)), "bb": lambda: "".join(rng.choice("vwxyz") for _ in range(5))}
    glued = lambda: "".join(rng.choice("日本語文字列") for _ in range(120))
    rows = [(i, " ".join(word[l]() for _ in range(2_000)), l) for i, l in enumerate(["aa", "bb"] * 10)]
    rows += [(100 + i, glued(), "zz") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.select("doc_id", "text"), docs.select("doc_id", "lang"))
    assert model.languages == ("aa", "bb", "zz")
    long = " ".join(word["bb"]() for _ in range(300))
    texts = [long + " " + "ж" * 48, long + " " + glued()[:48], glued(), "ж" * 500]
    found = langid.predict(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    assert [r["language"]["lang"] for r in found[:3]] == ["bb", "bb", "zz"]
    assert all(0 < r["language"]["score"] <= 1 for r in found)

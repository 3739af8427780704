"""Learning from texts of any length and from doubtful labels; packing by loss."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import common, langid, packing, quality, toxicity
from tests.llm.conftest import prose


def test_toxicity_learns_from_long_texts_only(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEARN_DOCS", {1: 300, 0: 300})
    monkeypatch.setattr(toxicity, "CURVE_DOCS", {1: 30, 0: 30})
    rng = random.Random(3)

    def text(bad):
        words = prose(rng, 400).split()
        for _ in range(6 if bad else 0):
            words[rng.randrange(400)] = "zorg" + rng.choice(["an", "lo", "mi"])
        return " ".join(words)

    docs = spark.createDataFrame([(i, text(i % 2)) for i in range(540)], "doc_id long, text string")
    labels = docs.where("doc_id < 460").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label"))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs.where("doc_id >= 460"), model).collect()
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in scored) >= 72  # of 80 held out


def test_long_texts_give_a_window(spark):
    rows = [(1, "a" * 100), (2, "é" * 51), (3, "x" * 5_000), (4, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", common.learning_text("text", "doc_id", 100).alias("t"))
    got = {r.doc_id: r.t for r in df.collect()}
    assert got == {1: "a" * 100, 2: "é" * 25, 3: "x" * 25, 4: "", 5: None}


def test_languages_of_long_texts_only_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "LEARN_BYTES", 400)
    rows = [(i, "der hund und die katze " * 50 if i % 2 else "the cat and the dog " * 50, "de" if i % 2 else "en") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.select("doc_id", "text"), docs.select("doc_id", "lang"))
    got = langid.predict(docs, model, out="p").select("lang", "p.lang").collect()
    assert model.languages == ("de", "en") and all(r[0] == r[1] for r in got)


def test_quality_learns_from_long_texts_only(spark, monkeypatch):
    monkeypatch.setattr(quality, "LEARN_BYTES", 800)
    rng = random.Random(5)
    noise = lambda: "".join(rng.choice("qxzjkvw#%") for _ in range(3_000))
    docs = spark.createDataFrame([(i, prose(rng, 500) if i % 2 else noise()) for i in range(120)], "doc_id long, text string")
    model = quality.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label")))
    scored = quality.score(docs, model).collect()
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in scored) >= 114


def test_doubtful_labels_do_not_depend_on_row_order(spark):
    rows = [(1, 1), (1, 0), (2, 1), (None, 1), (3, None), (2, 1)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, label int").repartition(3)
        assert sorted(map(tuple, common.one_label(df).collect())) == [(1, 0), (2, 1)]


@pytest.mark.parametrize("limits", [(256, 8, 40), (64, 4, 20), (256, 64, 256)])
def test_instruction_data_keeps_the_limit_on_loss(spark, limits):
    rng = random.Random(7)
    rows = [(i, [(prose(rng, rng.randint(1, 60)), k % 2 == 1) for k in range(rng.randint(0, 5))]) for i in range(60)]
    rows += [(100, None), (101, [None, (None, True), ("end", None)]), (102, [(prose(rng, 900), True)])]
    df = spark.createDataFrame(rows, "doc_id long, turns array<struct<text:string,loss:boolean>>").coalesce(2)
    pieces = packing.pack(df, turns="turns", limits=limits).collect()
    tokenizer = packing.shared_tokenizer(None)
    used = {}
    for doc_id, turns in rows:
        ids, mask = [], []
        for turn in turns or []:
            text, loss = turn or ("", False)
            found = tokenizer.encode([text or ""])[0].tolist() if turn else []
            ids, mask = ids + found, mask + [bool(loss)] * len(found)
        last = [t for t in turns or [] if t is not None]
        ids, mask = ids + [packing.END_ID], mask + [bool(last and last[-1][1])]
        mine = sorted((p for p in pieces if p.doc_id == doc_id), key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in mine) == np.array(ids, "<u4").tobytes()
        assert all(p.loss_tokens == sum(mask[p.start : p.start + p.length]) and p.doc_tokens == len(ids) for p in mine)
        for p in mine:
            held = used.setdefault(p.sequence_id, [0, 0, 0])
            held[0] += p.length
            held[1] += 1
            held[2] += p.loss_tokens
    assert all(u <= m for held in used.values() for u, m in zip(held, limits))
    loss = sum(h[2] for h in used.values())
    if limits[2] < limits[0]:  # the third limit says something of its own
        assert len(used) >= loss / limits[2] > sum(h[0] for h in used.values()) / limits[0]

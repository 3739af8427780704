"""Tags in context: equal to trying all sequences, on both routes."""

import itertools
import random

import numpy as np
import pytest

from pagemill.operators import tagging as tg


def test_best_path_equals_brute_force():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 6):
        for _ in range(20):
            start, step, costs = rng.integers(0, 4, 3), rng.integers(0, 4, (3, 3)), rng.integers(0, 4, (n, 3))
            price = lambda p: start[p[0]] + sum(step[a, b] for a, b in zip(p, p[1:])) + sum(costs[i, t] for i, t in enumerate(p))
            want = min(itertools.product(range(3), repeat=n), key=lambda p: (price(p), p[::-1]))
            assert tg.best_path(costs, start, step) == list(want)
    assert tg.best_path(np.zeros((0, 3)), np.zeros(3), np.zeros((3, 3))) == []


@pytest.fixture(scope="module")
def tagged(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(60):
        # "saw" is a verb behind a noun and a noun behind an article.
        rows.append((["the", "saw"], ["DT", "NN"]) if rng.random() < 0.5 else (["dogs", "saw", "the", "cat"], ["NN", "VB", "DT", "NN"]))
    return spark.createDataFrame(rows + [([], []), (None, None)], "tokens array<string>, tags array<string>")


@pytest.mark.parametrize("limit", [1000, -1])
def test_context_decides(spark, tagged, limit):
    model = tg.learn_tagger(tagged)
    assert model.tags == ["DT", "NN", "VB"]
    rows = [(1, ["the", "saw"]), (2, ["cat", "saw", "the", "saw"]), (3, ["the", "unknown", "saw"]), (4, []), (5, None), (6, ["the", "saw"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    got = {r.id: r.tags for r in tg.tag_in_context(df, model, limit=limit).collect()}
    assert got == {1: ["DT", "NN"], 2: ["NN", "VB", "DT", "NN"], 3: ["DT", "NN", "VB"], 4: [], 5: None, 6: ["DT", "NN"]}


def test_without_a_tagged_table(spark, tagged):
    model = tg.learn_tagger(tagged.limit(0))
    assert tg.tag_in_context(tagged.select("tokens").limit(1), model).first().tags == [None] * len(tagged.first().tokens)

"""Abbreviations learned from texts keep sentences whole."""

import pytest
from pyspark.sql import functions as F

from pagemill.operators import sentences as sn


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"Yesterday Dr. Smith spoke of U.S. law at length.Then everyone went home again! Was it number {i} of many?\nOne more line of text here. Too short.\nHe was here for a short while and here it was short.") for i in range(40)]
    return spark.createDataFrame(rows + [(90, None), (91, ""), (92, "Home. Again. Length. Many.")], "doc_id long, text string")


@pytest.mark.parametrize("limit", [100, -1])
def test_abbreviations_do_not_end_sentences(docs, limit):
    found = sn.abbreviations(docs)
    assert {r.word for r in found.collect()} == {"dr", "u.s"}
    rows = {r.doc_id: r.sentences for r in sn.learned_sentences(docs, found, limit=limit).collect()}
    assert rows[7] == [
        "Yesterday Dr. Smith spoke of U.S. law at length.", "Then everyone went home again!", "Was it number 7 of many?", "One more line of text here.", "He was here for a short while and here it was short."
    ]
    assert rows[90] is None and rows[91] == [] and rows[92] == []


def test_nothing_to_learn(docs):
    assert sn.abbreviations(docs.limit(0)).count() == 0
    got = sn.learned_sentences(docs.where("doc_id = 7"), sn.abbreviations(docs.limit(0))).first().sentences
    assert got[0] == "Smith spoke of U.S." and len(got) == 5

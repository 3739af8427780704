"""Registered queries against their SQL. A quick selection by default; the whole
registry with CHECK_ALL_QUERIES=1 (or `python -m tests.oracle_check`)."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "htm1_visible_text", "htm6_links", "htm14_publish_date", "url5_canonical_link", "str4_mask_phrases", "str7_stems", "agg6_centroid",
    "agg1_tweets_by_url_hot", "win1_harvest_curve", "nlp2_entity_lists", "jn8_source_ratio_join", "job1_page_summary", "job7_first_round",
    "stm4_restart_append", "src4_warc_records",
]
NAMES = list(entry.oracle_sql()) if os.environ.get("CHECK_ALL_QUERIES") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 50

"""Secret scans: plans, positions and verdicts against plain versions."""

import hashlib
import random

import pytest
import regex
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pagemill.llm import pii, secret_scan

FOLDER = "/root/testdata/sf0.001"


def scans(df, name="regexp_extract_all"):
    """How often the optimised plan scans a text."""
    return df._jdf.queryExecution().optimizedPlan().toString().count(name)


def found_by_hand(text):
    if not regex.search(secret_scan.NEEDS, text):
        return []
    pattern = secret_scan.TOKEN.replace(r"\x20", " ").replace(r"\x27", "'")
    return [(m.start(), m.end(), m[0]) for m in regex.finditer(pattern, text)]


def test_findings_equal_brute_force(spark, edge, edge_rows):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.start, r.end, r.hit) for r in secret_scan.findings(edge).collect())
    want = sorted((d is None, d or 0, *m) for d, t in edge_rows for m in found_by_hand(t or ""))
    assert got == want


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = entry.queries()["op3_secret_forest"](spark, FOLDER).collect()
    want = sorted((d, s, e, hashlib.sha256(h.encode()).hexdigest()) for d, t in docs.items() for s, e, h in found_by_hand(t or ""))
    assert sorted((r.doc_id, r.start, r.end, r.hit_sha256) for r in rows) == want
    # Most long tokens are words: they are removed although one label may be missing.
    assert sum(r.secret for r in rows) < 0.05 * len(rows) and all(r.secret == (r.score >= 0.5) for r in rows)


def test_texts_are_scanned_once(spark):
    docs = spark.createDataFrame([(1, "key = 'abcdefgh1' " * 3)], "doc_id long, text string")
    found = pii.position(docs, "found", "text", secret_scan.TOKEN, secret_scan.NEEDS).select(F.explode_outer("found").alias("m")).where("m IS NOT NULL")
    assert scans(found) == 1 and scans(found, "split(") == 1


@pytest.mark.parametrize("n", [1, 63, 64, 65, 128, 129, 4_000])
def test_positions_of_many_matches(spark, n):
    text = "".join(f"é{i} w{i * 7} " for i in range(n))
    df = spark.createDataFrame([(text,), (None,), ("",)], "text string")
    rows = pii.position(df, "m", "text", "[0-9]++", "[0-9]").collect()
    want = [(m.start(), m.end(), m[0], text[max(p, m.start() - 80) : m.start()]) for m, p in zip(
        list(regex.finditer("[0-9]+", text)), [0] + [m.end() for m in regex.finditer("[0-9]+", text)], strict=False)]
    assert [(m.start, m.end, m.hit, m.before) for m in rows[0].m] == want and not rows[1].m and not rows[2].m


def planted(n=120):
    rng = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    word = lambda: "".join(rng.choice(["an", "ter", "lo", "mi", "es", "tion"]) for _ in range(5))
    shared = [word() for _ in range(30)]
    rows, secret = [], set()
    for i in range(n):
        value = "".join(rng.choice(letters) for _ in range(rng.randint(14, 30)))
        plain = " ".join(rng.choice(shared) for _ in range(12))
        if i % 3 == 0:
            secret.add(value)
            rows.append((i, f'{plain} api_key = "{value}" {plain}'))
        elif i % 3 == 1:
            rows.append((i, f"{plain} checksum {hashlib.md5(value.encode()).hexdigest()} {plain}"))
        else:
            rows.append((i, f"{plain} commit {hashlib.sha1(value.encode()).hexdigest()} {plain}"))
    return rows, secret


@pytest.mark.parametrize("keep", [0, 1, 2])
def test_forest_tells_planted_secrets(spark, keep):
    """With both labels in the corpus, and with none of one label (keep 1, 2)."""
    rows, secret = planted()
    rows = [r for r in rows if keep != 1 or r[0] % 3] if keep else rows
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = secret_scan.dictionary(docs)
    found = secret_scan.add_features(secret_scan.findings(docs), words)
    labelled = secret_scan.known_labels(found)
    if keep == 2:
        labelled = labelled.where("label = 1")
    model = secret_scan.train_with_examples(labelled, words)
    flagged = {r.hit for r in secret_scan.judge(found, model).where("secret").collect()}
    assert flagged == (set() if keep == 1 else secret)


def test_rules_decide_without_a_forest(spark, empty):
    rows, secret = planted(30)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secret_scan.add_features(secret_scan.findings(docs), secret_scan.dictionary(empty))
    assert {r.hit for r in secret_scan.judge(found, None).where("secret").collect()} == secret
    nothing = secret_scan.add_features(secret_scan.findings(empty), secret_scan.dictionary(empty))
    assert secret_scan.judge(nothing, secret_scan.train(secret_scan.known_labels(nothing))).count() == 0

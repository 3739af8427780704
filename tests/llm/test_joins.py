"""Decontamination, personal data, near copies, repeated passages."""

import random

import pytest

import __spark_entry__ as entry
from pagemill.llm import chunks, decontam, neardup, pii
from tests.llm import brute
from tests.llm.conftest import prose
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op8_prefix_decontamination", "op10_bottom_k"])
def test_query_equals_sql(spark, name):
    assert compare(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) is None


# ---- decontamination ---------------------------------------------------------------
def items_and_docs():
    rng = random.Random(5)
    items = [(1, prose(rng, 40)), (2, prose(rng, 13)), (3, "two words"), (4, "lone"), (5, ""), (6, None), (7, prose(rng, 30)), (7, None)]
    items += [(None, items[0][1]), (8, items[1][1]), (9, "the " * 20)]
    docs = [(i, prose(rng, rng.randint(5, 60))) for i in range(12)]
    cut = items[0][1].split()
    docs += [
        (20, prose(rng, 30) + " " + " ".join(cut[5:30]) + " " + prose(rng, 10)), (21, " ".join(cut[:12])), (22, items[1][1].upper() + "!"),
        (23, "a lone wolf and Two, words"), (24, "the " * 50), (25, " ".join(cut[3:17]) + " x " + items[6][1]), (26, None), (27, ""),
        (20, " ".join(cut)), (28, " ".join(cut[5:25] + ["odd"] + cut[25:40])), (28, " ".join(cut[5:25] + ["odd"] + cut[25:40])), (None, "lone"),
    ]
    return items, docs


def contamination_rows(found):
    return sorted(
        repr((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"])) for r in found.collect()
    )


def test_contamination_equals_brute_force(spark):
    items, docs = items_and_docs()
    want = sorted(repr((d, *brute.contamination(t, items).values())) for d, t in docs)
    table = spark.createDataFrame([(d, t, "k", 1) for d, t in docs], "doc_id long, text string, key string, pos int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert contamination_rows(decontam.find_contamination(table, bench)) == want
    kept = decontam.drop_contaminated(table, bench)
    bad = sorted(repr(d) for d, t in docs if not brute.contamination(t, items)["contaminated"])
    assert kept.columns == table.columns and sorted(repr(r["doc_id"]) for r in kept.collect()) == bad


def test_contamination_without_broadcasts(spark, monkeypatch):
    items, docs = items_and_docs()
    want = sorted(repr((d, *brute.contamination(t, items).values())) for d, t in docs)
    monkeypatch.setattr("pagemill.llm.common.BROADCAST_BYTES", -1)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert contamination_rows(decontam.find_contamination(table, spark.createDataFrame(items, "item_id long, text string"))) == want


def test_contamination_edges(spark, edge, empty, edge_rows):
    bench = spark.createDataFrame([(1, "one"), (2, "two")], "item_id long, text string")
    want = sorted(repr((d, *brute.contamination(t, [(1, "one"), (2, "two")]).values())) for d, t in edge_rows)
    assert contamination_rows(decontam.find_contamination(edge, bench)) == want
    assert decontam.find_contamination(empty, bench).count() == 0
    assert decontam.find_contamination(edge, bench.limit(0)).where("contaminated OR n_hit > 0").count() == 0


# ---- personal data -----------------------------------------------------------------
def test_base_spans_equal_brute_force(edge, edge_rows):
    rows = pii.find_personal_data(edge).collect()
    want = sorted(repr((d, brute.base_spans(t))) for d, t in edge_rows)
    assert sorted(repr((r["doc_id"], [tuple(m) for m in r["base"]])) for r in rows) == want


def test_pii_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in entry.queries()["op9_bootstrapped_pii"](spark, FOLDER).collect():
        want = brute.pii_row(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want


def test_patterns_discover_unknown_forms(spark):
    rows = [(i, f"Please call me at +1 (375) 555-{4000 + i} before noon.") for i in range(12)]
    rows += [(50, "Please call me at 0171-55-{}x before noon.".format(7)), (51, "The year 1999-2001x was long.")]
    rows += [(60 + i, f"Report number A{i}77-{i} was filed.") for i in range(12)]
    found = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)[50]
    assert [(m["kind"], text[m["start"]:m["end"]]) for m in found[50]["spans"]] == [("phone", "0171-55-7x")]
    assert not found[50]["base"] and not found[51]["spans"] and not found[60]["spans"]


def test_patterns_discover_grouped_and_plain_identifiers(spark):
    rng = random.Random(8)
    rows = [(i, f"Please call me at +1 (375) 555-{4000 + i} before noon.") for i in range(48)]
    rows += [(100 + i, f"You may write to {prose(rng, 1)}.{c}@mail.org when ready.") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    new = {
        50: ("Please call me at 020 7946 0958. It is new.", "phone", "020 7946 0958"), 51: ("Please call me at (555) 123-4567 before noon.", "phone", "(555) 123-4567"),
        52: ("Please call me at 555.123.4567 x", "phone", "555.123.4567"), 53: ("Please call me at (555)123-4567, ok", "phone", "(555)123-4567"),
        54: ("Please call me at 7946 today", "phone", "7946"), 55: ("You may write to jane_doe when ready.".replace("_", "."), "email", "jane.doe"),
        56: ("You may write to jane at example.org when ready.", "email", "jane at example.org"),
    }
    rows += [(d, t) for d, (t, _, _) in new.items()] + [(60, "In all 020 7946 0958 of 12 34 were seen by jane at noon.")]
    rows += [(70 + i, f"Report number 12 {i}77 {i} was filed by {prose(rng, 1)}.") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find_personal_data(docs).collect()}
    for d, (text, kind, hit) in new.items():
        assert [(m["kind"], text[m["start"]:m["end"]]) for m in found[d]["spans"]] == [(kind, hit)] and not found[d]["base"], d
    assert not any(found[d]["spans"] for d in [60, *range(70, 82)])
    masked = {r["doc_id"]: r["text"] for r in pii.mask_personal_data(docs).collect()}
    assert masked[51] == "Please call me at <PHONE> before noon." and masked[56] == "You may write to <EMAIL> when ready."


def test_masking(edge, empty):
    masked = pii.mask_personal_data(edge)
    assert masked.columns == edge.columns and masked.count() == edge.count()
    rows = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert rows[11] == "é ü ñ ß İ \U0001f600 mail <EMAIL>, <PHONE>." and rows[1] is None and rows[2] == ""
    assert not any(brute.base_spans(t) for t in rows.values() if t and "<" not in t)
    assert pii.mask_personal_data(empty).count() == 0


# ---- near copies -------------------------------------------------------------------
def group_rows(df):
    return sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])) for r in df.collect())


def copies(rng, n_groups, size, words):
    rows, next_id = [], 0
    for _ in range(n_groups):
        base = prose(rng, words).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6])):
                w[rng.randrange(len(w))] = "edit" + str(rng.randrange(10**6))
            rows.append((next_id, " ".join(w)))
            next_id += rng.randint(1, 3)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("long_list", [64, 4])
def test_groups_equal_brute_force(spark, monkeypatch, long_list):
    """Small groups; and large ones, by calling lists of more than 4 long."""
    monkeypatch.setattr(neardup, "LONG_LIST", long_list)
    rng = random.Random(9)
    line = prose(rng, 12)
    rows = copies(rng, 4, 22, 90) + [(1000 + i, line + "\n" + prose(rng, 60)) for i in range(30)] + [(2000 + i, line) for i in range(9)]
    rows += [(3000 + i, prose(rng, 4)) for i in range(10)] + [(5, prose(rng, 50)), (None, rows[0][1]), rows[0], rows[0], (7, None), (8, "")]
    got = group_rows(neardup.find_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert got == sorted(map(repr, brute.groups(rows)))


def test_group_edges(edge, empty, edge_rows):
    assert group_rows(neardup.find_groups(edge)) == sorted(map(repr, brute.groups(edge_rows)))
    assert neardup.find_groups(empty).count() == 0
    kept = neardup.drop_copies(edge)
    want = [(d, k) for (d, n, _, k) in brute.groups(edge_rows)]
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.collect()]
    full = {d for d, k in want if k}
    assert set(ids) == full and len([i for i in ids if i == 4]) == 1
    assert neardup.drop_copies(empty).count() == 0


def test_null_and_repeated_ids_are_not_copies(spark):
    """Unlike texts stay, whatever their ids; of copies one stays, a numbered one first."""
    rng = random.Random(12)
    alone = [(None, prose(rng, 40)) for _ in range(6)] + [(7, prose(rng, 40)) for _ in range(3)] + [(7, "One"), (None, "two words")]
    pair, twin = prose(rng, 60), prose(rng, 60)
    rows = alone + [(None, pair), (None, pair + " end"), (None, pair), (7, twin), (None, twin), (9, twin + " end"), (None, None), (7, "")]
    kept = [tuple(r) for r in neardup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    of_pair = [r for r in kept if r[1] and r[1].startswith(pair)]
    assert len(of_pair) == 1 and of_pair[0][0] is None
    assert sorted(map(repr, set(kept) - set(of_pair))) == sorted(map(repr, alone + [(7, twin), (None, None), (7, "")]))
    assert len(kept) == len(alone) + 4


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    roots = {r["node"]: r["root"] for r in neardup.components(edges, "t").collect()}
    assert roots == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# ---- repeated passages ----------------------------------------------------------------
def test_chunks_cover_and_resist_insertions():
    rng = random.Random(2)
    text = prose(rng, 900)
    for t in ["", "x", "é" * 50, text, "a" * 9_000, "Annt " * 500]:
        digests, places, new = chunks.chunk_text(t)
        at = 0
        for p in places.tolist():
            assert p >> 27 == at
            at += (p >> 13) & 16383
        assert at == len(t) and sum(p & 8191 for p in places.tolist()) == len(t.split())
        assert len(set(digests.tolist())) == int(new.sum())
    one = set(chunks.chunk_text(text)[0].tolist())
    two = set(chunks.chunk_text(text[:2000] + "inserted" + text[2000:])[0].tolist())
    assert len(one - two) <= 4


def test_planted_passages_are_found(spark):
    rng = random.Random(4)
    passages = [prose(rng, 55) for _ in range(10)]
    rows, owners = [], {}
    for i in range(60):
        parts = [prose(rng, 80)]
        if i % 2:
            owners[i] = rng.randrange(10)
            parts.append(passages[owners[i]])
        rows.append((i, " ".join([*parts, prose(rng, 80)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = chunks.find_repeats(docs).collect()
    several = {i for i, p in owners.items() if sum(q == p for q in owners.values()) > 1}
    assert {r["doc_id"] for r in found} == several
    texts = dict(rows)
    left = {r["doc_id"]: r["text"] for r in chunks.drop_repeats(docs).collect()}
    for r in found:
        own, text = r["doc_id"], texts[r["doc_id"]]
        passage = passages[owners[own]]
        at = text.index(passage)
        # Cuts beside the passage may meet by chance: a few characters at most.
        assert at - 40 <= r["start"] <= at + 120 and at + len(passage) - 120 <= r["end"] <= at + len(passage) + 40 and r["n_words"] >= 20
        first = min(i for i in owners if owners[i] == owners[own])
        assert first in r["first_doc_ids"]
        if own == first:
            assert len(text) - len(left[own]) <= 60
        else:
            gone = len(text) - len(left[own])
            assert len(passage) - 240 <= gone <= len(passage) + 80
            assert left[own].startswith(text[: at - 40]) and left[own].endswith(text[at + len(passage) + 40 :])
    assert all(left[i] == texts[i] for i in texts if i not in several)


def test_repeat_edges(edge, empty):
    rows = chunks.find_repeats(edge).collect()
    assert {r["doc_id"] for r in rows} >= {None, 4, 6} and not {1, 2, 3, 10} & {r["doc_id"] for r in rows}
    kept = chunks.drop_repeats(edge)
    assert kept.columns == edge.columns and kept.count() == edge.count()
    assert chunks.find_repeats(empty).count() == 0 and chunks.drop_repeats(empty).count() == 0

"""Packing, toxicity, secrets, the pipeline."""

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from pagemill.llm import packing, quality, queries, secret_scan, toxicity
from tests.llm import brute
from tests.llm.conftest import prose

FOLDER = "/root/testdata/sf0.001"


# ---- packing --------------------------------------------------------------------------
@pytest.fixture(scope="module")
def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check_pieces(pieces, texts, tokenizer, limit=4096):
    """Every id of every document once, gapless sequences, little padding."""
    want = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for d, t in texts.items()}
    found, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        found[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(found) == set(want)
    for d, parts in found.items():
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            ids = want[d][at : at + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(want[d])
            assert p["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
            at += p["length"]
        assert at == len(want[d])
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
        padding += 0 if at & (at - 1) == 0 else limit - at
    assert padding <= 0.02 * sum(map(len, want.values()))


def test_packing_query_round_trip(spark, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    check_pieces(entry.queries()["op6_vector_packing"](spark, FOLDER).collect(), texts, tokenizer)


def test_packing_edges(edge, empty, edge_rows, tokenizer):
    rows = queries.packed_digest(packing.pack(edge)).collect()
    whole = {d: t for d, t in edge_rows if d not in (None, 4)}
    for d, t in whole.items():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        parts = sorted((r for r in rows if r["doc_id"] == d), key=lambda r: r["start"])
        assert [r["start"] for r in parts] == [sum(q["length"] for q in parts[:i]) for i in range(len(parts))]
        assert sum(r["length"] for r in parts) == len(ids)
    assert sum(r["length"] for r in rows if r["doc_id"] == 4) == 2 * len([*tokenizer.encode(edge_rows[5][1], add_special_tokens=False).ids, 2])
    assert packing.pack(empty).count() == 0


def test_odd_text_has_the_tokenizers_ids(tokenizer):
    texts = ["İstanbul ΑΣ ς áb \x1cfoo don't I'll 12³ x²½ 'S ªºµ ß SS ÀÉ a\xa0b <|endoftext|>x", "", "\U0001f600́ é", "THE'RE $$%% 9a9"]
    got = packing.WordTokenizer().encode(texts)
    assert [g.tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("limits", [(64, 4, 64), (64, 100, 20), (50, 3, 30)])
def test_all_limits_hold(limits):
    rng = random.Random(1)
    packer = packing.Packer(limits, open_limit=4)
    loss = {}
    for i in range(200):
        n = rng.randint(1, 150)
        loss[i] = np.array([rng.random() < 0.4 for _ in range(n)])
        packer.add(i, n, loss[i])
    packer.finish()
    used, cover = defaultdict(lambda: [0, 0, 0]), defaultdict(list)
    for doc, start, size, _, seq, offset in packer.take():
        assert offset == used[seq][0]
        used[seq][0] += size
        used[seq][1] += 1
        used[seq][2] += int(loss[doc][start : start + size].sum())
        cover[doc].append((start, size))
    for doc, parts in cover.items():
        assert sum(n for _, n in parts) == len(loss[doc]) and len({s for s, _ in parts}) == len(parts)
    for tokens, segments, borne in used.values():
        assert tokens <= limits[0] and segments <= limits[1] and borne <= limits[2]


# ---- toxicity ---------------------------------------------------------------------------
def test_gradients():
    rng = np.random.default_rng(0)
    model = toxicity.ToxicityModel(toxicity.start_weights(2, rng), {"ab": 1, "c": 2})
    model.weights = {k: v.astype(float) for k, v in model.weights.items()}
    rows, labels = [["ab", "xyz", "c"], ["c"], ["q", "ab", "zz", "c"]], np.array([1.0, 0.0, 1.0])
    grads, _ = toxicity.window_step(model, rows, labels)
    for name, w in model.weights.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), w.shape)
        old, losses = w[at], []
        for step in (1e-3, -1e-3):
            w[at] = old + step
            losses.append(toxicity.window_step(model, rows, labels)[1])
        w[at] = old
        assert abs((losses[0] - losses[1]) / 2e-3 - grads[name][at]) < 1e-4, name


def test_windows_cover_everything():
    for n in (0, 1, toxicity.WINDOW, toxicity.WINDOW + 1, 500):
        spans = toxicity.windows(n)
        assert set(range(n)) == {i for s, e in spans for i in range(s, e)}
        assert all(a[1] > b[0] for a, b in zip(spans, spans[1:]))
    assert "".join(toxicity.cut("A" * 100 + " b")) == "a" * 100 + "b"


def test_learns_a_prefix_of_words(monkeypatch):
    """Toxic words share their beginning; words never seen are found by letters."""
    monkeypatch.setattr(toxicity, "EPOCHS", 8)
    rng = random.Random(2)

    def text(bad):
        words = prose(rng, 30).split()
        if bad:
            words[rng.randrange(30)] = "zorg" + rng.choice(["an", "lo", "mi", "es"])
        return " ".join(words)

    labels = [i % 2 for i in range(500)]
    model = toxicity.train([text(y) for y in labels], labels)
    fresh = [prose(rng, 20) + " zorgtion " + prose(rng, 90) for _ in range(40)] + [prose(rng, 110) for _ in range(40)]
    table = np.zeros((0, 2, 3 * toxicity.HIDDEN_WORD), np.float32)
    found, _ = toxicity.score_texts(model, fresh, {}, table)
    assert (found[:40] > 0).mean() >= 0.9 and (found[40:] < 0).mean() >= 0.9


def test_toxicity_edges(spark, edge, empty):
    nothing = toxicity.fit(empty, spark.createDataFrame([], "doc_id long, label int"))
    scored = toxicity.score(edge, nothing)
    assert scored.columns == edge.columns and {r["score"] for r in scored.collect()} == {0.5}
    model = toxicity.ToxicityModel(toxicity.start_weights(0, np.random.default_rng(1)), {}, (0.0, 1.0))
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(edge, model).collect()) and toxicity.score(empty, model).count() == 0


# ---- secrets ----------------------------------------------------------------------------
def test_secrets(spark, edge, empty):
    rng = random.Random(6)
    code = lambda n, chars: "".join(rng.choice(chars) for _ in range(n))
    rows = [(i, f'the token = "{code(40, "0123456789abcdef")}" is set here') for i in range(40)]
    rows += [(100 + i, f"key AKIA{code(16, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')} in use") for i in range(40)]
    rows += [(200 + i, f"a {code(26, 'aeiourstln')} long word and {code(24, 'aeioumnt')} too") for i in range(60)]
    rows += [(300, f"password: {code(40, '0123456789abcdef')} there"), (301, "see the/path/to/some/long/folder/name here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secret_scan.add_features(secret_scan.findings(docs), secret_scan.dictionary(docs))
    judged = secret_scan.judge(found, secret_scan.train(secret_scan.known_labels(found))).collect()
    verdict = {(r["doc_id"], r["hit"]): r["secret"] for r in judged}
    texts = dict(rows)
    assert all(texts[r["doc_id"]][r["start"]:r["end"]] == r["hit"] for r in judged)
    assert all(v == (d < 200 or d == 300) for (d, _), v in verdict.items() if d != 301)
    for docs in (edge, empty):
        found = secret_scan.add_features(secret_scan.findings(docs), secret_scan.dictionary(docs))
        rows = secret_scan.judge(found, secret_scan.train(secret_scan.known_labels(found))).collect()
        # Without a forest the rule decides; nothing is a secret just because of that.
        assert all(r["score"] in (0, secret_scan.PRIOR, 1) and r["secret"] == (r["score"] == 1) for r in rows)


def test_short_and_odd_secrets_and_digests(spark):
    rng = random.Random(16)
    code = lambda n, chars: "".join(rng.choice(chars) for _ in range(n))
    hexes, odd = "0123456789abcdef", "ABCDEFGHJKabcdefghjk23456789.!@$%"
    rows = [(i, f'the password = "{code(rng.randint(8, 24), odd)}" is set here') for i in range(60)]
    rows += [(100 + i, f"the commit {code(40, hexes)} and sha256 {code(64, hexes)} of it") for i in range(60)]
    rows += [(200 + i, f"a {code(9, 'aeiourstln')} word and {code(12, 'aeioumnt')} too") for i in range(60)]
    new = {
        300: ('password = "Tr0ub4dor3x"', "Tr0ub4dor3x"), 301: ("db_password=p@ss.w:rd!9$k, then", "p@ss.w:rd!9$k"), 302: ("pwd: x9!", "x9"),
        303: ('{"api_key": "abc.def.ghi.jkl1"}', "abc.def.ghi.jkl1"), 304: ("see aa1.bb2.cc3.dd4.", "aa1.bb2.cc3.dd4"), 305: ("PASSWORD='q7'", "q7"),
    }
    rows += [(d, t) for d, (t, _) in new.items()] + [(400, "the digest 5d41402abc4b2a76b9719d911017c592 of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secret_scan.add_features(secret_scan.findings(docs), secret_scan.dictionary(docs))
    judged = secret_scan.judge(found, secret_scan.train(secret_scan.known_labels(found))).collect()
    texts, verdict = dict(rows), {(r["doc_id"], r["hit"]): r["secret"] for r in judged}
    assert all(texts[r["doc_id"]][r["start"]:r["end"]] == r["hit"] for r in judged)
    assert all((d, hit) in verdict for d, (_, hit) in new.items()), verdict
    assert verdict[300, "Tr0ub4dor3x"] and not verdict[400, "5d41402abc4b2a76b9719d911017c592"]
    assert all(v for (d, hit), v in verdict.items() if d < 60 and hit != "password") and not any(v for (d, _), v in verdict.items() if 100 <= d < 260)


# ---- pipeline -----------------------------------------------------------------------------
def test_pipeline_equals_brute_force(spark, tokenizer):
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    model = queries.learn_quality(spark, FOLDER, source)
    size, w = model.sizer(), np.array(model.weights)
    score = lambda t: 1 / (1 + np.exp(-(quality.inputs(*(np.array([x]) for x in size(t))) @ w)[0]))
    left = [(r["doc_id"], r["text"]) for r in source.collect() if score(r["text"]) >= 0.3]
    left = [(d, t) for (d, t), g in zip(left, brute.groups(left, 5, 80)) if g[3]]
    left = {d: t for d, t in left if not brute.contamination(t, items)["contaminated"]}

    def masked(t):
        out, at = "", 0
        for start, _, end, kind in brute.base_spans(t):
            if start >= at:
                out += t[at:start] + f"<{kind.upper()}>"
            at = max(at, end)
        return out + t[at:]

    rows = queries.packed_digest(corpus_pipeline.run(spark, FOLDER)).collect()
    check_pieces(rows, {d: masked(t) for d, t in left.items()}, tokenizer)


def test_stages_keep_columns_and_survive_edges(spark, edge, empty):
    for docs in (edge.withColumn("source", F.lit("s")), empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, FOLDER)
            assert kept.columns == docs.columns
            kept.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count()

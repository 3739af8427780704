"""Exact deduplication, fill-in-the-middle, whitening: against brute force."""

import hashlib
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pagemill.llm import fim, grace, whitening
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_grace_dedup", "op12_fim_scatter"])
def test_query_equals_sql(spark, name):
    assert compare(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) is None


# Exact deduplication


def copies(rows):
    """[(doc_id, keep_id, group_size, kept count)] by comparing whole texts."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return sorted(((m[3], min(g)[3], len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for m in g), key=repr)


def found(df):
    rows = df.collect()
    kept = {}
    for r in rows:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}  # exactly one row of each group stays
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr)


def test_copies_equal_brute_force(edge, edge_rows):
    assert found(grace.find_copies(edge)) == copies(edge_rows)


def test_copies_of_nothing(empty):
    assert grace.find_copies(empty).count() == 0
    assert grace.drop_copies(empty).columns == empty.columns


@pytest.mark.parametrize("room, merge", [(600, 256), (40, 2), (1 << 20, 3)])
def test_small_tables_spill_and_recurse(spark, room, merge):
    # A third of the rows is one text; others come in one to five copies.
    rows = [(i, f"text {i % 37} " * (1 + i % 5)) for i in range(300)] + [(1000 + i, "hot  text" + " " * (i % 3)) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(grace.find_copies(df, room=room, merge=merge)) == copies(rows)


def test_refused_contents_are_dealt_again(spark):
    records = spark.createDataFrame([(i, 1, bytes([97 + i % 9]) * 10) for i in range(90)], "id long, hash long, content binary")
    out = grace.fill_tables(records.withColumn("fold", F.lit(False)).coalesce(1), room=35).collect()
    assert sum(r.to is not None for r in out) == 30 and sum(r.content is not None for r in out) == 60
    # One hash for all: only complete contents tell them apart.
    known = grace.classes(records, room=35, merge=20).collect()
    assert len(known) == 90 and len({r.cls for r in known}) == 9
    assert all(len({r.cls for r in known if r.id % 9 == k}) == 1 for k in range(9))


def test_own_copies_fold_in_windows(spark):
    rows = spark.range(100).select(F.xxhash64(F.col("id") % 10).alias("hash"), (F.col("id") % 10).cast("string").cast("binary").alias("content"))
    one = grace.fold_own(rows.coalesce(1)).collect()
    assert sum(r.content is not None for r in one) == 10 and len({r.local for r in one}) == 10


def test_dropping_copies_keeps_columns(edge, edge_rows):
    kept = grace.drop_copies(edge)
    assert kept.columns == edge.columns
    assert kept.count() == len({re.sub(r"\s", "", t or "") for _, t in edge_rows})


# Fill-in-the-middle


def middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return text, "plain", len(units), None, None
    if h[3] % 100 < 80:
        return f"<S>{s}<P>{p}<M>{m}", "spm", len(units), len(p), len(m)
    return f"<P>{p}<S>{s}<M>{m}", "psm", len(units), len(p), len(m)


def test_middles_equal_brute_force(spark, edge, edge_rows, monkeypatch):
    more = [(1000 + i, t) for i in range(60) for t in ("a <P> b", "x <S", "é ü\n\nñ \U0001f600 <M", "<M", "one two three ", "  ")]
    df = edge.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).withColumn("fim", F.lit(1))
    rows = fim.add_middle(df).select("doc_id", "text", "fim.*", fim.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    assert len(rows) == len(edge_rows) + len(more) and {r.form for r in rows} == set(fim.FORMS)
    for r in rows:
        assert (r.output, r.form, r.n, r.prefix_chars, r.middle_chars) == middle(r.doc_id, r.text)
        assert r.back == (r.text or "")


def test_middles_of_nothing(empty):
    assert fim.add_middle(empty).count() == 0


@pytest.mark.parametrize("window", [1, 7, 64])
def test_windows_do_not_matter(monkeypatch, window):
    monkeypatch.setattr(fim, "WINDOW", window)
    texts = ["", "one two  three\n", "<S", " é", "x" * 50, "", "a b c d e f"]
    data, offsets = fim.text_bytes(fim.pa.array(texts))
    for form in (fim.PSM, fim.SPM):
        n, low, high = fim.scan_cuts(data, offsets, np.arange(7), np.arange(7) * 3)
        forms = np.where(np.diff(offsets) > 0, form, fim.PLAIN)
        made, out = fim.scatter(data, offsets, low, high, forms)
        text, back = fim.gather(made, out, forms)
        assert text.tobytes() == data.tobytes() and back.tolist() == offsets.tolist()
    whole = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    places = np.sort(np.concatenate([offsets, low, high]))
    assert fim.chars_before(data, places).tolist() == whole[places].tolist()


def test_outputs_without_sentinels_are_refused():
    data, offsets = fim.text_bytes(fim.pa.array(["<P>a<S>b"]))
    with pytest.raises(ValueError):
        fim.gather(data, offsets, np.array([fim.PSM]))


# Whitening


def plain_whitening(rows, width):
    good = [(i, v) for i, v in rows if v is not None and len(v) == width and all(e is not None and np.isfinite(e) for e in v)]
    x = np.floor(np.array([v for _, v in good], float) * 256).astype(object).astype(int)
    fit = np.unique(x, axis=0)
    v = np.cov(fit.T, bias=True)
    values, axes = np.linalg.eigh(v)
    return good, x, fit, v, values[::-1], axes.T[::-1]


def check_whitening(got: pd.DataFrame, rows, width, components):
    good, x, fit, v, values, axes = plain_whitening(rows, width)
    n, s = len(fit), fit.sum(axis=0)
    assert len(got) == len(good) * components and set(got.n) == {n}
    deviation = {}
    for (i, _), row in zip(good, x):
        deviation.setdefault(i, []).append(sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)))
    for k in range(1, components + 1):
        part = got[got.component == k].sort_values(["vec_id", "deviation"])
        want = ((x - s / n) @ axes[k - 1]) / np.sqrt(values[k - 1])
        want = pd.DataFrame({"i": [i for i, _ in good], "w": want, "d": [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]})
        want = want.sort_values(["i", "d"])
        assert [int(d) for d in part.deviation] == want.d.tolist()
        sign = np.sign(part.whitened.values @ want.w.values)
        assert np.abs(part.whitened.values.astype(float) - sign * want.w.values).max() < 1e-6
        assert np.allclose(part.explained.astype(float), values[k - 1] / np.trace(v), rtol=1e-9)
    assert got.identity_error.astype(float).max() < 1e-9 and got.identity_error.nunique() == 1


def test_whitening_equals_brute_force(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    got = entry.queries()["op13_polarisation_whitening"](spark, FOLDER).toPandas()
    check_whitening(got, [(r.vec_id, r.embedding) for r in df.collect()], 64, 4)


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(60)]
    rows += rows[:7] + [(200 + i, rows[0][1]) for i in range(40)] + [(None, rows[1][1])]
    odd = [(300, None), (301, []), (302, [1.0, None, 2.0]), (303, [float("nan"), 0.0, 0.0]), (304, [float("inf"), 0.0, 0.0]), (305, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({n: F.lit(1) for n in ("x", "n", "component", "m")})
    got = whitening.whiten(df, whitening.fit_whitening(df)).toPandas().fillna({"vec_id": -1})
    check_whitening(got, [(-1 if i is None else i, v) for i, v in rows], 3, 3)


def test_whitening_without_variance(spark):
    one = spark.createDataFrame([(1, [0.5, 1e300]), (2, [0.5, 1e300])], "vec_id long, embedding array<double>")
    got = whitening.whiten(one, whitening.fit_whitening(one)).collect()
    assert len(got) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.n == 1 for r in got)
    flat = spark.createDataFrame([(i, [float(i), 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    got = whitening.whiten(flat, whitening.fit_whitening(flat)).orderBy("vec_id", "component").collect()
    assert [r.whitened is None for r in got] == [False, True] * 5 and got[0].explained == 1.0
    assert whitening.whiten(flat.limit(0), whitening.fit_whitening(flat.limit(0))).count() == 0


@pytest.mark.parametrize("size", [10, 1 << 20, 1 << 35, 1 << 50])
def test_squares_are_exact(size):
    z = np.random.default_rng(1).integers(-size, size, (50, 3))
    assert whitening.square_sums(z).tolist() == [sum(int(v) ** 2 for v in c) for c in z.T]
    assert whitening.square_sums(z.astype(object)).tolist() == [sum(int(v) ** 2 for v in c) for c in z.T]

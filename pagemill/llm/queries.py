"""Registered queries of the training-data operators: thin digests of what the
operators return, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import bands, chunks, decontam, fim, grace, langid, neardup, packing, pii, quality, secret_scan, toxicity, whitening
from pagemill.llm.common import held_out, present, table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return add


def learn_quality(spark: SparkSession, folder: str, docs: DataFrame) -> quality.CompressionModel:
    labelled = table(spark, folder, "labels").where(~held_out(F.col("doc_id"), 5, 0)).withColumnRenamed("quality", "label")
    return quality.fit(docs, labelled)


@query("op1_quality")
def op1_quality(spark, folder):
    docs = present(table(spark, folder, "documents"), ["doc_id", "text"])
    scored = quality.score(docs, learn_quality(spark, folder, docs))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op5_compression_bands")
def op5_compression_bands(spark, folder):
    docs = present(table(spark, folder, "documents"), ["doc_id", "text"])
    return bands.add_bands(docs).select(
        "doc_id", "bands.n_words", "bands.word_chars", "bands.n_symbols", "bands.n_dup_lines", "bands.n_repeat_words",
        "bands.base_failed", "bands.kept", "bands.ratio", "bands.n_chunks", "bands.n_bad_chunks",
    )


@query("op7_segmented_unigrams")
def op7_segmented_unigrams(spark, folder):
    rows = present(table(spark, folder, "documents"), ["doc_id", "text", "lang"])
    docs = rows.select("doc_id", "text")
    model = langid.fit(docs, rows.where(~held_out(F.col("doc_id"), 4, 2)).select("doc_id", "lang"))
    return langid.predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score"
    )


OP8_SQL = r"""
WITH item_words AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS s FROM item_words WHERE len(w) > 0)),
docs AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
sizes AS (SELECT DISTINCT k FROM wins),
spans AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM (SELECT doc_id, k, w, unnest(generate_series(1, len(w) - k + 1)) AS s FROM docs, sizes WHERE len(w) >= k)),
found AS (SELECT doc_id, s, spans.k, item_id FROM spans JOIN wins USING (k, win)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + k - 1)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op8_prefix_decontamination", OP8_SQL)
def op8_prefix_decontamination(spark, folder):
    docs = present(table(spark, folder, "documents"), ["doc_id", "text"])
    return decontam.find_contamination(docs, table(spark, folder, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


OP10_SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingles AS MATERIALIZED (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i + 2], ' ')) END)) AS s FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""


@query("op10_bottom_k", OP10_SQL)
def op10_bottom_k(spark, folder):
    docs = present(table(spark, folder, "documents"), ["doc_id", "text"])
    return neardup.find_groups(docs).drop("row", "group")


@query("op9_bootstrapped_pii")
def op9_bootstrapped_pii(spark, folder):
    docs = present(table(spark, folder, "documents"), ["doc_id", "text"])
    listed = "array_join(transform({0}, m -> concat(m.kind, ':', m.start, ':', m.end)), ',')"
    counts = [F.expr(f"CAST(size(filter(base, m -> m.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in pii.KINDS]
    return pii.find_personal_data(docs).select(
        "doc_id", *counts, F.expr(f"sha2({listed.format('base')}, 256)").alias("base_sha256"), F.expr(listed.format("spans")).alias("spans")
    )


def packed_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op6_vector_packing")
def op6_vector_packing(spark, folder):
    return packed_digest(packing.pack(present(table(spark, folder, "documents"), ["doc_id", "text"])))


@query("op2_toxicity")
def op2_toxicity(spark, folder):
    docs = present(table(spark, folder, "documents"), ["doc_id", "text"])
    labelled = table(spark, folder, "labels").where(~held_out(F.col("doc_id"), 5, 0)).withColumnRenamed("toxic", "label")
    scored = toxicity.score(docs, toxicity.fit(docs, labelled))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op4_chunk_dedup")
def op4_chunk_dedup(spark, folder):
    found = chunks.find_repeats(present(table(spark, folder, "documents"), ["doc_id", "text"]))
    return found.select("doc_id", "start", "end", "n_words", "n_chunks", "n_new", "first_doc_ids")


@query("op3_secret_forest")
def op3_secret_forest(spark, folder):
    docs = present(table(spark, folder, "documents"), ["doc_id", "text"])
    return secret_scan.scan(docs).select(
        "doc_id", "start", "end", F.sha2(F.col("hit").cast("binary"), 256).alias("hit_sha256"), "score", "secret"
    )


OP11_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS bare
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, CAST(count(*) OVER (PARTITION BY bare) AS BIGINT) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(bare) AS text_sha256
FROM t WINDOW best AS (PARTITION BY bare ORDER BY chars DESC, doc_id)
"""


@query("op11_grace_dedup", OP11_SQL)
def op11_grace_dedup(spark, folder):
    return grace.find_copies(present(table(spark, folder, "documents"), ["doc_id", "text"])).drop("row")


OP12_SQL = r"""
WITH tokens AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
drawn AS (SELECT doc_id, t, w, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50
      THEN 'plain' WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM tokens),
cut AS (SELECT doc_id, t, n, form, array_to_string(w[1:least(a, b)], '') AS p, array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(w[greatest(a, b) + 1:], '') AS s FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
    AS output_sha256, sha256(t) AS restored_sha256
FROM cut
"""


@query("op12_fim_scatter", OP12_SQL)
def op12_fim_scatter(spark, folder):
    made = fim.add_middle(present(table(spark, folder, "documents"), ["doc_id", "text"])).select("doc_id", "fim.*")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


@query("op13_polarisation_whitening")
def op13_polarisation_whitening(spark, folder):
    vectors = present(table(spark, folder, "embeddings"), ["vec_id", "embedding"])
    model = whitening.fit_whitening(vectors)
    return whitening.whiten(vectors, model).withColumn("deviation", F.col("deviation").cast("long"))

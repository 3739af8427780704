"""Registry and the inputs shared by the registered queries. Every input is one
of the given tables or an expression over them, written once as SQL text that
Spark and the checking engine both read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions import porter
from pagemill.functions.text import model_tokens, tokens
from pagemill.session import spread

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP = [*fixed.STOP_WORDS, fixed.MASK_TOKEN]
MODEL_STOP = [*fixed.STOP_WORDS, *fixed.MODEL_STOP_WORDS]
PHRASES = ["of the", "by the", "thing", "nicht", "mentre", "erha"]

# ---- fetches: pages with statuses, failures, images and empty bodies ----------
FETCH_COLUMNS = {
    "url": "CASE WHEN page_id % 11 = 5 THEN url || '.jpg' ELSE url END",
    "html": "CASE WHEN page_id % 13 = 4 THEN '<html><head></head><body></body></html>' ELSE html END",
    "status": "CASE page_id % 10 WHEN 7 THEN 404 WHEN 8 THEN 502 ELSE 200 END",
    "content_type": "CASE page_id % 10 WHEN 6 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END",
    "error": "CASE page_id % 10 WHEN 9 THEN 'timeout' END",
    "stamp": "CAST(1704067200 + page_id AS STRING)",
}
FETCH_CTE = "fetches AS (SELECT page_id, " + ", ".join(f"{e} AS {n}" for n, e in FETCH_COLUMNS.items()) + " FROM pages)"


def fetches(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id", *[F.expr(e).alias(n) for n, e in FETCH_COLUMNS.items()]
    ).withColumn("fetch_time", F.timestamp_seconds(F.col("stamp").cast("bigint")))


# ---- HTML in SQL --------------------------------------------------------------
SQL_HIDDEN = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|<iframe\b[^>]*>.*?(?:</iframe\s*>|\z)"
)
SQL_TAG = r"<[/!?a-zA-Z][^>]*>"


def sql_decode(text: str) -> str:
    """The references that occur in the page table."""
    for name, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
        text = f"replace({text}, '{name}', '{char}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


def sql_visible(html: str) -> str:
    nodes = f"regexp_split_to_array(regexp_replace({html}, '{SQL_HIDDEN}', '<!>', 'g'), '{SQL_TAG}')"
    return sql_decode(f"array_to_string(list_filter({nodes}, lambda x: x <> ''), chr(10))")


def sql_title(html: str) -> str:
    return sql_decode(rf"regexp_extract({html}, '(?is)<title\b[^>]*>([^<]*)</title', 1)")


TEXT_CTE = f"""{FETCH_CTE},
parsed AS (SELECT *, {sql_title('html')} AS title, {sql_visible('html')} AS visible FROM fetches),
texts AS (SELECT *, CASE WHEN trim(title || visible, ' ' || chr(10)) <> ''
  THEN title || ' ' || title || chr(10) || visible ELSE '' END AS clean_text FROM parsed)"""

SQL_CODE = """CASE WHEN url LIKE '%.jpg' THEN '1001' WHEN error IS NOT NULL THEN '2001'
  WHEN status <> 200 THEN '0' || CAST(status AS STRING)
  WHEN content_type NOT LIKE '%text/html%' THEN '1001' ELSE '0200' END"""
SQL_TEXT_CODE = f"CASE WHEN {SQL_CODE} = '0200' AND clean_text = '' THEN '2000' ELSE {SQL_CODE} END"


def sql_mask(text: str) -> str:
    """Two passes per group, phrases of several words first: neighbouring matches
    share a separator, and the checking engine has no look-around."""
    several = "|".join(p for p in PHRASES if " " in p)
    single = "|".join(p for p in PHRASES if " " not in p)
    for group in (several, several, single, single):
        text = rf"""regexp_replace({text}, '(^|[^a-zA-Z0-9.-])({group})(\W|$)', '\1{{"profanity"}}\3', 'gi')"""
    return text


def sql_words(text: str) -> str:
    return rf"list_filter(regexp_extract_all({text}, '[\p{{L}}\p{{N}}_]+'), lambda t: NOT contains(t, '_'))"


def sql_tokens(text: str) -> str:
    low = f"list_transform({sql_words(text)}, lambda t: lower(t))"
    return f"list_filter({low}, lambda t: NOT list_contains({sql_list(STOP)}, t))"


def sql_model_words(text: str) -> str:
    kept = f"list_filter({sql_words(text)}, lambda t: length(t) > 2 AND NOT list_contains({sql_list(MODEL_STOP)}, t))"
    return f"list_transform({kept}, lambda t: lower(t))"


# ---- stems in SQL -------------------------------------------------------------
def _rule(conditions) -> str:
    body = " ".join(f"WHEN x LIKE '%{s}' THEN CASE WHEN {c} THEN {r} ELSE x END" for s, c, r in conditions)
    return f"CASE {body} ELSE x END"


def _m(shape: str, n: int) -> str:
    return f"regexp_matches(left(x, length(x) - {n}), '{shape}')"


def sql_stems(source: str, prefix: str = "st") -> str:
    """CTEs that give `{prefix}_stems(token, stem)` for the distinct tokens of
    `source(token)`."""
    p = porter
    cut = lambda n: f"left(x, length(x) - {n})"
    last, second = "right(x, 1)", "left(right(x, 2), 1)"
    steps = [
        f"""CASE WHEN x LIKE '%ies' AND length(x) = 4 THEN {cut(1)} WHEN x LIKE '%sses' THEN {cut(2)}
          WHEN x LIKE '%ies' THEN {cut(2)} WHEN x LIKE '%ss' THEN x WHEN x LIKE '%s' THEN {cut(1)} ELSE x END""",
        f"""CASE WHEN x LIKE '%ied' THEN CASE WHEN length(x) = 4 THEN {cut(1)} ELSE {cut(2)} END
          WHEN x LIKE '%eed' THEN CASE WHEN {_m(p.M_GT_0, 3)} THEN {cut(1)} ELSE x END
          WHEN x LIKE '%ed' AND {_m(p.HAS_VOWEL, 2)} THEN '!' || {cut(2)}
          WHEN x LIKE '%ing' AND {_m(p.HAS_VOWEL, 3)} THEN '!' || {cut(3)} ELSE x END""",
        f"""CASE WHEN x LIKE '!%' THEN (SELECT CASE
            WHEN regexp_matches(y, '(?:at|bl|iz)$') THEN y || 'e'
            WHEN length(y) > 1 AND right(y, 1) = left(right(y, 2), 1)
              AND (NOT contains('aeiouy', right(y, 1)) OR regexp_matches(y, '[^aeiouy]yy$'))
              THEN CASE WHEN right(y, 1) IN ('l', 's', 'z') THEN y ELSE left(y, length(y) - 1) END
            WHEN regexp_matches(y, '{p.M_EQ_1}$') AND regexp_matches(y, '{p.CVC}$') THEN y || 'e'
            ELSE y END FROM (SELECT substr(x, 2) AS y)) ELSE x END""",
        f"CASE WHEN x LIKE '%y' AND regexp_matches(x, '(?:.[^aeiouy]|[aeiou]y)y$') THEN {cut(1)} || 'i' ELSE x END",
        f"CASE WHEN x LIKE '%alli' AND {_m(p.M_GT_0, 4)} THEN {cut(2)} ELSE x END",
        _rule([(s, _m(p.M_GT_0, len(s)), f"{cut(len(s))} || '{to}'") for s, to in p.STEP_2]
              + [("logi", _m(p.M_GT_0, 3), cut(1))]),
        _rule([(s, _m(p.M_GT_0, len(s)), f"{cut(len(s))} || '{to}'") for s, to in p.STEP_3]),
        _rule([(s, _m(p.M_GT_1, len(s)) + (" AND left(right(x, 4), 1) IN ('s', 't')" if s == "ion" else ""), cut(len(s)))
               for s in p.STEP_4]),
        f"""CASE WHEN x LIKE '%e' THEN CASE WHEN {_m(p.M_GT_1, 1)} OR ({_m(p.M_EQ_1 + '$', 1)}
            AND NOT {_m(p.CVC + '$', 1)}) THEN {cut(1)} ELSE x END
          WHEN x LIKE '%ll' AND {_m(p.M_GT_1, 1)} THEN {cut(1)} ELSE x END""",
    ]
    ctes = [f"{prefix}_0 AS (SELECT DISTINCT token, token AS x FROM {source})"]
    for i, step in enumerate(steps):
        ctes.append(f"{prefix}_{i + 1} AS MATERIALIZED (SELECT token, {step} AS x FROM {prefix}_{i})")
    odd = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in p.IRREGULAR.items())
    ctes.append(
        f"{prefix}_stems AS MATERIALIZED (SELECT token, CASE WHEN length(token) <= 2 THEN token ELSE "
        f"CASE token {odd} ELSE x END END AS stem FROM {prefix}_{len(steps)})"
    )
    return ",\n".join(ctes)


# ---- documents with tokens ------------------------------------------------------
def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def token_docs(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, lang, source, tokens)"""
    return documents(spark, folder).select("doc_id", "lang", "source", tokens(F.col("text")).alias("tokens"))


def model_docs(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, lang, source, text, tokens) with stemmed model tokens."""
    return documents(spark, folder).select(
        "doc_id", "lang", "source", "text", model_tokens(F.col("text")).alias("tokens")
    )


TOKEN_CTE = f"""docs AS (SELECT doc_id, lang, source, {sql_tokens('text')} AS tokens FROM documents),
tok AS (SELECT doc_id, generate_subscripts(tokens, 1) - 1 AS pos, unnest(tokens) AS token FROM docs)"""

MODEL_CTE = f"""mdocs AS (SELECT doc_id, lang, source, {sql_model_words('text')} AS words FROM documents),
mwords AS (SELECT doc_id, generate_subscripts(words, 1) AS i, unnest(words) AS token FROM mdocs),
{sql_stems('mwords')},
mtok AS (SELECT doc_id, i, stem AS term FROM mwords JOIN st_stems USING (token)
  WHERE NOT list_contains({sql_list(MODEL_STOP)}, stem)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM mtok GROUP BY ALL),
mx AS (SELECT doc_id, max(tf) AS max_tf FROM tf GROUP BY ALL)"""

TOPIC_CTE = f"""{MODEL_CTE},
vocab AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, sum(tf * 1.0 / max_tf) AS mass
  FROM tf JOIN mx USING (doc_id) GROUP BY term HAVING count(*) >= 2),
model AS (SELECT term, df, cf, df * cf AS score, mass / (SELECT count(*) FROM documents) AS weight
  FROM vocab ORDER BY df * cf DESC, term LIMIT 10)"""

# ---- tweets ---------------------------------------------------------------------
TWEET_CTE = """tweets AS (SELECT CAST(e.event_id AS STRING) AS tweet_id, e.event_id AS seq,
  CAST(e.user_id % 4 AS STRING) AS collection_id, '#' || e.event_type AS collection_name, p.url
  FROM events e JOIN pages p ON e.event_id % (SELECT count(*) FROM pages) = p.page_id)"""


def tweets(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    n = pages.count()
    return table(spark, folder, "events").withColumn("page_id", F.col("event_id") % n).join(pages, "page_id").select(
        F.col("event_id").cast("string").alias("tweet_id"), F.col("event_id").alias("seq"),
        (F.col("user_id") % 4).cast("string").alias("collection_id"),
        F.concat(F.lit("#"), "event_type").alias("collection_name"), "url",
    )


# ---- scored pages: documents with labels, domain = source -------------------------
SCORED_CTE = """scored AS (SELECT doc_id AS page_id, source AS domain, quality AS label,
  (doc_id * 37 % 101) / 100.0 AS score FROM documents JOIN labels USING (doc_id))"""


def scored(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return docs.join(table(spark, folder, "labels"), "doc_id").select(
        F.col("doc_id").alias("page_id"), F.col("source").alias("domain"), F.col("quality").alias("label"),
        (F.col("doc_id") * 37 % 101 / 100.0).alias("score"),
    )

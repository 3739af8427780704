"""Secret scanning with false-positive removal.

Every value given to a word for a secret and every token of LEAST characters is a
finding. A random forest says which ones are
secrets, from their length, character transitions, how much of them a dictionary
of the corpus covers, whether they look like part of a path, and the words beside
them. The forest learns from labelled findings. Built-in functions and Spark's own
forest only."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import maybe_broadcast
from pagemill.llm.pii import position
from pagemill.session import settle

# A word is in the dictionary if this many documents have it.
DICTIONARY_DOCS = 5
LEAST_WORD = 3
# Bound of each part of the labelled sample: findings whose text hashes lowest.
LEARN_FINDINGS = 4_000
TREES, DEPTH, SEED = 24, 6, 11
# Score of a finding that the rule leaves open when there is no forest.
PRIOR = 0.25
# Words beside secrets, and beside other long tokens.
SECRET_WORDS = ("token", "secret", "key", "apikey", "password", "passwd", "pwd", "auth", "bearer", "credential", "credentials", "access")
PLAIN_WORDS = ("sha", "sha1", "sha256", "md5", "commit", "checksum", "digest", "hash", "uuid", "id", "revision", "etag")

# What a finding is. A value given to a word for a secret has any
# length; other tokens have LEAST characters, without punctuation at their end.
LEAST = 8
INNER, POINT = r"A-Za-z0-9_/+=@$%~^&*#\-", r".!:?"
NAMED = rf"(?i:{'|'.join(SECRET_WORDS)})"
# A quick look at the character before comes first: most places end there.
VALUE = r"""(?<=[=:\x20\x09"\x27`])(?<=[=:][\x20\x09"\x27`]{0,4})(?<=""" + NAMED + r"""["\x27`]?[\x20\x09]{0,3}[=:][\x20\x09]{0,3}["\x27`]?)"""
VALUE += r"""(?:(?<=["\x27`])[^\s"\x27`]++|(?<!["\x27`])[^\s"\x27`,;.!:?=]++(?:[,;.!:?=]++[^\s"\x27`,;.!:?=]++)*+=*+)"""
# A name that is given a value is no token. Short words and names that nothing is
# given to are told before the words for secrets are looked for in them.
GIVEN_TO = r"[\x22\x27`]?[\x20\x09]{0,3}[=:]"
ASSIGNS = rf"(?=[A-Za-z0-9_.-]*+{GIVEN_TO})(?:[A-Za-z0-9_.-]*[_.-]|[a-z]*|[A-Z]*){NAMED}{GIVEN_TO}"
ANY = rf"(?:[{INNER}]|[{POINT}]++(?=[{INNER}]))"
TOKEN = rf"{VALUE}|(?<![{INNER}{POINT}])(?=[{INNER}{POINT}]{{{LEAST}}})(?!{ASSIGNS}){ANY}{{{LEAST},}}+"
NEEDS = rf"[{INNER}{POINT}]{{{LEAST}}}|{NAMED}[\x22\x27`]?[\x20\x09]{{0,3}}[=:]"
# Findings that are no secrets beside PLAIN_WORDS: digests, UUIDs and paths.
DIGEST = r"^(?:[0-9a-f]{8,}|[0-9A-F]{8,}|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[A-Za-z0-9_.-]*(?:/[A-Za-z0-9_.-]+)+)$"

FEATURES = (
    "n_chars", "transitions", "letter_steps", "digit_share", "upper_share", "vowel_share", "distinct_share", "coverage", "path",
    "assigned", "quoted", "secret_word", "plain_word",
)


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, hit, path, assigned, quoted, secret_word, plain_word,
    given): the tokens above, in code points, with what the text around them says.
    `given` holds for quoted values of a word for a secret. Written. Null and empty
    texts have none; repeated rows give repeated findings."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # An outer explode has no filter that the optimizer would move below the scan.
    found = position(rows, "found", "text", TOKEN, NEEDS).select("doc_id", F.explode_outer("found").alias("m")).where("m IS NOT NULL").select("doc_id", "m.*")
    near = F.expr(r"array_compact(transform(split(lower(concat(right(before, 40), ' ', left(after, 20))), r'[^a-z0-9]+'), w -> nullif(w, '')))")
    listed = lambda words_: F.arrays_overlap(near, F.array(*map(F.lit, words_)))
    given = NAMED + r"""["'`]?\s*[=:]\s*["']$"""
    return settle(found.select(
        "doc_id", "start", "end", "hit",
        (F.contains("hit", F.lit("/")) | F.rlike("before", F.lit(r"[/\\.@]$")) | F.rlike("after", F.lit(r"^[/\\.][A-Za-z]"))).alias("path"),
        F.rlike("before", F.lit(r"[=:]\s*[\"']?$")).alias("assigned"), F.rlike("before", F.lit("[\"'`]$")).alias("quoted"),
        listed(SECRET_WORDS).alias("secret_word"), listed(PLAIN_WORDS).alias("plain_word"), F.rlike("before", F.lit(given)).alias("given"),
    ), "findings")


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word): lower-cased runs of a-z that DICTIONARY_DOCS documents or more have.
    Null and empty texts have none; repeated rows count as documents of their own."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), "[^a-z]+"))
    counts = docs.select(F.explode(words).alias("word")).where(F.length("word") >= LEAST_WORD).groupBy("word").count()
    return settle(counts.where(F.col("count") >= DICTIONARY_DOCS).select("word"), "dictionary")


def share(pattern: str) -> Column:
    """Part of `hit` made of characters of the class."""
    return F.length(F.regexp_replace("hit", f"[^{pattern}]", "")) / F.length("hit")


def add_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """`found` with the columns FEATURES, none of them null. Equal tokens are looked up
    once and have equal features, but for those of the text around them. Without
    `words` nothing is covered; an empty table stays empty."""
    parts = found.select("hit").distinct().select(
        "hit", F.explode(F.expr(f"filter(split(lower(hit), '[^a-z]+'), w -> length(w) >= {LEAST_WORD})")).alias("word")
    )
    covered = parts.join(words, "word").groupBy("hit").agg(F.sum(F.length("word")).alias("covered"))
    classes = F.expr(
        "regexp_replace(regexp_replace(regexp_replace(regexp_replace(hit, '[a-z]', 'a'), '[A-Z]', 'B'), '[0-9]', '0'), '[^aB0]', '-')"
    )
    steps = F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower("hit"), "[aeiouy]", "1"), "[a-z]", "2"), r"(.)\1*", "$1"))
    plain = F.col("hit")
    return found.join(maybe_broadcast(settle(covered, "covered")), "hit", "left").withColumns({
        "n_chars": F.length(plain).cast("double"),
        "transitions": (F.length(F.regexp_replace(classes, r"(.)\1*", "$1")) - 1) / F.length(plain),
        "letter_steps": steps / F.length(plain),
        "digit_share": share("0-9"), "upper_share": share("A-Z"), "vowel_share": share("AEIOUYaeiouy"),
        "distinct_share": F.size(F.array_distinct(F.split(plain, ""))) / F.length(plain),
        "coverage": F.coalesce("covered", F.lit(0)) / F.length(plain),
        **{n: F.col(n).cast("double") for n in ("path", "assigned", "quoted", "secret_word", "plain_word")},
    }).drop("covered")


FLAGS = ("path", "assigned", "quoted", "secret_word", "plain_word")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, start, end, hit, score, secret): all findings of `docs`, judged by a
    forest that learns from those that rule_label can tell. Findings that agree in
    their text and in what stands around it are one variant: features, labels and
    scores are made once for each."""
    words = dictionary(docs, text)
    found = findings(docs, doc_id, text)
    kinds = found.select("hit", *FLAGS, "given").distinct()
    variants = settle(known_labels(add_features(kinds, words)), "variants")
    judged = judge(variants, train_with_examples(variants, words), least).select(
        "hit", *[F.col(n).cast("boolean").alias(n) for n in FLAGS], "given", "score", "secret"
    )
    joined = found.join(settle(judged, "judged-variants"), ["hit", *FLAGS, "given"])
    return joined.select("doc_id", "start", "end", "hit", "score", "secret")


def assemble(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="__features", handleInvalid="keep").transform(df)


def examples(spark: SparkSession) -> DataFrame:
    """(doc_id, text): invented texts with labelled findings of both kinds, made by a
    rule from the digests of 0 to 199: quoted values given to a word for a secret,
    plain words, digests and paths. For a corpus in which one label is missing."""
    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    value = F.left(F.translate(F.base64(F.unhex(digest)), "+/=", "xyz"), F.lit(10) + F.col("id") % 24)
    word = F.element_at(F.array(*map(F.lit, ("password", "api_key", "secret", "token"))), (F.col("id") % 4 + 1).cast("int"))
    letters = F.translate(digest, "0123456789", "ghijklmnop")
    text = F.concat(
        word, F.lit(' = "'), value, F.lit('" written by '), F.left(letters, F.lit(8) + F.col("id") % 7), F.lit(" sha256 "), digest,
        F.lit(" commit "), F.left(digest, F.lit(40)), F.lit(" checksum /usr/"), F.left(letters, F.lit(5)), F.lit("/"), F.right(letters, F.lit(6)),
    )
    return spark.range(200).select(F.col("id").alias("doc_id"), text.alias("text"))


def train(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """Forest from findings with FEATURES and `label` (0, 1; null: not used). Of each
    label, and apart with and without a digit or slash (plain words would leave no
    room for digests), the LEARN_FINDINGS distinct rows whose text hashes lowest are
    used; ties are ordered by their features. None without both labels, as for an
    empty table."""
    rows = labelled.select(*FEATURES, "hit", F.col("label").cast("double").alias("label")).where("label IS NOT NULL").distinct()
    rows = settle(rows, "labelled")
    sample = [
        rows.where((F.col("label") == x) & (F.rlike("hit", F.lit("[0-9/]")) == other)).orderBy(F.xxhash64("hit"), *FEATURES).limit(LEARN_FINDINGS)
        for x in (0, 1) for other in (False, True)
    ]
    learn = settle(reduce(DataFrame.union, sample), "labelled-findings")
    if learn.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="__features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=1.0
    )
    return forest.fit(assemble(learn.coalesce(1)))  # at most 4 * LEARN_FINDINGS rows


def train_with_examples(labelled: DataFrame, words: DataFrame) -> RandomForestClassificationModel:
    """`train`, with the findings of `examples` added if `labelled` lacks a label."""
    model = train(labelled)
    if model is None:
        shipped = known_labels(add_features(findings(examples(labelled.sparkSession)), words))
        model = train(labelled.select(*FEATURES, "hit", "label").unionByName(shipped.select(*FEATURES, "hit", "label")))
    return model


def judge(found: DataFrame, model: RandomForestClassificationModel | None, least: float = 0.5) -> DataFrame:
    """`found` (with FEATURES) with `score` (0 to 1) and `secret` (score >= least).
    Equal findings have equal scores; an empty table stays empty. Without a model the
    rule of known_labels decides, and what it leaves open scores PRIOR."""
    if model is None:
        score = F.coalesce(rule_label(), F.lit(PRIOR))
        return found.withColumn("score", score).withColumn("secret", F.col("score") >= least)
    judged = model.transform(assemble(found)).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return judged.drop("__features", "rawPrediction", "probability", "prediction").withColumn("secret", F.col("score") >= least)


def rule_label() -> Column:
    """1 for keys of a published form (fixed values below) or quoted values that are
    given to a word for a secret, 0 for tokens of letters alone in ordinary case that
    are not assigned, and for digests, UUIDs and paths beside PLAIN_WORDS but no word
    for a secret; null otherwise."""
    published = r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})$"
    flag = lambda n: F.col(n).cast("boolean")
    word = F.rlike("hit", F.lit("^[A-Z]?[a-z]+$")) & ~flag("assigned")
    digest = F.rlike("hit", F.lit(DIGEST)) & flag("plain_word") & ~flag("secret_word")
    return F.when(F.rlike("hit", F.lit(published)) | F.col("given"), 1.0).when(word | digest, 0.0)


def known_labels(found: DataFrame) -> DataFrame:
    """`found` with `label` where rule_label can tell it without the forest, else null."""
    return found.withColumn("label", rule_label())

"""Personal data: fixed forms first, then bootstrapped contextual extraction.

The base finds e-mail addresses, IP addresses, card and phone numbers by form.
Those are the seed instances. The words around an instance are its lexical
patterns; patterns and instances make a graph that is scored in rounds: a pattern
is worth the share of its instances that are good, an instance is good if one of
its patterns is. Patterns of high confidence then mark further identifiers that
have no known form: tokens with a digit, runs of digit groups, and, at the places
of patterns that identifiers without a digit have given, words. Built-in functions
only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import maybe_broadcast, text_key
from pagemill.session import settle

# Kinds in their order and the forms of the base. Possessive
# quantifiers and look-behinds keep long runs linear; they match the same text.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
FORMS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts without this cannot have the form.
NEEDS = {
    "email": r"@[A-Za-z0-9-]++\.",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[ -]?[0-9]){11}",
    "phone": r"\+[0-9]",
}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Tokens with a digit: possible identifiers, of any length.
TOKEN_CHARS = r"A-Za-z0-9._:/#@+-"
TOKEN = rf"(?<![{TOKEN_CHARS}])[A-Za-z._:/#@+-]*+[0-9][{TOKEN_CHARS}]*+"
# Digit groups joined by a blank, brackets, dot or hyphen; each is a whole token.
GROUP = r"[0-9]++(?:[.-]++[0-9]++)*+(?![._:/#@+-]*+[A-Za-z0-9_])"
JOIN = r"\)?+[\x20\xA0]?+(?:-[\x20\xA0]?+)?+\(?+"
RUN = rf"(?<![{TOKEN_CHARS}])(?:\((?=\+?[0-9]++\)))?+\+?+[0-9]++(?:[.-]++[0-9]++)*+(?:\)(?=[0-9])|(?![._:/#@+-]*+[A-Za-z0-9_]))(?:{JOIN}{GROUP})++"
RUN_NEEDS = r"[0-9][)\x20\xA0-][^A-Za-z0-9]{0,4}+[0-9]|[0-9]\([0-9]"
# A name without a digit, alone or with its host spelled out.
AT, DOT = (rf"[\x20\xA0](?:{w}|\({w}\)|\[{w}\])[\x20\xA0]" for w in ("at", "dot"))
NAME = (
    r"\p{L}++(?:[._%+-]++\p{L}++)*+(?![._%+-]*+[\p{N}@/:#_])"
    rf"(?:{AT}[\p{{L}}\p{{N}}-]++(?:(?:\.|{DOT})[\p{{L}}\p{{N}}-]++)*+)?+"
)
GAP, NOT_INSIDE, AT_NAME = r"[^\p{L}\p{N}]+", r"(?iu)(?<![\p{L}\p{N}])", r"(?=\p{L})"
NAME_REACH = 320  # code points in which a name is read

ROUNDS = 3
# A pattern needs this many distinct good instances, and this share of all its
# instances (with DOUBT unknown ones added) has to be good.
SUPPORT = 3
CONFIDENCE = 0.8
DOUBT = 1.0


def quoted(pattern: str) -> str:
    """An SQL raw string."""
    return "r'" + pattern + "'"


def position(df: DataFrame, name: str, text: str, pattern: str, needs: str) -> DataFrame:
    """`df` with array<struct<start, end, hit, before, after>> `name`: leftmost
    matches in code points, end exclusive, with up to 80 code points on either
    side. The text between matches gives the positions."""
    return df.withColumn(name, F.expr(position_sql(text, quoted(pattern), f"rlike({text}, {quoted(needs)})")))


BLOCK = 64


def position_sql(text: str, pattern: str, able: str) -> str:
    """SQL for `position` with a pattern that is an SQL expression, where `able`
    holds. One expression that binds what it uses twice, so that no rule of the
    optimizer can copy the scan of the text into the loops over matches. Lengths are
    summed by blocks, and then inside each block: the work grows with the matches,
    not with their square."""
    none = "CAST(array() AS ARRAY<STRING>)"
    # r.h: matches; r.p: the texts between them; s: lengths up to a match's end;
    # b: sums before each block; e: ends of all matches.
    item = f"aggregate(sequence(%s * {BLOCK}, least(%s * {BLOCK} + {BLOCK - 1}, size(s) - 1)), "
    return f"""get(transform(array(IF({able}, named_struct('h', regexp_extract_all({text}, {pattern}, 0), 'p', split({text}, {pattern}, -1)),
        named_struct('h', {none}, 'p', {none}))), r -> IF(size(r.h) = 0, CAST(array() AS ARRAY<STRUCT<start:INT,end:INT,hit:STRING,before:STRING,after:STRING>>),
      get(transform(array(transform(r.h, (h, i) -> length(get(r.p, i)) + length(h))), s ->
        get(transform(array(aggregate(sequence(0, CAST((size(s) - 1) DIV {BLOCK} AS INT)), array(0), (acc, k) -> array_append(acc, element_at(acc, -1) +
            {item % ("k", "k")} 0, (t, i) -> t + get(s, i))))), b ->
          get(transform(array(flatten(transform(sequence(0, size(b) - 2), k -> slice({item % ("k", "k")} array(get(b, k)),
              (t, i) -> array_append(t, element_at(t, -1) + get(s, i))), 2, {BLOCK})))), e ->
            transform(r.h, (h, i) -> named_struct('start', get(e, i) - length(h), 'end', get(e, i), 'hit', h,
              'before', right(get(r.p, i), 80), 'after', left(get(r.p, i + 1), 80)))), 0)), 0)), 0))), 0)"""


def valid(kind: str) -> str:
    """SQL condition on a match `m` beyond its form."""
    digits = f"regexp_replace(m.hit, {quoted('[^0-9]')}, '')"
    return {
        "email": "true",
        "ip": f"rlike(m.hit, {quoted(rf'^{BYTE}(?:[.]{BYTE}){{3}}$')})",
        "card": f"length({digits}) BETWEEN 12 AND 19 AND luhn_check({digits})",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
    }[kind]


def patterns(m: str) -> str:
    """SQL for the lexical patterns of a match: the two words before it, and the
    words on both sides. Words are lower-cased runs of letters and digits."""
    words = f"array_compact(transform(split(lower({m}.%s), {quoted('[^\\p{L}\\p{N}]+')}), w -> nullif(w, '')))"
    before, after = words % "before", words % "after"
    return f"""transform(array(named_struct('b', {before}, 'a', {after})), s -> array_compact(array(
      IF(size(s.b) > 1, concat('L ', element_at(s.b, -2), ' ', element_at(s.b, -1)), NULL),
      IF(size(s.b) > 0 AND size(s.a) > 0, concat('B ', element_at(s.b, -1), ' _ ', s.a[0]), NULL))))[0]"""


def row_spans(docs: DataFrame) -> DataFrame:
    """docs(key, doc_id, text) to (key, doc_id, base, tokens). base: spans of the
    fixed forms; tokens: possible identifiers outside them. Both carry their text
    (`hit`, lower-cased) and patterns."""
    df = docs.withColumn("text", F.coalesce("text", F.lit("")))
    for kind in KINDS:
        df = position(df, kind, "text", FORMS[kind], NEEDS[kind])
    df = position(df, "run", "text", RUN, RUN_NEEDS)
    df = position(df, "token", "text", TOKEN, "[0-9]").drop("text")
    shape = (
        f"named_struct('start', m.start, 'rank', %d, 'end', m.end, 'kind', %s, 'hit', lower(m.hit), 'patterns', {patterns('m')})"
    )
    base = ", ".join(
        f"transform(filter({kind}, m -> {valid(kind)}), m -> {shape % (rank, quoted(kind))})" for rank, kind in enumerate(KINDS)
    )
    df = df.select("key", "doc_id", F.expr(f"array_sort(concat({base}))").alias("base"), "run", "token")
    edge = quoted("[._:/#@+-]+")
    # Punctuation at the edges is not part of an identifier.
    trimmed = F.expr(f"""transform(token, m -> named_struct(
      'start', m.start + length(regexp_extract(m.hit, '^' || {edge}, 0)), 'end', m.end - length(regexp_extract(m.hit, {edge} || '$', 0)),
      'hit', regexp_replace(m.hit, '^' || {edge} || '|' || {edge} || '$', ''), 'before', m.before, 'after', m.after))""")
    df = df.withColumn("token", trimmed)
    # A run that meets the base leaves its tokens.
    df = df.withColumn("run", F.expr("filter(run, m -> NOT exists(base, b -> b.start < m.end AND m.start < b.end))"))
    return df.select("key", "doc_id", "base", F.expr(
        "transform(concat(run, filter(token, m -> m.start < m.end AND NOT exists(base, b -> b.start < m.end AND m.start < b.end) "
        "AND NOT exists(run, b -> b.start < m.end AND m.start < b.end))), "
        f"m -> {shape % (len(KINDS), 'CAST(NULL AS STRING)')})"
    ).alias("tokens"))


def name_places(source: DataFrame, rows: DataFrame) -> DataFrame | None:
    """(key, start, end, kind, hit, pattern): names without a digit after two words
    that SUPPORT identifiers or more without a digit have before them, and the base
    spans at those places. Patterns are those with `W` for `L`. None if no two words
    are such. Written."""
    base = rows.select("key", F.explode("base").alias("m")).select(
        "key", "m.start", "m.end", "m.kind", "m.hit", F.explode("m.patterns").alias("pattern")
    ).where("pattern LIKE 'L %'").withColumn("pattern", F.expr("concat('W', substring(pattern, 2))"))
    seeds = base.where("NOT rlike(hit, '[0-9]')").groupBy("pattern").agg(F.count_distinct("hit").alias("seeds"))
    wanted = settle(seeds.where(F.col("seeds") >= SUPPORT).select("pattern"), "name-patterns")
    if wanted.isEmpty():
        return None
    bound = maybe_broadcast(wanted)
    words = f"filter(split(lower(text), {quoted(GAP)}), w -> w <> '')"
    pairs = source.select("key", F.expr(words).alias("w")).select("key", F.explode(F.expr(
        "array_distinct(transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) -> concat('W ', x, ' ', get(w, i + 1))))"
    )).alias("pattern"))
    texts = settle(pairs.join(bound, "pattern", "left_semi").distinct().join(source.select("key", "text").distinct(), "key"), "name-texts")
    first, second = "split(pattern, ' ')[1]", "split(pattern, ' ')[2]"
    form = f"concat({quoted(NOT_INSIDE)}, {first}, {quoted(GAP)}, {second}, {quoted(GAP + AT_NAME)})"
    # An outer explode has no filter that the optimizer would move below the scan.
    places = texts.select("key", "pattern", F.explode_outer(F.expr(position_sql("text", form, "true"))).alias("m"), "text").where(
        "m IS NOT NULL"
    ).select("key", "pattern", F.col("m.end").alias("start"), "text").withColumn("hit", F.expr(f"regexp_extract(substring(text, start + 1, {NAME_REACH}), {quoted('^' + NAME)}, 0)")).where("hit <> ''")
    names = places.select("key", "start", F.expr("start + length(hit)").alias("end"), F.lower("hit").alias("hit"), "pattern").distinct()
    spans = rows.select("key", F.col("base").alias("spans")).dropDuplicates(["key"])
    free = names.join(spans, "key").where("NOT exists(spans, b -> b.start < end AND start < b.end)")
    return settle(free.select("key", "start", "end", F.lit(None).cast("string").alias("kind"), "hit", "pattern").unionByName(
        base.join(bound, "pattern", "left_semi")
    ), "names")


def score_patterns(edges: DataFrame) -> DataFrame:
    """edges(pattern, hit, kind): kind null where unknown. Returns the patterns of
    high confidence (pattern, kind, confidence) after ROUNDS rounds. Every pair
    counts once, so copies of a text add nothing."""
    seeds = edges.where("kind IS NOT NULL").select("hit", "kind", F.lit(1.0).alias("score")).distinct()
    pairs = settle(edges.select("pattern", "hit").distinct(), "pattern-instances")
    size = settle(pairs.groupBy("pattern").agg(F.count("*").alias("n")), "pattern-sizes")
    good = seeds = settle(seeds, "seeds")
    best = None
    for _ in range(ROUNDS):
        sums = pairs.join(good, "hit").groupBy("pattern", "kind").agg(
            F.sum("score").alias("total"), F.count_if(F.col("score") >= 0.5).alias("support")
        )
        best = settle(
            sums.where(F.col("support") >= SUPPORT).join(size, "pattern")
            .withColumn("confidence", F.round(F.col("total") / (F.col("n") + DOUBT), 6))
            .where(F.col("confidence") >= CONFIDENCE).select("pattern", "kind", "confidence"),
            "patterns",
        )
        found = pairs.join(best, "pattern").groupBy("hit", "kind").agg(F.max("confidence").alias("score"))
        good = settle(seeds.union(found.join(seeds.select("hit"), "hit", "left_anti")), "instances")
    return best


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: (key, doc_id, base, spans), arrays of
    struct<start, rank, end, kind> by start, then kind. `spans` holds the base and
    what patterns add; added spans never overlap the base. `key` is row_key of
    the row; rows that agree in it have equal results. Null and empty texts have
    no spans. Among patterns of equal confidence the kind that sorts first wins."""
    source = docs.select(
        text_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("key"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    rows = settle(row_spans(source), "row-spans")
    seen = rows.select("key", F.explode(F.concat("base", "tokens")).alias("m")).select(
        "key", "m.start", "m.end", "m.kind", "m.hit", F.explode("m.patterns").alias("pattern")
    )
    names = name_places(source, rows)
    if names is not None:
        seen = seen.unionByName(names)
    best = score_patterns(seen.select("pattern", "hit", "kind"))
    added = (
        seen.where("kind IS NULL").drop("kind").join(best, "pattern").groupBy("key", "start", "end")
        .agg(F.min(F.struct((-F.col("confidence")).alias("low"), "kind")).alias("b"))
    )
    ranks = F.expr("array_position(array(" + ", ".join(quoted(k) for k in KINDS) + "), b.kind)")
    added = added.groupBy("key").agg(F.collect_list(F.struct(
        "start", (ranks - 1).cast("int").alias("rank"), "end", F.col("b.kind").alias("kind")
    )).alias("added"))
    plain = F.expr("transform(base, m -> named_struct('start', m.start, 'rank', m.rank, 'end', m.end, 'kind', m.kind))")
    return rows.select("key", "doc_id", plain.alias("base")).join(added, "key", "left").select(
        "key", "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", F.expr("slice(base, 1, 0)")))).alias("spans")
    )


def mask_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs`, all columns, with every span in `text` replaced by <KIND>. Overlapping
    spans become one mask, of the first one's kind. Null texts stay null."""
    found = find_personal_data(docs, doc_id, text).where("size(spans) > 0").select(
        F.col("key").alias("__key"), F.col("spans").alias("__spans")
    ).dropDuplicates(["__key"])
    value = f"`{text}`"
    masked = F.expr(
        f"""aggregate(__spans, named_struct('at', 0, 'out', ''), (acc, m) -> named_struct(
          'at', greatest(acc.at, m.end),
          'out', IF(m.start >= acc.at, concat(acc.out, substring({value}, acc.at + 1, m.start - acc.at), '<', upper(m.kind), '>'), acc.out)),
          acc -> concat(acc.out, substring({value}, acc.at + 1)))"""
    )
    keyed = docs.withColumn("__key", text_key(F.col(f"`{doc_id}`"), F.col(value))).join(found, "__key", "left")
    return keyed.withColumn(text, F.when(F.col("__spans").isNull(), F.col(value)).otherwise(masked)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )

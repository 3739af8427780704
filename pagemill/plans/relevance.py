"""Topic and event models, page and link scores."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions.arrays import let_sql, norm, term_counts
from pagemill.functions.dates import date_score, url_date
from pagemill.functions.text import model_tokens, sentences, words
from pagemill.functions.urls import url_text
from pagemill.operators.entities import date_entities, match_phrases
from pagemill.operators.terms import cosine_value, dot_products
from pagemill.session import BROADCAST_ROWS, numbered, settle

# A model of at most this many terms is held as a literal inside the plan.
LITERAL_TERMS = 2_000


def build_topic_model(docs: DataFrame, k: int = fixed.VOCABULARY_SIZE, min_df: int = fixed.MIN_DOCUMENT_FREQUENCY,
                      tokens_col: str = "tokens") -> DataFrame:
    """(term, df, cf, score, weight) of the k best terms. Document frequency,
    collection frequency and centroid mass come from one pass and one shuffle of
    per-term partial sums; a null term counts the documents."""
    rows = docs.select(F.explode(let_sql(
        term_counts(F.col(tokens_col)),
        """c -> get(transform(array(coalesce(array_max(transform(c, x -> x.tf)), 1L)), m -> concat(
          array(named_struct('term', cast(null as string), 'tf', 1L, 'w', 1D)),
          transform(c, x -> named_struct('term', x.term, 'tf', x.tf, 'w', x.tf / m)))), 0)""",
    )).alias("c"))
    sums = rows.groupBy(F.col("c.term").alias("term")).agg(
        F.count("*").alias("df"), F.sum("c.tf").alias("cf"), F.sum("c.w").alias("_mass")
    )
    ranked = (
        sums.filter(F.col("term").isNull() | (F.col("df") >= min_df))
        .withColumn("score", F.col("df") * F.col("cf"))
        .orderBy(F.col("term").isNull().desc(), F.desc("score"), "term")
        .limit(k + 1)
    )
    # k + 1 rows.
    whole = Window.partitionBy(F.lit(0))
    return (
        ranked.withColumn("_n", F.max(F.when(F.col("term").isNull(), F.col("df"))).over(whole))
        .filter(F.col("term").isNotNull())
        .select("term", "df", "cf", "score", (F.col("_mass") / F.col("_n")).alias("weight"))
    )


def cosine_to_model(df: DataFrame, id_col: str, counts_col: str, model: DataFrame, out: str,
                    literal_terms: int = LITERAL_TERMS) -> DataFrame:
    """Add the cosine of each row's term counts with a (term, weight) model. Rows
    stay where they are while the model is small; a larger one is joined by term. Rows
    are matched by a number that each of them gets, so neither route needs `id_col`
    to be unique or there at all."""
    model = settle(model.select("term", "weight"), "cosine-model")
    rows = model.select("term", "weight").limit(literal_terms + 1).collect()
    if len(rows) <= literal_terms:
        weights = {r["term"]: float(r["weight"]) for r in rows}
        return df.withColumn(out, _literal_cosine(F.col(counts_col), weights))
    keyed = numbered(df.withColumn("_norm", norm(F.col(counts_col))), "cosine-rows")
    pair = F.explode(F.transform(counts_col, lambda c: F.struct(c["term"].alias("term"), c["tf"].cast("double").alias("weight"))))
    exploded = keyed.select("_row", pair.alias("c")).select("_row", "c.term", "c.weight")
    model_norm = model.agg(F.sqrt(F.sum(F.col("weight") * F.col("weight")))).first()[0]
    dots = dot_products(exploded, model, "_row").select("_row", F.col("dot").alias("_dot"))
    return keyed.join(dots, "_row", "left").withColumn(
        out, cosine_value(F.coalesce("_dot", F.lit(0.0)), F.col("_norm"), F.lit(model_norm))
    ).drop("_dot", "_norm", "_row")


def _literal_cosine(counts: Column, weights: dict[str, float]) -> Column:
    if not weights:
        return F.lit(0.0)
    length = math.sqrt(sum(w * w for w in weights.values()))
    terms = sorted(weights)
    table = F.map_from_arrays(F.lit(terms), F.lit([weights[t] for t in terms]))
    hits = F.filter(counts, lambda c: c["term"].isin(terms))
    dot = F.aggregate(
        hits, F.lit(0.0), lambda acc, c: acc + c["tf"].cast("double") * F.try_element_at(table, c["term"])
    )
    return cosine_value(dot, norm(counts), F.lit(length))


def page_terms(df: DataFrame, text_col: str = "clean_text", stop=None) -> DataFrame:
    """Add `terms`, the model term counts of the page text."""
    return df.withColumn("terms", term_counts(model_tokens(F.col(text_col), stop)))


def link_terms(df: DataFrame, stop=None) -> DataFrame:
    """Add `terms`, the model term counts of anchor and address."""
    text = url_text(F.coalesce("anchor", F.lit("")), F.col("href"))
    return df.withColumn("terms", term_counts(model_tokens(text, stop)))


class TopicScorer:
    """Base mode: cosine with the topic centroid."""

    def __init__(self, model: DataFrame):
        self.model = settle(model.select("term", "weight"), "topic")

    def page_scores(self, pages: DataFrame, id_col: str = "url") -> DataFrame:
        return cosine_to_model(pages, id_col, "terms", self.model, "score")

    def link_scores(self, links: DataFrame, id_col: str = "link_id") -> DataFrame:
        return cosine_to_model(links, id_col, "terms", self.model, "link_score")


@dataclass
class EventModel:
    topic: DataFrame
    locations: DataFrame  # (term, weight), whole location names
    location_tokens: DataFrame  # (term, weight), their tokens
    event_date: datetime | None


def event_date(dates: DataFrame, column: str = "pub_date") -> datetime | None:
    """Earliest publication date, None without any."""
    return dates.agg(F.min(column)).first()[0]


def date_frequency(dates: DataFrame, column: str = "pub_date") -> DataFrame:
    return dates.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def location_mentions(docs: DataFrame, gazetteer: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      limit: int = BROADCAST_ROWS) -> DataFrame:
    """(id, entity) per LOCATION phrase in the sentences of a text; the longest
    phrase that starts at a word, outside longer ones."""
    units = docs.select(id_col, F.posexplode(sentences(F.col(text_col))).alias("_s", "_sentence"))
    units = units.select(F.struct(id_col, "_s").alias("_unit"), words(F.col("_sentence")).alias("_words"))
    hits = match_phrases(units, "_unit", "_words", gazetteer.filter(F.col("type") == "LOCATION"), limit=limit)
    # Only hits are shuffled; a group is one sentence. A hit stays when no longer
    # one (or an earlier one of the same length) shares a token with it.
    grouped = hits.groupBy("_unit").agg(F.collect_list(F.struct("start", "words", "phrase")).alias("_all"))
    kept = F.expr(
        """filter(_all, h -> NOT exists(_all, o -> o.start < h.start + h.words AND h.start < o.start + o.words
             AND (o.words > h.words OR (o.words = h.words AND o.start < h.start))))"""
    )
    return grouped.select(F.col(f"_unit.{id_col}").alias(id_col), F.explode(kept).alias("h")).select(
        id_col, F.col("h.phrase").alias("entity")
    )


def with_locations(docs: DataFrame, mentions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add `locations`, the counts of a document's own location entities."""
    counted = mentions.groupBy(id_col, "entity").agg(F.count("*").alias("tf"))
    per_doc = counted.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct(F.col("entity").alias("term"), "tf"))).alias("locations")
    )
    empty = F.expr("cast(array() as array<struct<term:string,tf:bigint>>)")
    return docs.join(per_doc, id_col, "left").withColumn("locations", F.coalesce("locations", empty))


def date_mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(id_col, F.explode(F.flatten(F.transform(sentences(F.col(text_col)), date_entities))).alias("entity"))


def entity_counts(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("entity").agg(F.count("*").alias("n"))


def location_weights(mentions: DataFrame, min_count: int = fixed.MIN_LOCATION_COUNT) -> DataFrame:
    """(term, weight): count over the largest count, for entities with at least
    `min_count` mentions."""
    counts = settle(entity_counts(mentions), "locations")
    largest = counts.agg(F.max("n")).first()[0]
    return counts.filter(F.col("n") >= min_count).select(
        F.col("entity").alias("term"), (F.col("n") / F.lit(largest or 1)).alias("weight")
    )


def sorted_locations(weights: DataFrame) -> DataFrame:
    return weights.orderBy(F.desc("weight"), "term")


def location_token_weights(weights: DataFrame, stop=None) -> DataFrame:
    """(term, weight) over the tokens of the locations; shared tokens add up."""
    return weights.select(F.explode(model_tokens(F.col("term"), stop)).alias("term"), "weight").groupBy("term").agg(
        F.sum("weight").alias("weight")
    )


def build_event_model(docs: DataFrame, gazetteer: DataFrame, k: int = fixed.VOCABULARY_SIZE,
                      min_count: int = fixed.MIN_LOCATION_COUNT, id_col: str = "doc_id",
                      mentions: DataFrame | None = None) -> EventModel:
    """Model of seed documents (id, text, tokens, pub_date). Location mentions
    that are already at hand may be passed in."""
    if mentions is None:
        mentions = location_mentions(docs, gazetteer, id_col)
    locations = settle(location_weights(mentions, min_count), "location-weights")
    return EventModel(
        topic=settle(build_topic_model(docs, k), "topic"),
        locations=locations,
        location_tokens=settle(location_token_weights(locations), "location-tokens"),
        event_date=event_date(docs),
    )


def event_score(topic: Column, location: Column, dated: Column, day_score: Column) -> Column:
    """Weighted score. Unknown date: topic and location share the weight. Known
    date outside the window: 0."""
    both = fixed.TOPIC_WEIGHT + fixed.LOCATION_WEIGHT
    return (
        F.when(~dated, fixed.TOPIC_WEIGHT / both * topic + fixed.LOCATION_WEIGHT / both * location)
        .when(day_score == 0, F.lit(0.0))
        .otherwise(fixed.TOPIC_WEIGHT * topic + fixed.LOCATION_WEIGHT * location + fixed.DATE_WEIGHT * day_score)
    )


class EventScorer:
    """Event mode: topic, location and date. Pages carry `terms`, `locations`
    (counts of location entities, null when tagging failed) and `pub_date`."""

    def __init__(self, model: EventModel, event_type: str = "Shooting"):
        self.model, self.event_type = model, event_type

    def _day(self, column: Column) -> Column:
        when = F.lit(self.model.event_date).cast("timestamp")
        return date_score(column, when, self.event_type)

    def with_topic(self, pages: DataFrame, id_col: str = "url") -> DataFrame:
        """Add `_topic`, what `page_scores` needs of `terms`: pages that carry it may go
        into joins without their arrays."""
        return cosine_to_model(pages, id_col, "terms", self.model.topic, "_topic")

    def page_scores(self, pages: DataFrame, id_col: str = "url") -> DataFrame:
        df = pages if "_topic" in pages.columns else self.with_topic(pages, id_col)
        df = cosine_to_model(df, id_col, "locations", self.model.locations, "_location")
        dated = F.col("pub_date").isNotNull()
        day = self._day(F.col("pub_date"))
        score = F.when(dated & (day == 0), F.lit(0.0)).when(F.col("locations").isNull(), F.lit(-1.0)).otherwise(
            event_score(F.col("_topic"), F.col("_location"), dated, day)
        )
        return df.withColumn("score", score).drop("_topic", "_location")

    def link_scores(self, links: DataFrame, id_col: str = "link_id") -> DataFrame:
        df = cosine_to_model(links, id_col, "terms", self.model.topic, "_topic")
        df = cosine_to_model(df, id_col, "terms", self.model.location_tokens, "_location")
        df = df.withColumn("_date", url_date(F.col("href")))
        score = event_score(F.col("_topic"), F.col("_location"), F.col("_date").isNotNull(), self._day(F.col("_date")))
        return df.withColumn("link_score", score).drop("_topic", "_location", "_date")

"""From stored fetches to page records, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions import html as hx
from pagemill.functions import meta as mx
from pagemill.functions import text as tx
from pagemill.functions import urls as ux
from pagemill.functions.porter import stems
from pagemill.operators import entities, lookup
from pagemill.operators.language import LanguageProfiles, detect_language, language_codes
from pagemill.operators.phrases import mask_listed
from pagemill.operators.records import assemble_record, row_key
from pagemill.operators.status import error_mime, fetch_status, is_valid, text_status
from pagemill.operators.tweets import IDS_PER_ROW, event_label, join_tweet_info, tweets_by_url
from pagemill.session import settle, spread
from pagemill.sources.warc import read_warc, response_records


@dataclass(frozen=True)
class CleanOptions:
    phrases: Sequence[str] | DataFrame = ()  # a table (word) for lists of any length
    stop: Sequence[str] | None = None
    collection_name: str = ""
    collection_id: str | None = None
    doc_type: str = fixed.DOC_TYPE
    database: str = fixed.DATABASE
    source: str = fixed.SOURCE
    # User tables; a column stays empty without its table.
    lemmas: DataFrame | None = None
    lexicon: DataFrame | None = None
    gazetteer: DataFrame | None = None
    profiles: LanguageProfiles | None = None
    merge_entities: bool = False
    # Variants.
    engine: str = "native"
    hide_iframe: bool = True
    drop_comments: bool = True
    check_type: bool = True
    ok_code: str = fixed.STATUS_OK
    empty_text_code: str = fixed.STATUS_EMPTY
    meta_guard: str = "attributes"
    og_by_property: bool = True
    mask_after_clean: bool = False
    strict_reference: bool = False
    strict_utf8: bool = False


def extract_pages(fetches: DataFrame, o: CleanOptions = CleanOptions()) -> DataFrame:
    """Fetches plus status_code, mime_type, title, clean_text, meta, links. The
    HTML of a failed fetch is never parsed."""
    if "html" not in fetches.columns:
        fetches = fetches.withColumn("html", hx.decode_utf8(F.col("body"), o.strict_utf8)).drop("body")
    code = fetch_status(
        F.col("url"), F.col("status"), F.col("content_type"), F.col("error"), o.check_type, o.ok_code
    )
    page, bare = F.col("_page"), F.col("_bare")
    # Comments that stay visible must not add links or title text of their own.
    if o.engine == "parser":
        visible = hx.parsed_visible_text(page)
    elif o.drop_comments and o.hide_iframe:
        visible = hx.visible_of(bare)
    else:
        visible = hx.visible_text(page, o.hide_iframe, o.drop_comments)
    parsed = (
        spread(fetches)
        .withColumn("_code", code)
        .withColumn("_page", F.when(is_valid(F.col("_code")), F.col("html")))
        .withColumn("_bare", hx.strip_hidden(page))
        .select(
            "*", hx.title(page).alias("title"), visible.alias("_visible"), mx.meta_tags(page).alias("_tags"),
            hx.links_of(bare).alias("links"),
        )
    )
    texts = parsed.withColumn("clean_text", hx.clean_text(F.col("title"), F.col("_visible")))
    return texts.select(
        *[c for c in fetches.columns if c != "html"], F.col("_page").alias("html"), "title", "clean_text", "links",
        mx.meta_record(F.col("_tags"), o.meta_guard, o.og_by_property).alias("meta"),
        text_status(F.col("_code"), F.col("clean_text"), o.empty_text_code).alias("status_code"),
        error_mime(F.col("url"), F.col("_code"), F.col("content_type")).alias("mime_type"),
    )


def masked_text(df: DataFrame, text: str, phrases: Sequence[str] | DataFrame, out: str) -> DataFrame:
    """Add `out`, the text with a list or a table of phrases masked."""
    if isinstance(phrases, DataFrame):
        return mask_listed(df, text, phrases, out)
    return df.withColumn(out, tx.mask_phrases(F.col(text), phrases))


def clean_flat(fetches: DataFrame, o: CleanOptions = CleanOptions()) -> DataFrame:
    """Flat record columns, one row per fetch, failures included."""
    if "stamp" not in fetches.columns:
        fetches = fetches.withColumn("stamp", F.unix_timestamp("fetch_time").cast("string"))
    pages = extract_pages(fetches, o).withColumn("_id", row_key(F.col("url"), F.col("stamp")))
    df = masked_text(pages, "clean_text", o.phrases, "_masked")
    df = df.withColumn("tokens", tx.tokens(F.col("_masked"), o.stop))
    df = df.withColumn("stemmed", stems(F.col("tokens")))
    no_list = F.lit(None).cast("array<string>")
    if o.lemmas is not None:
        df = lookup.lemmatize(df, "_id", "tokens", o.lemmas)
    else:
        df = df.withColumn("lemmatized", no_list)
    if o.lexicon is not None:
        df = lookup.pos_tags(df, "_id", "tokens", o.lexicon)
    else:
        df = df.withColumn("pos", no_list)
    kinds = {"ner_people": "PERSON", "ner_organization": "ORGANIZATION", "ner_location": "LOCATION"}
    if o.gazetteer is not None:
        df = entities.tag_arrays(df, "_id", "tokens", o.gazetteer, "_ner", cut=lambda c: tx.tokens(c, o.stop))
        pick = entities.merge_phrases if o.merge_entities else entities.tokens_with_tag
        df = df.withColumns({n: pick(F.col("tokens"), F.col("_ner"), t) for n, t in kinds.items()})
    else:
        df = df.withColumns({n: no_list for n in kinds})
    if o.profiles is not None:
        df = detect_language(df, o.profiles, "_id", "clean_text").withColumn("language", language_codes(F.col("languages")))
    else:
        df = df.withColumn("language", no_list)

    # The text rule decides whether a row is a page; failures keep key, mime, status.
    ok = is_valid(F.col("status_code"))
    page = lambda c: F.when(ok, c)
    final_url = ux.clean_url(F.coalesce(F.nullif(F.col("meta.url"), F.lit("")), F.col("url")))
    text = tx.clean_control(F.col("clean_text"))
    if o.mask_after_clean:
        df = masked_text(df.withColumn("_text", text), "_text", o.phrases, "_stored")
    stored_mask = F.col("_stored") if o.mask_after_clean else tx.clean_control(F.col("_masked"))
    name = F.col("collection_name") if "collection_name" in df.columns else F.lit(o.collection_name)
    number = F.col("collection_id") if "collection_id" in df.columns else F.lit(o.collection_id)
    domain = ux.domain_name(F.col("url"))
    always = (lambda c: page(c)) if o.strict_reference else (lambda c: c)
    out = {
        "row_key": row_key(F.when(ok, final_url).otherwise(F.col("url")), F.col("stamp")),
        "doc_type": always(F.lit(o.doc_type)),
        "collection_id": always(number),
        "collection_name": always(name),
        "database": always(F.lit(o.database)),
        "source": always(F.lit(o.source)),
        "url": always(F.when(ok, final_url).otherwise(F.col("url"))),
        "html": page(tx.clean_control(F.col("html"))),
        "language": page(F.col("language")),
        "title": page(tx.clean_control(F.col("title"))),
        "author": page(F.col("meta.author")),
        "organization_name": page(F.col("meta.copyright")),
        "create_time": page(F.col("meta.publish_date")),
        "domain_name": page(domain),
        "domain_location": page(ux.domain_location(domain)),
        "sub_urls": page(hx.sub_urls(F.col("links"), fixed.SUB_URL_PATTERN)),
        "fetch_time": F.col("stamp"),
        "mime_type": F.col("mime_type"),
        "status_code": F.col("status_code"),
        "clean_text": page(text),
        "clean_text_profanity": page(stored_mask),
        "keywords": page(F.col("meta.keywords")),
        "tokens": page(F.col("tokens")),
        "stemmed": page(F.col("stemmed")),
        "lemmatized": page(F.col("lemmatized")),
        "pos": page(F.col("pos")),
        **{n: page(F.col(n)) for n in kinds},
        "real_world_events": page(event_label(name)),
    }
    if "tweet_ids" in df.columns:
        out |= {"tweet_ids": F.col("tweet_ids"), "n_tweets": F.col("n_tweets"), "tweet_url": F.col("url")}
    return df.select(*[c.alias(n) for n, c in out.items()])


def clean_pages(fetches: DataFrame, o: CleanOptions = CleanOptions()) -> DataFrame:
    """Page records with one struct per column family."""
    return assemble_record(clean_flat(fetches, o))


def _tweeted(o: CleanOptions) -> CleanOptions:
    return replace(
        o,
        database=fixed.TWEET_DATABASE if o.database == fixed.DATABASE else o.database,
        source=fixed.TWEET_SOURCE if o.source == fixed.SOURCE else o.source,
    )


def clean_tweet_pages(tweets: DataFrame, fetches: DataFrame, o: CleanOptions = CleanOptions(), seq: str = "seq",
                      ids_per_row: int = IDS_PER_ROW) -> DataFrame:
    """Records of the pages that tweets point to, one for each fetch, with the first
    collection and the first `ids_per_row` tweet ids. All ids, however many, are in
    clean_tweet_tables."""
    return clean_pages(join_tweet_info(fetches, tweets_by_url(tweets, seq, ids_per_row)), _tweeted(o))


def clean_tweet_tables(tweets: DataFrame, fetches: DataFrame, o: CleanOptions = CleanOptions(), seq: str = "seq",
                       ids_per_row: int = IDS_PER_ROW) -> tuple[DataFrame, DataFrame]:
    """(records, ids): the records of clean_tweet_pages, and (row_key, n_tweets, chunk,
    tweet_ids) with all tweet ids of every record in file order. Pages are cleaned
    once, whatever the number of their tweets."""
    by_url = settle(tweets_by_url(tweets, seq, ids_per_row), "tweets-by-url")
    flat = clean_flat(join_tweet_info(fetches, by_url), _tweeted(o))
    keys = flat.select("row_key", F.col("tweet_url").alias("url"))
    return assemble_record(flat), keys.join(by_url, "url").select("row_key", "n_tweets", "chunk", "tweet_ids")


def warc_fetches(records: DataFrame) -> DataFrame:
    """Response records as fetches; the archive date is the row stamp."""
    return response_records(records).select(
        F.col("target_uri").alias("url"), F.lit(200).alias("status"), "content_type", F.col("payload").alias("body"),
        F.col("warc_date").alias("fetch_time"), F.lit(None).cast("string").alias("error"),
        F.date_format("warc_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("stamp"),
    )


def clean_warc(spark, path: str, o: CleanOptions = CleanOptions(), **options) -> DataFrame:
    """Records of a WARC archive: no content-type test, status 3200. `options` go to
    the reader."""
    return clean_pages(
        warc_fetches(read_warc(spark, path, **options)), replace(o, check_type=False, ok_code=fixed.STATUS_WARC)
    )

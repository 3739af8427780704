"""Schemas of the data model."""

from pyspark.sql import types as T

TWEETS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("tweet_id", "collection_id", "collection_name", "url")]
)
URL_HTML = T.StructType([T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])
COLLECTIONS = T.StructType(
    [T.StructField("collection_name", T.StringType()), T.StructField("collection_id", T.StringType())]
)
FETCHES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("fetch_time", T.TimestampType()),
        T.StructField("error", T.StringType()),
    ]
)
WARC_RECORDS = T.StructType(
    [
        T.StructField("warc_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("warc_date", T.TimestampType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("http_content_type", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)

# Column families of the page record, in output order.
METADATA = ["doc_type", "collection_id", "collection_name", "database", "source"]
WEBPAGE = [
    "url", "html", "language", "title", "author", "organization_name", "create_time", "domain_name",
    "domain_location", "sub_urls", "fetch_time", "mime_type", "status_code", "tweet_ids",
]
CLEAN_WEBPAGE = [
    "clean_text", "clean_text_profanity", "keywords", "tokens", "stemmed", "lemmatized", "pos", "ner_people",
    "ner_organization", "ner_location", "real_world_events",
]
FAMILIES = {"metadata": METADATA, "webpage": WEBPAGE, "clean_webpage": CLEAN_WEBPAGE}
SEMICOLON_LISTS = ["sub_urls", "ner_people", "ner_organization", "ner_location"]

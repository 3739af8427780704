"""Tweet collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators.ordering import positions
from pagemill.session import BROADCAST_ROWS, fits, settle

# Tweet ids in one list, at most. Further ids of a URL are in further lists.
IDS_PER_ROW = 100_000


def distinct_urls(df: DataFrame) -> DataFrame:
    return df.select("url").distinct()


def first_collection(tweets: DataFrame, seq: str = "seq") -> DataFrame:
    """Per URL: tweet count and the collection of its first row."""
    return tweets.groupBy("url").agg(
        F.count("*").alias("n_tweets"),
        F.min_by(F.struct("collection_id", "collection_name"), F.col(seq)).alias("_first"),
    ).select("url", "n_tweets", "_first.collection_id", "_first.collection_name")


def id_chunks(tweets: DataFrame, seq: str = "seq", ids_per_row: int = IDS_PER_ROW) -> DataFrame:
    """(url, chunk, tweet_ids): the tweet ids of every URL in file order, in lists of
    `ids_per_row` and a last one with the rest. Tweets are numbered in range
    partitions, so that the tweets of a hot URL are in several tasks and no row has to
    hold them whole."""
    placed = settle(positions(tweets.select("url", "tweet_id", seq), [F.col("url"), F.col(seq)], "_pos"), "tweet-positions")
    firsts = settle(placed.groupBy("url").agg(F.min("_pos").alias("_from")), "tweet-firsts")
    chunk = F.floor((F.col("_pos") - F.col("_from")) / ids_per_row).cast("bigint")
    numbered = placed.join(F.broadcast(firsts) if fits(firsts, BROADCAST_ROWS) else firsts, "url").withColumn("chunk", chunk)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("_pos", "tweet_id"))), lambda s: s["tweet_id"])
    return numbered.groupBy("url", "chunk").agg(ids.alias("tweet_ids"))


def tweets_by_url(tweets: DataFrame, seq: str = "seq", ids_per_row: int = IDS_PER_ROW) -> DataFrame:
    """Every URL with its tweet ids in file order, `ids_per_row` of them in a row
    (`chunk` 0, 1, ...), its number of tweets and the collection of its first one."""
    info = first_collection(tweets, seq)
    return id_chunks(tweets, seq, ids_per_row).join(info, "url").select(
        "url", "chunk", "collection_id", "collection_name", "n_tweets", "tweet_ids"
    )


def join_tweet_info(pages: DataFrame, by_url: DataFrame, url: str = "url") -> DataFrame:
    """Pages with the tweet information of their original URL, one row for each page:
    the number of tweets, the first collection and the first list of ids."""
    info = by_url.where("chunk = 0").select(
        F.col("url").alias(url), "collection_id", "collection_name", "n_tweets", "tweet_ids"
    )
    return pages.join(info, url, "inner")


def event_label(name: Column) -> Column:
    """Collection name without '#'."""
    return F.replace(name, F.lit("#"), F.lit(""))

import gzip

import pytest

from pyspark.sql import functions as F

from pagemill import schemas
from pagemill.operators import records as rc
from pagemill.plans import clean as cl
from pagemill.sinks import files as snk
from pagemill.sources import files as src
from pagemill.sources import warc
from pagemill.streaming import flows


def record(kind, uri, body, http=True):
    if http:
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nWARC-Date: 2017-08-21T10:00:00Z\r\n"
        f"Content-Type: application/http\r\nContent-Length: {len(body)}\r\n\r\n"
    )
    return head.encode() + body + b"\r\n\r\n"


def test_warc_gz_ranges_and_plain(spark, tmp_path):
    bodies = [b"<title>n%d</title><p>caf\xc3\xa9 \xff %s</p>" % (i, b"x" * (i * 37)) for i in range(60)]
    records = [record("request", "http://r", b"GET /", http=False)]
    records += [record("response", f"http://a/{i}", b) for i, b in enumerate(bodies)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "b.warc").write_bytes(b"".join(records))
    for path, split in ((tmp_path / "a.warc.gz", 700), (tmp_path / "a.warc.gz", 1 << 20), (plain, 700)):
        rows = warc.read_warc(spark, str(path), split).collect()
        assert len(rows) == 61
        found = {r.target_uri: bytes(r.payload) for r in rows if r.warc_type == "response"}
        assert found == {f"http://a/{i}": b for i, b in enumerate(bodies)}
    pages = cl.clean_warc(spark, str(tmp_path / "a.warc.gz")).select("row_key", "webpage.*", "clean_webpage.clean_text").collect()
    row = next(r for r in pages if r.url == "http://a/1")
    assert row.row_key == "http://a/1-2017-08-21T10:00:00Z" and row.status_code == "3200"
    assert row.mime_type == "application/http" and "café" in row.clean_text


def test_warc_many_records_in_one_member(spark, tmp_path):
    bodies = [b"x" * n for n in (5, 0, 300_000, 7, 12)]
    records = [
        b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: http://a.example/%d\r\nContent-Length: %d\r\n\r\n" % (i, len(b)) + b + b"\r\n\r\n"
        for i, b in enumerate(bodies)
    ]
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(records[:3])) + gzip.compress(b"".join(records[3:])))
    rows = warc.read_warc(spark, str(tmp_path), 1 << 20).collect()
    assert sorted((r.target_uri[-1], len(r.payload)) for r in rows) == [(str(i), len(b)) for i, b in enumerate(bodies)]


def test_warc_truncation_is_reported(spark, tmp_path):
    head = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: http://a.example/%d\r\nContent-Length: 5\r\n\r\n"
    whole = gzip.compress(head % 0 + b"12345\r\n\r\n")
    (tmp_path / "cut.warc.gz").write_bytes(whole + gzip.compress(head % 1 + b"1"))
    with pytest.raises(Exception, match="1 of 5 bytes"):
        warc.read_warc(spark, str(tmp_path)).collect()
    assert [r.target_uri for r in warc.read_warc(spark, str(tmp_path), truncated="drop").collect()] == ["http://a.example/0"]


def test_warc_write_then_read(spark, tmp_path):
    df = spark.createDataFrame([("http://a", b"<p>1</p>"), ("http://b", b"")], "target_uri string, payload binary").select(
        "target_uri", F.lit("2020-01-01 00:00:00").cast("timestamp").alias("warc_date"), F.lit("text/html").alias("http_content_type"), "payload"
    )
    warc.write_warc(df, str(tmp_path / "out"))
    rows = warc.response_records(warc.read_warc(spark, str(tmp_path / "out"))).collect()
    assert {(r.target_uri, bytes(r.payload), r.http_status) for r in rows} == {("http://a", b"<p>1</p>", 200), ("http://b", b"", 200)}
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_")]


def test_lists_words_tweets(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("http://a\r\n\n http://b \nhttp://c")
    assert [r.url for r in src.read_url_list(spark, str(tmp_path / "urls.txt")).collect()] == ["http://a", "http://b", "http://c"]
    (tmp_path / "words.txt").write_bytes(b"one\r\ntwo words\r\n\r\nlast")
    assert src.word_list(src.read_words(spark, str(tmp_path / "words.txt"))) == ["last", "one", "two words"]
    (tmp_path / "tweets.csv").write_text("1,7,#E,http://a\n2,7,#E,http://b\n")
    rows = src.read_tweets_csv(spark, str(tmp_path / "tweets.csv")).orderBy("seq").collect()
    assert [(r.tweet_id, r.url) for r in rows] == [("1", "http://a"), ("2", "http://b")]
    names = spark.createDataFrame([("E",), ("X",)], "collection_name string")
    known = src.with_collection_id(names, src.collections_table(spark, {"E": "7"})).collect()
    assert {(r.collection_name, r.collection_id) for r in known} == {("E", "7"), ("X", None)}


def test_model_round_trip(spark, tmp_path):
    path = str(tmp_path / "model")
    assert src.load_model(spark, path) is None
    snk.save_model(spark.createDataFrame([("a", 0.5)], "term string, weight double"), path)
    assert src.load_model(spark, path).first().weight == 0.5


def fetches(spark):
    return spark.createDataFrame(
        [("http://a/1", "<title>x\ty</title><p>one, two\n\"three\"</p>", 1), ("http://a/2", "<p>four</p>", 2)], "url string, html string, t bigint"
    ).select("url", "html", F.lit(200).alias("status"), F.lit("text/html").alias("content_type"), F.lit(None).cast("string").alias("error"),
             F.timestamp_seconds("t").alias("fetch_time"))


def test_tsv_round_trip_keeps_columns_and_values(spark, tmp_path):
    record = cl.clean_pages(fetches(spark))
    snk.write_tsv(record, str(tmp_path / "tsv"))
    snk.write_tsv(record, str(tmp_path / "tsv"))
    back = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(str(tmp_path / "tsv"))
    flat = [c for family in schemas.FAMILIES.values() for c in family if c != "tweet_ids"]
    assert back.columns == ["row_key", *flat] and back.count() == 4
    row = back.filter("url = 'http://a/1'").first()
    assert row.clean_text == 'x.y x.y.x.y.one, two."three"' and row.tokens == "x,x,x,one,two,three"  # "y" is a stop word
    assert rc.flatten_record(record).count() == 2


def test_run_counters(spark, tmp_path):
    seen = snk.run_counters(fetches(spark), lambda df: df.write.parquet(str(tmp_path / "t")))
    assert seen["rows"] == 2 and seen["seconds"] > 0


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    table = str(tmp_path / "in")
    fetches(spark).repartition(2).write.parquet(table)
    stream = flows.table_stream(spark, table, fetches(spark).schema, max_files=1)
    for _ in range(2):
        flows.append_stream(flows.clean_stream(stream), str(tmp_path / "out"), str(tmp_path / "ck"), once=True).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("row_key", "tokens").collect()))
    assert got == sorted(map(tuple, cl.clean_flat(fetches(spark)).select("row_key", "tokens").collect()))


def test_first_visits_and_source_counts(spark, tmp_path):
    table = str(tmp_path / "visits")
    rows = spark.createDataFrame([("http://a/1", 1, 1), ("http://a/1", 2, 1), ("http://b/1", 3, 0)], "url string, t bigint, label int")
    rows.withColumn("fetch_time", F.timestamp_seconds("t")).repartition(3).write.parquet(table)
    stream = flows.table_stream(spark, table, spark.read.parquet(table).schema, max_files=1)
    flows.append_stream(flows.first_visits(stream).select("url"), str(tmp_path / "o1"), str(tmp_path / "c1"), once=True).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "o1")).collect()) == ["http://a/1", "http://b/1"]
    flows.update_stream(flows.running_source_counts(stream), str(tmp_path / "o2"), str(tmp_path / "c2"), once=True).awaitTermination()
    versions = spark.read.schema("domain string, rel double, nonrel double, version bigint").parquet(str(tmp_path / "o2"))
    assert {(r.domain, r.rel, r.nonrel) for r in versions.groupBy("domain").agg(F.max("rel").alias("rel"), F.max("nonrel").alias("nonrel")).collect()} == {
        ("a", 3.0, 1.0), ("b", 1.0, 2.0),
    }

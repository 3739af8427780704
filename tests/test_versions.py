"""Upserts by bucket equal one consolidation."""

import os
import random

from pyspark.sql import functions as F

from pagemill.operators.tables import consolidate
from pagemill.operators.versions import VersionedTable


def rows_of(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def test_upserts_equal_one_consolidation(spark, tmp_path):
    rng = random.Random(3)
    make = lambda n, extra: spark.createDataFrame(
        [(f"k{rng.randrange(40)}", i * 3 + rng.randrange(2), f"{extra}{i}") for i in range(n)], f"row_key string, fetch_time long, {extra} string"
    ).dropDuplicates(["row_key", "fetch_time"])
    tables = [make(60, "a"), make(30, "b"), make(50, "a")]
    stored = VersionedTable(spark, str(tmp_path / "t"), buckets=8)
    assert stored.read() is None and stored.compact(0) == []
    for t in tables:
        stored.upsert(t)
    assert stored.upsert(tables[0].limit(0)) == []
    want = rows_of(consolidate(*tables).select("row_key", "fetch_time", "a", "b"))
    assert rows_of(stored.read().select("row_key", "fetch_time", "a", "b")) == want
    assert stored.compact(most=1) and all(len(v) == 1 for v in stored.manifest().parts.values())
    stored.vacuum()
    assert rows_of(stored.read().select("row_key", "fetch_time", "a", "b")) == want
    assert len(os.listdir(tmp_path / "t" / "manifest")) == 1


def test_other_buckets_are_not_read(spark, tmp_path):
    path = tmp_path / "t"
    stored = VersionedTable(spark, str(path), buckets=8)
    all_rows = spark.range(200).select(F.concat(F.lit("k"), "id").alias("row_key"), F.col("id").alias("fetch_time"))
    stored.upsert(all_rows)
    touched = stored.upsert(all_rows.limit(1).withColumn("fetch_time", F.lit(999).cast("long")))
    assert len(touched) == 1
    before = {b: len(v) for b, v in stored.manifest().parts.items()}
    assert before == {b: 2 if b == touched[0] else 1 for b in range(8)}
    # Unreadable files elsewhere do not matter to an upsert, a merge or a bucket's reading.
    other = next(b for b in range(8) if b != touched[0])
    for name in os.listdir(path / "v=1" / f"bucket={other}"):
        (path / "v=1" / f"bucket={other}" / name).write_bytes(b"")
    assert stored.compact(most=1) == touched
    files = {f.split("/")[-2] for f in stored.read(touched).inputFiles()}
    assert files == {f"bucket={touched[0]}"} and stored.read(touched).where("fetch_time = 999").count() == 1


def test_a_version_without_manifest_is_not_there(spark, tmp_path):
    stored = VersionedTable(spark, str(tmp_path / "t"), buckets=2)
    rows = spark.createDataFrame([("a", 1)], "row_key string, fetch_time long")
    stored.upsert(rows)
    stored._write(rows.withColumn("fetch_time", F.lit(7).cast("long")), 2, 2)  # a job that ended before its manifest
    assert stored.read().first().fetch_time == 1
    stored.upsert(rows.withColumn("fetch_time", F.lit(5).cast("long")))
    assert [r.fetch_time for r in stored.read().collect()] == [5]

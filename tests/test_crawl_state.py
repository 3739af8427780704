"""Keyed crawl state: restarts, late rows, expiry; equal to a plain fold."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pagemill.streaming import flows
from pagemill.streaming.state import CHANGES, crawl_state, source_totals, visits_of

START = datetime(2024, 1, 1)
SCHEMA = "url string, fetch_time timestamp, label int"


def feed(spark, root, batches, delay):
    """Each batch arrives while the stream is down; it is started once for each."""
    source = f"{root}/in"
    for k, rows in enumerate(batches):
        rows = [(u, START + timedelta(seconds=t), y) for u, t, y in rows]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = flows.table_stream(spark, source, spark.createDataFrame([], SCHEMA).schema)
        for _ in range(2 if k == 1 else 1):  # the second start finds nothing new
            flows.update_stream(crawl_state(stream, delay, parts=2), f"{root}/out", f"{root}/ck", once=True).awaitTermination()
    changes = spark.read.schema(CHANGES).parquet(f"{root}/out")
    visits = visits_of(changes).select("url", (F.unix_micros("first_visit") / 1e6 - START.timestamp()).cast("long").alias("t"))
    totals = {r.domain: (r.rel - 1, r.nonrel - 1) for r in source_totals(changes).collect()}
    return sorted(map(tuple, visits.collect())), totals


def fold(rows, delay):
    seen, visits, totals = {}, [], {}
    for u, t, y in sorted(rows, key=lambda r: (r[1], -r[2])):
        if u in seen and t < seen[u] + delay:
            continue
        seen[u] = t
        visits.append((u, t))
        rel, non = totals.get(u.split("/")[2], (0, 0))
        totals[u.split("/")[2]] = (rel + y, non + 1 - y)
    return sorted(visits), totals


def test_any_order_within_the_delay_equals_batch(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"http://h{rng.randrange(2)}.org/{rng.randrange(12)}", rng.randrange(500), rng.randrange(2)) for _ in range(90)]
    batches = [rows[:30], rows[30:60], rows[60:]]
    assert feed(spark, tmp_path, batches, "1000 seconds") == fold(rows, 1000)


def test_visits_expire_in_event_time(spark, tmp_path):
    rng = random.Random(2)
    rows = sorted(((f"http://h.org/{rng.randrange(4)}", rng.randrange(400), rng.randrange(2)) for _ in range(80)), key=lambda r: r[1])
    batches = [[r for r in rows if lo <= r[1] < lo + 100] for lo in range(0, 400, 100)]
    visits, totals = feed(spark, tmp_path, batches, "60 seconds")
    assert (visits, totals) == fold(rows, 60) and len(visits) > 12


def test_late_visits_are_dropped(spark, tmp_path):
    on_time = [("http://a.org/1", 1000, 1), ("http://a.org/2", 1005, 0)]
    # The watermark of a batch holds from the next one on.
    late = [("http://a.org/3", 1, 1), ("http://a.org/4", 1100, 0)]
    visits, totals = feed(spark, tmp_path, [on_time, [("http://a.org/1", 1010, 1)], late], "60 seconds")
    assert [u for u, _ in visits] == ["http://a.org/1", "http://a.org/2", "http://a.org/4"] and totals == {"a.org": (1, 2)}

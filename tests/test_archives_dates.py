"""Plain archives at any split size, one file per page, dates in any order."""

import itertools
import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagemill.functions import dates as dx
from pagemill.sinks import files as snk
from pagemill.sinks import pages as pg
from pagemill.sources import warc


def record(uri, body, kind="response"):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    """Records whose bodies hold whole records, as the first, last or only part."""
    rng = random.Random(2)
    root = tmp_path_factory.mktemp("plain")
    want = []
    for name in ("a.warc", "b.warc"):
        data = b""
        for i in range(40):
            fake = record("http://fake/", b"z" * rng.randint(0, 90))
            body = rng.choice([b"", b"x" * rng.randint(1, 3000), fake, b"y\r\n\r\n" + fake[:-4], fake + fake, b"\r\n" * 5, fake[:40]])
            want.append((f"http://{name}/{i}", body))
            data += record(*want[-1])
        (root / name).write_bytes(data)
    return str(root), sorted(want)


@pytest.mark.parametrize("split", [1, 100, 997, 5_000, 1 << 20])
def test_plain_archives_at_any_split(spark, archive, split):
    root, want = archive
    rows = warc.read_warc(spark, root, split).collect()
    assert sorted((r.target_uri, bytes(r.payload)) for r in rows) == want


def test_ranges_begin_with_records(archive):
    root, want = archive
    for name in ("a.warc", "b.warc"):
        data = open(f"{root}/{name}", "rb").read()
        with open(f"{root}/{name}", "rb") as f:
            starts = list(warc._record_starts(f, len(data)))
            assert len(starts) == 40 and all(data.startswith(b"WARC/1.0", s) for s in starts)
            ranges = list(warc._plain_ranges(f, len(data), 700))
        assert [a for a, _ in ranges[1:]] == [b for _, b in ranges[:-1]] and ranges[0][0] == 0 and ranges[-1][1] == len(data)
        assert {a for a, _ in ranges} <= set(starts) and len(ranges) > 5


def test_plain_archives_beside_compressed_ones_and_cut_ones(spark, tmp_path):
    import gzip

    (tmp_path / "a.warc").write_bytes(record("http://a/", b"1") + record("http://b/", b"22")[:-5])
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record("http://c/", b"3")))
    (tmp_path / "c.warc").write_bytes(b"")
    assert sorted(r.target_uri for r in warc.read_warc(spark, str(tmp_path), truncated="drop").collect()) == ["http://a/", "http://c/"]
    with pytest.raises(Exception, match="1 of 2 bytes"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_one_file_per_page(spark, tmp_path):
    rows = [("http://a.org/x?y=1", "one\ntwo"), ("http://b.org/" + "p" * 400, "long"), ("no scheme", "z"), ("http://a.org/x?y=1", "again"), ("http://e/", None)]
    df = spark.createDataFrame(rows, "url string, clean_text string").repartition(3)
    snk.write_page_files(df, str(tmp_path / "out"))
    snk.write_page_files(df.where("clean_text = 'long'").withColumn("clean_text", F.lit("new")), str(tmp_path / "out"))
    found = {n: (tmp_path / "out" / n).read_text() for n in os.listdir(tmp_path / "out")}
    assert len(found) == 3 and found["a.org_x_y=1"] == "again" and found["e_"] == ""
    assert [v for n, v in found.items() if n.startswith("b.org_ppp") and len(n) <= 240] == ["new"]


def test_failed_and_repeated_tasks_leave_nothing(tmp_path):
    writer = pg.PageFileWriter({"path": str(tmp_path / "out")})
    rows = [{"file_name": "a", "text": "1"}, {"file_name": "b", "text": "2"}]
    writer.write(iter(rows))  # an attempt whose result was lost
    writer.commit([writer.write(iter(rows)), None])
    assert sorted(os.listdir(tmp_path / "out")) == ["a", "b"]
    failed = pg.PageFileWriter({"path": str(tmp_path / "out")})
    failed.abort([failed.write(iter([{"file_name": "c", "text": "3"}]))])
    assert sorted(os.listdir(tmp_path / "out")) == ["a", "b"]


def test_dates_in_all_orders(spark):
    """Every order of day, month name and year, every separator, a time before or
    after, with and without am/pm; and numbers alone."""
    when = datetime(2015, 5, 23, 18, 42, 7)
    rows = []
    for month, sep in itertools.product(("%b", "%B"), (" ", "-", "/", ".", "_", ", ")):
        for order in itertools.permutations(("%d", month, "%Y")):
            # A day behind the year needs a day that is no year: 23 is none.
            day = when.strftime(sep.join(order))
            rows += [(day, when.replace(hour=0, minute=0, second=0)), (f"{day} 18:42:07", when), (f"6:42:07 pm {day}", when),
                     (f"{day} 6:42 p.m.", when.replace(second=0)), (f"{day} at 6 PM", when.replace(minute=0, second=0))]
    for numbers in ("%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%Y %d %m", "%m/%d/%Y", "%d/%m/%Y", "%d.%m.%Y", "%m-%d-%y", "%Y%m%d"):
        rows += [(when.strftime(numbers), when.replace(hour=0, minute=0, second=0)), (when.strftime(f"%H:%M:%S {numbers}"), when)]
    junk = ["23 24 25", "May", "May 2015", "12:30", "May 23", "2015", "May 23 2015 x", "May June 2015", "May 40 1999", "13 PM May 23 2015",
            "1 2 3 4", "", "5/23/2015 6:42 6:43", "a" * 500, "9" * 500, None]
    rows += [(j, None) for j in junk]
    df = spark.createDataFrame([(s, str(w) if w else None) for s, w in rows], "s string, want string")
    got = df.select("s", "want", F.date_format(dx.parse_date(F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("got")).collect()
    assert [(r.s, r.got, r.want) for r in got if r.got != r.want] == []

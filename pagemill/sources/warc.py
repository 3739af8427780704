"""WARC archives as a Spark data source (`format("warc")`), read and write.

A `.warc.gz` mostly holds one gzip member per record, so a file is cut into byte
ranges: a task reads the members that start inside its range, and all records of
each. A plain `.warc` file is cut where records begin. One task walks along its
headers for that and skips what is between them by the stated lengths, so text that
looks like a record is never taken for one; the ranges are then read in parallel."""

from __future__ import annotations

import gzip
import uuid
import zlib
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)

from pagemill import schemas

SPLIT_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
_MAGIC = b"\x1f\x8b\x08"
_BLOCK = 1 << 18
_HEADER = 1 << 12  # read at once where a record begins


def _open_fs(path: str):
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _list_files(path: str) -> list[tuple[str, int]]:
    fs, root = _open_fs(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(root, info.size)]
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    return sorted(
        (f.path, f.size)
        for f in found
        if f.type == pafs.FileType.File
        and f.path.endswith((".warc", ".warc.gz"))
        and not f.base_name.startswith(("_", "."))
    )


class TruncatedRecord(ValueError):
    """A record is shorter than it says."""


def _headers(block: bytes) -> tuple[str, dict[str, str]]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    out = {}
    for line in lines[1:]:
        key, _, value = line.partition(":")
        if key.strip():
            out.setdefault(key.strip().lower(), value.strip())
    return lines[0], out


def _row(record: bytes):
    """Record bytes to a row; None when they are not a record."""
    head, _, body = record.partition(b"\r\n\r\n")
    first, fields = _headers(head)
    if not first.startswith("WARC/"):
        return None
    length = int(fields.get("content-length") or len(body))
    if len(body) < length:
        raise TruncatedRecord(f"{fields.get('warc-target-uri')}: {len(body)} of {length} bytes")
    body = body[:length]
    status, http_type, payload = None, None, body
    if body.startswith(b"HTTP/"):
        http_head, _, payload = body.partition(b"\r\n\r\n")
        line, http = _headers(http_head)
        parts = line.split(" ")
        status = int(parts[1]) if len(parts) > 1 and parts[1].isdigit() else None
        http_type = http.get("content-type")
    when = None
    if fields.get("warc-date"):
        try:
            when = datetime.fromisoformat(fields["warc-date"].replace("Z", "+00:00"))
            when = when if when.tzinfo else when.replace(tzinfo=timezone.utc)
        except ValueError:
            when = None
    uri = fields.get("warc-target-uri")
    if uri and uri.startswith("<") and uri.endswith(">"):
        uri = uri[1:-1]
    return (fields.get("warc-type"), uri, when, fields.get("content-type"), status, http_type, payload)


def _is_record_start(stream, at: int) -> bool:
    stream.seek(at)
    try:
        return zlib.decompressobj(31).decompress(stream.read(4096), 5) == b"WARC/"
    except zlib.error:
        return False


def _first_member(stream, start: int, end: int):
    """Offset of the first member that starts in [start, end), or None."""
    at = start
    while at < end:
        stream.seek(at)
        block = stream.read(min(_BLOCK, end - at) + len(_MAGIC) - 1)
        hit = block.find(_MAGIC)
        while hit != -1 and at + hit < end:
            if _is_record_start(stream, at + hit):
                return at + hit
            hit = block.find(_MAGIC, hit + 1)
        at += _BLOCK
    return None


def _member_blocks(stream, at: int):
    """Decompressed blocks of the member at `at`; returns where the next one may
    start, None at the end of the file."""
    stream.seek(at)
    inflate, used = zlib.decompressobj(31), 0
    while not inflate.eof:
        block = stream.read(_BLOCK)
        if not block:
            return None
        used += len(block)
        yield inflate.decompress(block)
    return at + used - len(inflate.unused_data)


def _gz_records(stream, start: int, end: int):
    """Records of the members that start in [start, end), however many each holds."""
    at = 0 if start == 0 else _first_member(stream, start, end)
    while at is not None and at < end:
        blocks = _member_blocks(stream, at)
        following = None

        def walk():
            nonlocal following
            following = yield from blocks

        yield from _records(walk())
        at = following


def _plain_blocks(stream, start: int, end: int):
    stream.seek(start)
    while start < end and (block := stream.read(min(_BLOCK, end - start))):
        start += len(block)
        yield block


def _records(blocks):
    """Records of a stream of blocks. Blocks are taken as records need them; the
    last record is what is left, which `_row` compares with its stated length."""
    held, at = bytearray(), 0

    def more() -> bool:
        block = next(blocks, None)
        if block is None:
            return False
        held.extend(block)
        return True

    while True:
        if at > _BLOCK:
            del held[:at]
            at = 0
        while (len(held) - at >= 2 or more()) and held.startswith(b"\r\n", at):
            at += 2
        looked = at
        while (cut := held.find(b"\r\n\r\n", looked)) == -1:
            looked = max(at, len(held) - 3)
            if not more():
                break
        if cut == -1:
            if held[at:].strip():
                yield bytes(held[at:])
            return
        size = cut + 4 - at + int(_headers(bytes(held[at:cut]))[1].get("content-length") or 0)
        while len(held) - at < size and more():
            pass
        yield bytes(held[at : at + size])
        at = min(at + size, len(held))


_ARROW = pa.schema(
    [
        ("warc_type", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.timestamp("us", tz="UTC")),
        ("content_type", pa.string()), ("http_status", pa.int32()), ("http_content_type", pa.string()),
        ("payload", pa.binary()),
    ]
)


@dataclass
class WarcRange(InputPartition):
    path: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.drop_truncated = options.get("truncated", "fail") == "drop"

    def partitions(self):
        out = []
        for path, size in _list_files(self.path):
            if path.endswith(".gz"):
                out += [WarcRange(path, at, min(at + self.split, size)) for at in range(0, size, self.split)]
        return out or [WarcRange("", 0, 0)]

    def read(self, part):
        if not part.path:
            return
        fs, _ = _open_fs(self.path)
        with fs.open_input_file(part.path) as stream:
            yield from _batches(_gz_records(stream, part.start, part.end), self.drop_truncated)


def _batches(records, drop_truncated: bool):
    """Arrow batches of records."""
    columns, held = [[] for _ in _ARROW], 0
    for record in records:
        try:
            row = _row(record)
        except TruncatedRecord:
            if not drop_truncated:
                raise
            continue
        if row is None:
            continue
        for column, value in zip(columns, row):
            column.append(value)
        held += len(record)
        if held >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
            columns, held = [[] for _ in _ARROW], 0
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _record_starts(stream, size: int):
    """Offsets at which the records of a plain file begin: headers are read, bodies
    are skipped by their stated length."""
    at = 0
    while at < size:
        stream.seek(at)
        held = stream.read(_HEADER)
        blank = 0
        while held.startswith(b"\r\n", blank):
            blank += 2
        if blank:
            at += blank
            continue
        while (cut := held.find(b"\r\n\r\n")) == -1 and (block := stream.read(_BLOCK)):
            held += block
        if held.strip():
            yield at
        if cut == -1:
            return
        at += cut + 4 + int(_headers(held[:cut])[1].get("content-length") or 0)


def _plain_ranges(stream, size: int, split: int):
    """(start, end) of ranges of about `split` bytes that begin with a record."""
    start, due = 0, split
    for at in _record_starts(stream, size):
        if at >= due:
            yield start, at
            start, due = at, (at // split + 1) * split
    if start < size:
        yield start, size


def _read_plain(spark: SparkSession, path: str, files: list[tuple[str, int]], split: int, drop_truncated: bool) -> DataFrame:
    """Records of plain files: a task for each file finds the ranges, then a task for
    each range reads it."""

    def cut(batches):
        fs, _ = _open_fs(path)
        for batch in batches:
            for name, size in zip(batch["path"].to_pylist(), batch["size"].to_pylist(), strict=True):
                with fs.open_input_file(name) as stream:
                    ranges = list(_plain_ranges(stream, size, split))
                yield pa.RecordBatch.from_pydict(
                    {"path": pa.array([name] * len(ranges), pa.string()), "start": pa.array([a for a, _ in ranges], pa.int64()),
                     "end": pa.array([b for _, b in ranges], pa.int64())}
                )

    def read(batches):
        fs, _ = _open_fs(path)
        for batch in batches:
            for name, start, end in zip(*(batch[c].to_pylist() for c in ("path", "start", "end")), strict=True):
                with fs.open_input_file(name) as stream:
                    yield from _batches(_records(_plain_blocks(stream, start, end)), drop_truncated)

    ranges = spark.createDataFrame(files, "path string, size bigint").repartition(len(files), "path").mapInArrow(
        cut, "path string, start bigint, end bigint"
    )
    n = sum(size // max(split, _BLOCK) + 1 for _, size in files)  # ranges below one block share tasks
    return ranges.repartition(n, "path", "start").mapInArrow(read, schemas.WARC_RECORDS)


@dataclass
class WarcPart(WriterCommitMessage):
    temporary: str
    final: str


def _record_bytes(row) -> bytes:
    """A response record with a `200 OK` status line."""
    http_type = row["http_content_type"] or "text/html; charset=utf-8"
    payload = bytes(row["payload"] or b"")
    http = f"HTTP/1.0 200 OK\r\nContent-Type: {http_type}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    when = row["warc_date"] or datetime(1970, 1, 1)
    if when.tzinfo is not None:
        when = when.astimezone(timezone.utc)
    head = (
        "WARC/1.0\r\n"
        "WARC-Type: response\r\n"
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
        f"WARC-Target-URI: {row['target_uri']}\r\n"
        f"WARC-Date: {when.strftime('%Y-%m-%dT%H:%M:%S')}Z\r\n"
        "Content-Type: application/http; msgtype=response\r\n"
        f"Content-Length: {len(http)}\r\n\r\n"
    ).encode()
    return head + http + b"\r\n\r\n"


class WarcWriter(DataSourceWriter):
    """One `.warc.gz` (or plain `.warc`) per partition; files appear under their final name only
    when the whole job commits, so a retried task leaves nothing behind."""

    def __init__(self, options, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.plain = options.get("compression", "gzip") == "none"

    def write(self, iterator):
        from pyspark import TaskContext

        fs, root = _open_fs(self.path)
        fs.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId() if context else 0:05d}-{uuid.uuid4().hex}.warc{'' if self.plain else '.gz'}"
        temporary = f"{root}/_{name}.tmp"
        with fs.open_output_stream(temporary, compression=None) as out:
            for row in iterator:
                record = _record_bytes(row)
                out.write(record if self.plain else gzip.compress(record))
        return WarcPart(temporary, f"{root}/{name}")

    def commit(self, messages):
        fs, _ = _open_fs(self.path)
        for part in messages:
            if part is not None:
                fs.move(part.temporary, part.final)

    def abort(self, messages):
        fs, _ = _open_fs(self.path)
        for part in messages:
            if part is not None:
                fs.delete_file(part.temporary)


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return schemas.WARC_RECORDS

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def full_path(spark: SparkSession, path: str) -> str:
    """`path` with the scheme of the session's default file system, as Spark itself
    would read it; local only if that is."""
    home = spark.conf.get("spark.hadoop.fs.defaultFS", "file:///") or "file:///"
    if "://" in path or path.startswith("file:") or home.startswith("file:"):
        return path
    return home.rstrip("/") + "/" + path.lstrip("/")


def read_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, truncated: str = "fail") -> DataFrame:
    """All records of the archives under `path`. A record that is cut off fails the
    job, or is left out with truncated="drop"."""
    spark.dataSource.register(WarcSource)
    path = full_path(spark, path)
    reader = spark.read.format("warc").option("splitbytes", split_bytes).option("truncated", truncated)
    listed = _list_files(path)
    plain = [f for f in listed if not f[0].endswith(".gz")]
    if not plain:
        return reader.load(path)
    rows = _read_plain(spark, path, plain, split_bytes, truncated == "drop")
    return rows if len(plain) == len(listed) else rows.unionByName(reader.load(path))


def response_records(records: DataFrame) -> DataFrame:
    return records.filter(F.col("warc_type") == "response")


def write_warc(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write target_uri, warc_date, http_content_type, payload as archives, compressed
    or plain (compression="none")."""
    df.sparkSession.dataSource.register(WarcSource)
    df.select(
        F.lit("response").alias("warc_type"), "target_uri", "warc_date", F.lit(None).cast("string").alias("content_type"),
        F.lit(200).alias("http_status"), "http_content_type", "payload",
    ).write.format("warc").option("compression", compression).mode("append").save(full_path(df.sparkSession, path))

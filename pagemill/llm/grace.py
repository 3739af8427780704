"""Exact deduplication by Grace hashing.

Two texts are equal when they are the same without white space. Every task first
folds the copies it meets itself; what is left is dealt by hash into buckets. The
task of a bucket compares complete contents in an open-addressing table of bounded
size. Contents that find no room are written out as they are, and those spill files
are dealt again, by another hash, until every content has had its place in a table."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.session import settle

SPACES = " \t\n\v\f\r"
# Bytes of content a table may hold. Buckets are cut to half of it on average.
TABLE_BYTES = 128 << 20
# A task folds its own copies in windows of this many bytes of different content.
WINDOW_BYTES = 32 << 20
# Records of one hash that one bucket takes; hotter hashes are folded in salted
# buckets first. At most HOT hashes are told apart that way in one level, so that
# the list may be broadcast; the others have a share of at most 1 / HOT each.
MERGE = 256
HOT = 65_536


class ContentTable:
    """Open addressing over 64-bit hashes with linear probing; a slot is a match
    only if the complete contents are equal."""

    def __init__(self):
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.held = 0

    def probe(self, key: int, content: bytes) -> tuple[int, int]:
        """(entry, slot): the entry that equals `content`, or -1 and the free slot."""
        slots, hashes, contents = self.slots, self.hashes, self.contents
        mask = len(slots) - 1
        at = key & mask
        while (entry := slots[at]) >= 0:
            if hashes[entry] == key and contents[entry] == content:
                return entry, at
            at = (at + 1) & mask
        return -1, at

    def add(self, at: int, key: int, content: bytes) -> int:
        """Fill the free slot `at`."""
        entry = self.slots[at] = len(self.contents)
        self.hashes.append(key)
        self.contents.append(content)
        self.held += len(content)
        if 2 * len(self.contents) > len(self.slots):
            self.grow()
        return entry

    def grow(self) -> None:
        mask = 4 * len(self.slots) - 1
        slots = [-1] * (mask + 1)
        for entry, key in enumerate(self.hashes):
            at = key & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = entry
        self.slots = slots


def fold_own(rows: DataFrame, window: int = WINDOW_BYTES) -> DataFrame:
    """rows(..., hash, content) with `local`, which rows of one task share if their
    contents are equal, and `content` on the first of them only. Written."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        table = ContentTable()
        for batch in batches:
            local, content = [], []
            for key, value in zip(batch["hash"].to_pylist(), batch["content"].to_pylist(), strict=True):
                entry, at = table.probe(key, value)
                content.append(value if entry < 0 else None)
                local.append(first + (table.add(at, key, value) if entry < 0 else entry))
            arrays = [pa.array(content, pa.binary()) if n == "content" else batch[n] for n in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(local, pa.int64())], names=[*names, "local"])
            if table.held > window or len(table.contents) > 1 << 16:
                first += len(table.contents)
                table = ContentTable()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return settle(rows.mapInArrow(run, f"{schema}, local bigint"), "grace-rows")


def fill_tables(dealt: DataFrame, room: int) -> DataFrame:
    """dealt(id, hash, content, fold) to (id, to, hash, content). Records that met a
    table have `to`, the id of the content's first record there. Records without
    room, and the entries of tables that only fold, keep their content and have no
    `to`: they are the spill files.

    Once a content is refused, so are all its later copies, for room only shrinks;
    no copy of it was in the table before. So equal contents never part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, owner, again = ContentTable(), [], []

        def rows(ids, to, keys, contents):
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(to, pa.int64()), pa.array(keys, pa.int64()), pa.array(contents, pa.binary())
            ], names=["id", "to", "hash", "content"])

        for batch in batches:
            met, spilled = [], []
            columns = (batch[n].to_pylist() for n in ("id", "hash", "content", "fold"))
            for own, key, content, fold in zip(*columns, strict=True):
                entry, at = table.probe(key, content)
                if entry >= 0:
                    met.append((own, owner[entry], None, None))
                elif not owner or table.held + len(content) <= room:
                    entry = table.add(at, key, content)
                    owner.append(own)
                    if fold:
                        again.append(entry)
                    else:
                        met.append((own, own, None, None))
                else:
                    spilled.append((own, None, key, content))
            if met or spilled:
                yield rows(*zip(*met, *spilled, strict=True))
        for entry in again:
            yield rows([owner[entry]], [None], [table.hashes[entry]], [table.contents[entry]])

    return dealt.mapInArrow(run, "id bigint, to bigint, hash bigint, content binary")


def deal(records: DataFrame, level: int, parts: int, n: int, merge: int = MERGE) -> DataFrame:
    """records(id, hash, content) dealt into `parts` buckets by a hash of the level,
    with `fold` where copies of one hash are spread over salted buckets first."""
    least = max(merge, n // HOT)
    hot = settle(records.groupBy("hash").count().where(F.col("count") > least).select(
        "hash", F.ceil(F.col("count") / merge).alias("salts")
    ), "grace-hot")
    salted = records.join(F.broadcast(hot), "hash", "left").select(
        "id", "hash", "content", F.col("salts").isNotNull().alias("fold"),
        F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", F.lit(level)), "salts")).alias("salt"),
    )
    return salted.repartition(parts, F.xxhash64("hash", F.lit(level)), "salt").drop("salt")


def classes(records: DataFrame, room: int = TABLE_BYTES, merge: int = MERGE) -> DataFrame:
    """records(id, hash, content), written, to (id, cls): equal for equal contents."""
    spark = records.sparkSession
    todo, links = records, []
    while True:
        size = todo.agg(F.count("*").alias("n"), F.sum(F.octet_length("content")).alias("bytes")).first()
        if size["n"] == 0 and links:
            break
        parts = max(spark.sparkContext.defaultParallelism, ceil((size["bytes"] or 0) / (room / 2)))
        out = settle(fill_tables(deal(todo, len(links), parts, size["n"], merge), room), f"grace-level-{len(links)}")
        links.append(out.where("to IS NOT NULL").select("id", "to"))
        todo = out.where("to IS NULL").select("id", "hash", "content")
    known = links.pop().withColumnRenamed("to", "cls")
    while links:
        step = links.pop().join(known.select(F.col("id").alias("to"), "cls"), "to", "left")
        known = settle(step.select("id", F.coalesce("cls", "to").alias("cls")).unionByName(known), "grace-classes")
    return known


def find_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None, room: int = TABLE_BYTES, merge: int = MERGE
) -> DataFrame:
    """One row per row of `docs`: (row, doc_id, keep_id, group_size, kept,
    text_sha256). Texts are equal when they are the same without SPACES; null counts
    as empty, and empty texts are equal too. Of each group one row is kept: most code
    points in the text as it was, then least doc_id (null last), then any one of
    equal rows. text_sha256 is of the text without SPACES. `row` names a column of
    whole numbers that tells rows apart; without it they are numbered here. Other
    columns are not read."""
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    bare = F.translate(value, SPACES, "")
    rows = docs.select(
        (F.col(f"`{row}`") if row else F.monotonically_increasing_id()).cast("long").alias("row"), F.col(f"`{doc_id}`").alias("doc_id"),
        F.length(value).cast("long").alias("n_chars"), F.unhex(F.sha2(bare.cast("binary"), 256)).alias("sha"),
        F.xxhash64(bare).alias("hash"), bare.cast("binary").alias("content"),
    )
    written = fold_own(rows)
    records = written.where("content IS NOT NULL").select(F.col("local").alias("id"), "hash", "content")
    known = classes(records, room, merge).withColumnRenamed("id", "local")
    # Copies of a hot text are many rows but few `local`s in a task, and only those
    # move to the class; the rows take its result back by `local`.
    order = F.struct((-F.col("n_chars")).alias("low"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    own = written.groupBy("local").agg(F.min(order).alias("best"), F.count("*").alias("n"))
    of_class = settle(known.join(own, "local"), "grace-locals")
    best = of_class.groupBy("cls").agg(F.min("best").alias("best"), F.sum("n").alias("group_size"))
    result = of_class.select("local", "cls").join(best, "cls").select("local", "best", "group_size")
    return written.select("row", "doc_id", "sha", "local").join(result, "local").select(
        "row", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs`, all columns, with the kept row of each group of equal texts (see
    find_copies)."""
    row = "__row"
    written = settle(docs.withColumn(row, F.monotonically_increasing_id()), "grace-docs")
    kept = find_copies(written, doc_id, text, row=row).where("kept").select(F.col("row").alias(row))
    return written.join(kept, row, "left_semi").drop(row)

"""Repeated passages by content-defined chunking.

A gear rolling hash over the last GEAR_BYTES bytes ends a chunk wherever its value
is the lowest within REACH bytes on either side. Chunks so depend on the text
nearby only, an insertion shifts none but its neighbours, and none is short. Chunks with a digest that several documents have are repeated;
runs of repeated chunks that are long enough are reported, and all but the first
copy of each chunk can be removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.session import settle

GEAR_BYTES = 16
REACH = 16  # a chunk has 2 * REACH + 1 bytes on average, and more than REACH
# Periodic text repeats its lowest value. A stretch this long without a cut is cut
# at values below these, one after the other, APART bytes or more apart.
STRETCH, APART = 128, 8
STRETCH_VALUES = (6_553, 13_107, 26_214)
LONGEST = 4_096
LEAST_WORDS = 20  # of a run
# One number for each byte value, from a fixed rule.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=20) for b in range(256)], np.uint32).astype(np.uint16)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def gear_values(data: np.ndarray) -> np.ndarray:
    """h = 2 h + gear[byte] modulo 2^16 at every byte: sixteen bytes count. Sums of
    1, 2, 4 and 8 bytes are doubled."""
    h = GEAR[data]
    step = 1
    while step < GEAR_BYTES:
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint16(step)
        h = h + shifted
        step *= 2
    return h


def lowest(values: np.ndarray) -> np.ndarray:
    """True where a value is below the REACH values before it and not above the
    REACH after it. Running minima over 1, 2, 4, ... and REACH values."""
    n = len(values)
    most = np.full(REACH, 1 << 16, np.int32)
    padded = np.concatenate([most, values, most])
    low, width = padded, 1
    while width < REACH:
        step = min(width, REACH - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    return (values < low[:n]) & (values <= low[REACH + 1 : REACH + 1 + n])


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text's bytes (the last one is its length)."""
    if not len(data):
        return np.zeros(0, np.int64)
    values = gear_values(data)
    ends = np.union1d(np.flatnonzero(lowest(values)) + 1, [len(data)])
    for low in STRETCH_VALUES:
        sizes = np.diff(ends, prepend=0)
        more = []
        for end, size in zip(ends[sizes > STRETCH].tolist(), sizes[sizes > STRETCH].tolist()):
            last = end - size
            for at in (np.flatnonzero(values[last:end] < low) + last + 1).tolist():
                if at - last >= APART:
                    more.append(at)
                    last = at
        if more:
            ends = np.union1d(ends, more)
    sizes = np.diff(ends, prepend=0)
    if sizes.max() > LONGEST:
        ends = np.concatenate([np.append(np.arange(e - n + LONGEST, e, LONGEST), e) for e, n in zip(ends, sizes)])
    return ends


def chunk_text(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digests, places, new): a place packs start (code points), length (code
    points, 14 bits) and word starts (13 bits); new says that the digest was not
    met before in the text."""
    raw = (text or "").encode("utf-8", "replace")
    data = np.frombuffer(raw, np.uint8)
    ends = cuts(data)
    digests = np.fromiter(
        (xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())), np.uint64, len(ends)
    ).view(np.int64)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[ends] if len(ends) else ends
    blank = BLANK[data]
    word = ~blank
    word[1:] &= blank[:-1]
    words = np.diff(np.cumsum(word)[ends - 1], prepend=0) if len(ends) else ends
    lengths = np.diff(points, prepend=0)
    places = ((points - lengths) << 27) | (lengths << 13) | words
    new = np.zeros(len(ends), bool)
    new[np.unique(digests, return_index=True)[1]] = True
    return digests, places, new


def chunk_rows(docs: DataFrame) -> DataFrame:
    """docs(rid, doc_id, text) to (rid, doc_id, digest, place, new), one row per chunk."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                done = [chunk_text(t) for t in part.column(2).to_pylist()]
                rows = np.repeat(np.arange(len(done)), [len(d[0]) for d in done])
                if not len(rows):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows)),
                        *[pa.array(np.concatenate([d[k] for d in done])) for k in range(3)],
                    ],
                    ["rid", "doc_id", "digest", "place", "new"],
                )

    return docs.select("rid", "doc_id", "text").mapInArrow(run, f"rid long, doc_id {kind}, digest long, place long, new boolean")


def repeated_chunks(docs: DataFrame, doc_id: str, text: str, least_words: int) -> DataFrame:
    """(rid, doc_id, start, length, words, pair, run): chunks in runs of at least
    `least_words` words whose chunks all occur in several rows of `docs`. `pair`
    is the digest of a chunk with the one before it in the run (of the first one
    with the next): short chunks also meet by chance, two in a row hardly. Written."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    chunks = settle(chunk_rows(rows), "chunks")
    shared = chunks.where("new").groupBy("digest").agg(F.count("*").alias("holders")).where("holders > 1").select("digest")
    found = chunks.select("rid", "digest", "place").join(shared, "digest").select(
        "rid", "digest", F.expr("place >> 27").alias("start"), F.expr("(place >> 13) & 16383").alias("length"),
        F.expr("place & 8191").alias("words"),
    )
    order = Window.partitionBy("rid").orderBy("start", "length")
    found = found.withColumn(
        "breaks", (F.coalesce(F.lag(F.expr("start + length")).over(order), F.lit(-1)) != F.col("start")).cast("int")
    ).withColumn("run", F.sum("breaks").over(order))
    found = found.withColumn("total", F.sum("words").over(Window.partitionBy("rid", "run")))
    within = Window.partitionBy("rid", "run").orderBy("start", "length")
    pair = F.coalesce(
        F.when(F.lag("digest").over(within).isNotNull(), F.xxhash64(F.lag("digest").over(within), "digest")),
        F.xxhash64("digest", F.lead("digest").over(within)),
    )
    found = found.where(F.col("total") >= least_words).withColumn("pair", pair)
    ids = chunks.where("place < 134217728").select("rid", "doc_id").distinct()  # first chunks
    return settle(found.join(ids, "rid").select("rid", "doc_id", "start", "length", "words", "pair", "run"), "runs")


def with_first(found: DataFrame) -> DataFrame:
    """`found` with the least (doc_id, rid, start) among the copies of each chunk."""
    first = found.groupBy("pair").agg(F.min(F.struct("doc_id", "rid", "start")).alias("first"))
    return found.join(first, "pair")


def find_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Repeated passages: (doc_id, start, end, n_words, n_chunks, n_new, first_doc_ids).

    One row per maximal run of chunks that other rows have too, of least_words
    words or more, code points, end exclusive. first_doc_ids are the documents that
    have its chunks first (least doc_id, then earliest), n_new how many of its
    chunks have their first copy here. A chunk counts as repeated if two rows have
    it, also rows with equal ids; repetition inside one text alone does not count.
    Null and empty texts have no chunks."""
    chunks = with_first(repeated_chunks(docs, doc_id, text, least_words))
    here = (F.col("first.rid") == F.col("rid")) & (F.col("first.start") == F.col("start"))
    return chunks.groupBy("rid", "doc_id", "run").agg(
        F.min("start").alias("start"), F.max(F.expr("start + length")).alias("end"), F.sum("words").alias("n_words"),
        F.count("*").alias("n_chunks"), F.count_if(here).alias("n_new"),
        F.array_sort(F.collect_set("first.doc_id")).alias("first_doc_ids"),
    ).drop("rid", "run")


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """`docs`, all columns, with the repeated chunks of every passage cut out of
    `text` except where they stand first. Rows stay, also emptied ones. Rows are
    numbered once and written, since the cut needs the same numbers again."""
    numbered = settle(docs.withColumn("__rid", F.monotonically_increasing_id()), "numbered")
    value = f"`{text}`"
    plain = numbered.select(F.col("__rid").alias("doc_id"), F.col(value).alias("text"), F.col(f"`{doc_id}`").alias("own"))
    found = repeated_chunks(plain.select("doc_id", "text"), "doc_id", "text", least_words).join(
        plain.select("doc_id", "own"), "doc_id"
    )
    first = found.groupBy("pair").agg(F.min(F.struct("own", "doc_id", "start")).alias("first"))
    later = found.join(first, "pair").where("first.doc_id <> doc_id OR first.start <> start")
    gone = later.groupBy(F.col("doc_id").alias("__rid")).agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("__gone"))
    kept = F.expr(
        f"""aggregate(__gone, named_struct('at', 0L, 'out', ''), (acc, g) -> named_struct(
          'at', g.start + g.length, 'out', concat(acc.out, substring({value}, CAST(acc.at + 1 AS INT), CAST(g.start - acc.at AS INT)))),
          acc -> concat(acc.out, substring({value}, CAST(acc.at + 1 AS INT))))"""
    )
    joined = numbered.join(gone, "__rid", "left")
    return joined.withColumn(text, F.when(F.col("__gone").isNull(), F.col(value)).otherwise(kept)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )

"""Compression bands: text is kept when its zstandard ratio, over the whole
document and over its fixed chunks, lies between limits for its length. Below the
band a text repeats itself, above it the text is noise."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = 3
WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
# (bytes from, lowest ratio, highest ratio) of whole documents. Short texts carry
# frame overhead and compress little, so their band is wide.
BANDS = ((0, 0.0, 9.0), (128, 0.25, 1.1), (256, 0.25, 0.95), (512, 0.25, 0.82), (1024, 0.22, 0.74), (4096, 0.20, 0.68))
CHUNK = 1024
CHUNK_BAND = (0.20, 0.74)
# Share of full chunks that may lie outside their band.
CHUNK_SHARE = 0.25

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "ratio double, n_chunks long, n_bad_chunks long, kept boolean"
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that occur at least twice. Window
    hashes find the candidates, the words themselves decide."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order][1:] == rolled[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    seen: dict[tuple, list[int]] = {}
    for i in at.tolist():
        seen.setdefault(tuple(words[i : i + WINDOW]), []).append(i)
    edge = np.zeros(len(words) + 1, np.int64)
    for found in seen.values():
        if len(found) > 1:
            starts = np.array(found)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def ratio_verdict(data: bytes, compress) -> tuple[float, int, int, bool]:
    """(ratio of the whole, full chunks, chunks outside their band, kept)."""
    if not data:
        return 0.0, 0, 0, True
    ratio = len(compress(data)) / len(data)
    low, high = next((lo, hi) for start, lo, hi in reversed(BANDS) if len(data) >= start)
    n = len(data) // CHUNK
    bad = 0
    for i in range(n):
        part = len(compress(data[i * CHUNK : (i + 1) * CHUNK])) / CHUNK
        bad += not CHUNK_BAND[0] <= part <= CHUNK_BAND[1]
    return ratio, n, bad, low <= ratio <= high and bad <= CHUNK_SHARE * n


def measure(text: str | None, compress) -> tuple:
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()  # of bytes: space, tab, line feed, vertical tab, form feed, return
    chars = len(text) - sum(text.count(c) for c in SPACES)
    lines = [x for x in re.split("\n", text) if x.strip(SPACES)]
    repeated = repeated_words(words)
    failed = len(words) < 20 or 100 * repeated > 30 * len(words)
    ratio, n, bad, kept = ratio_verdict(data, compress)
    return (
        len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated, failed,
        ratio, n, bad, kept and not failed,
    )


def add_bands(docs: DataFrame, text: str = "text", out: str = "bands") -> DataFrame:
    """`docs` with a struct column `out` (FIELDS): counts over the whole text, its
    compression ratios and the verdict `kept`. A null text counts as empty (no
    words, base_failed, ratio 0). A column named `out` is replaced. No rows move."""
    names = [f.split()[0] for f in FIELDS.split(", ")]

    @F.pandas_udf(FIELDS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compress = zs.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False).compress
        for texts in batches:
            yield pd.DataFrame([measure(t, compress) for t in texts], columns=names)

    return docs.withColumn(out, run(F.col(f"`{text}`")))

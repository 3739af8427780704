"""Quality classifier by compression.

Two zstandard dictionaries are built, one from well-labelled and one from badly
labelled text. A text is compressed in fixed pieces with either one; the
difference of the two sizes over the text's own size says which kind of text it
resembles, and a logistic curve fitted on other labelled rows turns that into a
probability. Pieces keep long texts from outgrowing the dictionary."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pagemill.llm.common import first_by_hash, fit_logistic, learning_text, one_label

PIECE = 512
LEVEL = 3
DICTIONARY_BYTES = 32_768
# Bounds of the labelled sample. Texts are used whole; longer ones than LEARN_BYTES
# by a window (they are scored whole like any other).
DICTIONARY_DOCS = 1_500
CALIBRATION_DOCS = 3_000
LEARN_BYTES = 65_536


def pieces(data: bytes) -> list[bytes]:
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


def build_dictionary(texts: list[str]) -> bytes:
    """Dictionary from the pieces of `texts`; their plain end when there are too
    few pieces for training, empty without text."""
    parts = [p for t in texts for p in pieces(t.encode())]
    try:
        return zs.train_dictionary(DICTIONARY_BYTES, parts, k=64, d=8).as_bytes()
    except zs.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


@dataclass(frozen=True)
class CompressionModel:
    """good, bad: dictionaries; weights: of the logistic curve (see `inputs`)."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def sizer(self) -> Callable[[str | None], tuple[float, float]]:
        """Text to (normalised size difference, bytes)."""
        packers = []
        for raw in (self.good, self.bad):
            shared = zs.ZstdCompressionDict(raw) if raw else None
            if shared:
                shared.precompute_compress(level=LEVEL)
            packers.append(
                zs.ZstdCompressor(
                    level=LEVEL, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False
                ).compress
            )
        good, bad = packers

        def size(text: str | None) -> tuple[float, float]:
            data = (text or "").encode("utf-8", "replace")
            if not data:
                return 0.0, 0.0
            diff = sum(len(bad(p)) - len(good(p)) for p in pieces(data))
            return diff / len(data), float(len(data))

        return size


def inputs(diff: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A short text says little: the difference also counts by how much of one
    full piece the text fills."""
    full = np.minimum(1.0, size / PIECE)
    return np.column_stack([np.ones_like(diff), diff * 20, full, diff * 20 * full])


def fit(docs: DataFrame, labelled: DataFrame) -> CompressionModel:
    """docs(doc_id, text); labelled(doc_id, label 0/1): the rows to learn from.

    At most DICTIONARY_DOCS + CALIBRATION_DOCS rows of each label are used, those
    whose ids hash lowest; the first part makes the dictionary and the rest the
    curve, weighted by the labels' frequency among all labelled rows. Without
    both labels the curve is the (smoothed) share of good rows."""
    labelled = one_label(labelled)
    counts = {int(r["label"]): r["count"] for r in labelled.groupBy("label").count().collect()}
    n_each = DICTIONARY_DOCS + CALIBRATION_DOCS
    texts: dict[int, list[str]] = {0: [], 1: []}
    for label in (0, 1):
        ids = first_by_hash(labelled.where(F.col("label") == label), "doc_id", n_each)
        rows = (
            docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most n_each ids
            .where("text IS NOT NULL").select("doc_id", learning_text("text", "doc_id", LEARN_BYTES).alias("text"))
            .groupBy("doc_id").agg(F.min("text").alias("text"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").collect()
        )
        texts[label] = [r["text"] for r in rows]
    split = {k: min(DICTIONARY_DOCS, len(v) // 2) for k, v in texts.items()}
    model = CompressionModel(build_dictionary(texts[1][: split[1]]), build_dictionary(texts[0][: split[0]]), ())
    size = model.sizer()
    rows = [(*size(t), label, counts[label] / len(texts[label][split[label]:])) for label in (0, 1)
            for t in texts[label][split[label]:]]
    if len({r[2] for r in rows}) < 2:
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return CompressionModel(model.good, model.bad, (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    data = np.array(rows, float)
    weight = data[:, 3] / data[:, 3].mean()
    return CompressionModel(
        model.good, model.bad, tuple(float(w) for w in fit_logistic(inputs(data[:, 0], data[:, 1]), data[:, 2], weight))
    )


def score(docs: DataFrame, model: CompressionModel, text: str = "text", out: str = "score") -> DataFrame:
    """`docs` with the probability of good text in `out` (0 to 1). The whole text
    counts; a null text is an empty one, which gets the curve's value at nought.
    A column named `out` is replaced; all others stay. No rows move."""

    @F.pandas_udf(DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        size = model.sizer()
        w = np.array(model.weights)
        for texts in batches:
            sizes = np.array([size(t) for t in texts], float).reshape(-1, 2)
            yield pd.Series(1 / (1 + np.exp(-np.clip(inputs(sizes[:, 0], sizes[:, 1]) @ w, -30, 30))))

    return docs.withColumn(out, run(F.col(f"`{text}`")))

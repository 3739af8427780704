"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n. A null id has no fold and
    belongs to the learning side only if it has a label, which it cannot."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def held_out(doc_id: Column, n: int, rest: int) -> Column:
    return F.coalesce(fold(doc_id, n) == rest, F.lit(False))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only the named columns, so that further columns of the input cannot clash
    with the ones an operator makes."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def first_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows whose keys hash lowest: a bounded sample that does not depend
    on the order or the partitioning of the rows. Keys are narrow; each task
    keeps at most n of them."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(n)


def one_label(labelled: DataFrame) -> DataFrame:
    """labelled(doc_id, label) with each doc_id once. Rows without id or label are left
    out; of an id with both labels the lesser one counts, whatever the order of rows."""
    known = labelled.where("doc_id IS NOT NULL AND label IS NOT NULL")
    return known.groupBy("doc_id").agg(F.min("label").alias("label"))


def learning_text(text: str, key: str, most: int) -> Column:
    """A text for a bounded learning sample: whole up to `most` bytes; of a longer one
    a window of a quarter as many characters, at a place its key decides."""
    room = F.length(text) - most // 4
    window = F.substring(F.col(text), F.pmod(F.xxhash64(key), F.greatest(room, F.lit(1))).cast("int") + 1, F.lit(most // 4))
    return F.when(F.octet_length(text) <= most, F.col(text)).otherwise(window)


# A table may be broadcast only when its own bytes, measured on the written rows,
# stay below this bound; beyond it the same join shuffles.
BROADCAST_BYTES = 16 << 20


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: strings by length, arrays by elements, the rest flat."""
    total = F.lit(16)
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind == "array":
            total = total + F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0))
        else:
            total = total + 8
    return total


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """`df`, a written table, with a broadcast hint if its measured bytes allow.
    The rows of a join do not depend on it."""
    size = df.select(F.sum(row_bytes(df)).alias("n")).first()["n"] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def text_key(*columns: Column) -> Column:
    """16 bytes that tell rows apart by the given columns (null and empty differ)."""
    parts = [F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts).cast("binary")))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Newton steps on the weighted log-likelihood with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w

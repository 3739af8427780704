"""Embedding whitening by polarisation.

The covariance of a sum holds the covariance of its parts: cov(a, b) is half of
var(a + b) - var(a) - var(b). So only squares of centred values are aggregated, for
every dimension and every sum of two dimensions, in whole numbers and exactly; the
differences give all covariances, which are put together for `eigh`."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.session import settle

SCALE = 256
LIMIT = float(1 << 40)  # scaled entries beyond it count as it
COMPONENTS = 4
HALF = 32
WIDE = pa.decimal128(38, 0)


def fixed_point(vector: Column) -> Column:
    """array<long>: floor(SCALE * entry). Null if the vector is null or has no entry,
    or one that is null or not finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))).cast("long"))
    return F.when((F.size(vector) > 0) & ~bad, whole)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def centre(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums: whole numbers, of Python's kind where 64 bits would not do."""
    if len(x) and n * int(np.abs(x).max()) + max(abs(int(s)) for s in sums) >= 1 << 61:
        return x.astype(object) * n - sums
    return x * n - sums.astype(np.int64)


def square_sums(z: np.ndarray) -> np.ndarray:
    """Exact sums of squares by column, as Python numbers. Values are taken in halves
    of 32 bits, and so are the products, so that no sum of fewer than 2^30 rows
    leaves 64 bits."""
    if z.dtype == object or not len(z):
        return (z.astype(object) ** 2).sum(axis=0)

    def total(p):
        return (p >> HALF).sum(axis=0).astype(object) * (1 << HALF) + (p & ((1 << HALF) - 1)).sum(axis=0).astype(object)

    z = np.abs(z)
    if int(z.max()) < 1 << 31:
        return total(z * z)
    high, low = z >> 31, z & ((1 << 31) - 1)
    return total(high * high) * (1 << 62) + total(high * low) * (1 << 32) + total(low * low)


def totals(df: DataFrame, width: int, of) -> dict[tuple[int, int], int]:
    """Exact totals of `of(x)`, which yields (i, [(j, value), ...]) of a batch of
    vectors, summed by task and then by (i, j). The result has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, values in of(matrix(batch["x"], width)):
                held[i] = held[i] + values if i in held else values
        for i, values in held.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([i] * len(values), pa.int32()), pa.array(range(len(values)), pa.int32()), pa.array([Decimal(int(v)) for v in values], WIDE)
            ], names=["i", "j", "total"])

    parts = df.select("x").mapInArrow(run, "i int, j int, total decimal(38,0)")
    return {(r["i"], r["j"]): int(r["total"]) for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}


@dataclass(frozen=True)
class Whitening:
    """n vectors with `sums`; components (rows of `axes`, unit length) by falling
    eigenvalue; share of the trace; error of the whitened covariance."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    @property
    def width(self) -> int:
        return len(self.sums)

    def usable(self) -> np.ndarray:
        """Components with variance; the others cannot be brought to unit length."""
        return self.eigenvalues > self.width * np.finfo(float).eps * max(self.eigenvalues[0], 0)

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centred whole numbers, whitened values; nan without variance)."""
        y = centre(x, self.n, self.sums)
        scale = np.sqrt(np.where(self.usable(), self.eigenvalues, np.nan))
        return y, (y.astype(float) / self.n) @ self.axes.T / scale


def covariance(fit: DataFrame, width: int, n: int, sums: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of fit(x), from squares alone."""

    def squares(x: np.ndarray):
        y = centre(x, n, sums)
        for i in range(width):
            rest = y[:, i : i + 1] + y[:, i + 1 :]
            yield i, square_sums(np.concatenate([y[:, i : i + 1], rest], axis=1))

    found = totals(fit, width, squares)
    own = [found[i, 0] for i in range(width)]
    v = np.empty((width, width))
    for i in range(width):
        v[i, i] = own[i] / n**3
        for j in range(i + 1, width):
            v[i, j] = v[j, i] = (found[i, j - i] - own[i] - own[j]) / (2 * n**3)
    return v


def whitened_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of whitened fit(x) minus the identity,
    over the usable components: summed over the vectors, not taken from V."""
    use = np.flatnonzero(model.usable())
    if not len(use):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(use), len(use) + 1))
        for batch in batches:
            w = model.apply(matrix(batch["x"], model.width))[1][:, use]
            held += np.concatenate([w.T @ w, w.sum(axis=0)[:, None]], axis=1)
        i, j = np.indices(held.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(held.ravel())], names=["i", "j", "total"])

    sums = np.zeros((len(use), len(use) + 1))
    for r in fit.select("x").mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        sums[r["i"], r["j"]] = r["total"] / model.n
    mean = sums[:, -1]
    return float(np.abs(sums[:, :-1] - np.outer(mean, mean) - np.eye(len(use))).max())


def fit_whitening(vectors: DataFrame, embedding: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Whitening from the distinct fixed-point vectors of `vectors`. Vectors without
    fixed point (see fixed_point) are left out, and those that have not the commonest
    width among distinct ones (the larger of two as common). None without vectors.
    Squares have to sum to less than 10^38."""
    fit = settle(vectors.select(fixed_point(F.col(f"`{embedding}`")).alias("x")).where("x IS NOT NULL").distinct(), "fit-list")
    widths = fit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if widths is None:
        return None
    width, n = widths["width"], widths["count"]
    fit = fit.where(F.size("x") == width)
    found = totals(fit, width, lambda x: [(0, x.sum(axis=0).astype(object))])
    sums = np.array([found[0, i] for i in range(width)], object)
    values, axes = np.linalg.eigh(covariance(fit, width, n, sums))
    order = np.argsort(-values, kind="stable")[:components]
    axes = axes.T[order]
    axes = axes * np.sign(axes[np.arange(len(order)), np.abs(axes).argmax(axis=1)])[:, None]
    trace = values.sum()
    shares = values[order] / trace if trace > 0 else np.full(len(order), np.nan)
    model = Whitening(n, sums, axes, values[order], shares)
    return Whitening(n, sums, axes, values[order], shares, whitened_error(fit, model))


def whiten(vectors: DataFrame, model: Whitening | None, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector and component: (vec_id, component from 1, n, deviation,
    whitened, explained, identity_error). Rows whose vector is left out by
    fit_whitening's rules have none; repeated rows give repeated results. deviation
    is exact, decimal(38,0). whitened is null for a component without variance, and
    explained, identity_error where nothing varies."""
    x = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), fixed_point(F.col(f"`{embedding}`")).alias("x"))
    if model is None:
        return x.where("x IS NOT NULL").select(
            "vec_id", F.lit(1).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("deviation"),
            *[F.lit(None).cast("double").alias(c) for c in ("whitened", "explained", "identity_error")],
        ).limit(0)

    def run(column: pa.Array) -> pa.Array:
        y, w = model.apply(matrix(column, model.width))
        if y.dtype != object and len(y) and int(np.abs(y).max()) ** 2 * model.width < 1 << 63:
            deviation = pa.array((y * y).sum(axis=1), pa.int64()).cast(WIDE)
        else:
            deviation = pa.array([Decimal(int(v)) for v in (y.astype(object) ** 2).sum(axis=1)], WIDE)
        flat = pa.array(w.ravel(), pa.float64(), from_pandas=True)  # nan becomes null
        ends = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
        return pa.StructArray.from_arrays([deviation, pa.ListArray.from_arrays(ends, flat)], names=["deviation", "whitened"])

    made = F.arrow_udf(run, "struct<deviation decimal(38,0), whitened array<double>>")
    share = F.array(*[F.lit(float(s) if np.isfinite(s) else None).cast("double") for s in model.explained])
    rows = x.where(F.size("x") == model.width).select("vec_id", made("x").alias("m"))
    return rows.select("vec_id", "m.deviation", F.posexplode("m.whitened").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("k")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    )

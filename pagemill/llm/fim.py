"""Fill-in-the-middle by displacement scatter.

The cuts of a batch of texts are found in one scan over its bytes. Every run of
bytes that moves together has one displacement; a difference array holds the change
of displacement where runs begin, its cumulative sum gives every byte its place, and
one scatter writes the outputs. The same displacements, read from an output's own
sentinels, gather the texts back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
# Sentinels, three bytes each, and the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = range(3)
FORMS = ("plain", "psm", "spm")
PLAIN_PERCENT, SPM_PERCENT = 50, 80  # h3 from here on is plain; h4 below is spm
# Bytes scattered at once, which bounds the arrays of places.
WINDOW = 4 << 20

SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\v\f\r")] = True


def draws(doc_id: Column, seed: int = SEED) -> Column:
    """32 bytes that decide a document's cuts and form: sha256 of `seed:doc_id`. A
    null id counts as no digits."""
    return F.unhex(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; nulls are empty."""
    texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def text_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def scan_sentinels(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, document) of every sentinel inside one document's bytes."""
    at = np.flatnonzero(data[:-2] == PREFIX[0]) if len(data) > 2 else np.zeros(0, np.int64)
    at = at[(data[at + 2] == PREFIX[2]) & np.isin(data[at + 1], [PREFIX[1], SUFFIX[1], MIDDLE[1]])]
    doc = np.searchsorted(offsets, at, "right") - 1
    inside = at + 3 <= offsets[doc + 1]
    return at[inside], doc[inside]


def scan_cuts(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, low, high): tokens of each text and the places of its two cuts. A token is
    a run of other bytes with the white space before it; white space at the end of a
    text is one too. Bytes of longer code points are never white space."""
    space = SPACE[data]
    ends = ~space
    ends[:-1] &= space[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends[last] = True
    inner = np.flatnonzero(ends) + 1
    before = np.searchsorted(inner, offsets[:-1], "right")
    n = np.searchsorted(inner, offsets[1:], "right") - before
    cuts = np.sort(np.stack([first % (n + 1), second % (n + 1)]), axis=0)
    places = np.concatenate([inner, [0]])
    low, high = (np.where(k == 0, offsets[:-1], places[np.minimum(before + k, len(inner)) - 1]) for k in cuts)
    return n, low, high


def displace(offsets: np.ndarray, low: np.ndarray, high: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, shifts, out, marks): where the three runs of every text begin, how far
    each moves, the offsets of the outputs, and the places of <P>, <S>, <M> there."""
    begin, end = offsets[:-1], offsets[1:]
    moved = form != PLAIN
    out = np.concatenate([[0], np.cumsum(end - begin + 9 * moved)])
    head, tail = low - begin, end - high
    at = out[:-1]
    prefix = np.where(form == PSM, at, at + 3 + tail)
    suffix = np.where(form == PSM, at + 3 + head, at)
    middle = at + 6 + head + tail
    targets = np.stack([prefix + 3, middle + 3, suffix + 3], 1)
    plain = np.stack([at, at + low - begin, at + high - begin], 1)
    starts = np.stack([begin, low, high], 1)
    shifts = np.where(moved[:, None], targets, plain) - starts
    return starts.ravel(), shifts.ravel(), out, np.stack([prefix, suffix, middle], 1)[moved]


def places(starts: np.ndarray, shifts: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, place of every byte between them), window by window: the cumulative
    sum of a difference array."""
    for lo in range(0, n, WINDOW):
        hi = min(lo + WINDOW, n)
        i, j = np.searchsorted(starts, [lo, hi - 1], "right")
        change = np.zeros(hi - lo, np.int64)
        change[0] = lo + shifts[i - 1]
        change[1:] = 1
        np.add.at(change, starts[i:j] - lo, np.diff(shifts[i - 1 : j]))
        yield lo, hi, np.cumsum(change)


def scatter(data: np.ndarray, offsets: np.ndarray, low: np.ndarray, high: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the outputs."""
    starts, shifts, out, marks = displace(offsets, low, high, form)
    made = np.empty(out[-1], np.uint8)
    for lo, hi, place in places(starts, shifts, len(data)):
        made[place] = data[lo:hi]
    for column, mark in enumerate((PREFIX, SUFFIX, MIDDLE)):
        for k, byte in enumerate(mark):
            made[marks[:, column] + k] = byte
    return made, out


def gather(made: np.ndarray, out: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts from the outputs and their forms alone. Raises if
    an output has not the three sentinels of its form."""
    at, doc = scan_sentinels(made, out)
    moved = np.flatnonzero(form != PLAIN)
    at = at[form[doc] != PLAIN]
    if len(at) != 3 * len(moved) or not np.array_equal(doc[form[doc] != PLAIN], np.repeat(moved, 3)):
        raise ValueError("an output lacks a sentinel of its form")
    one, two, three = at.reshape(-1, 3).T
    length = np.diff(out) - 9 * (form != PLAIN)
    offsets = np.concatenate([[0], np.cumsum(length)])
    low, high = offsets[:-1].copy(), offsets[1:].copy()
    psm = form[moved] == PSM
    head = np.where(psm, two - one, three - two) - 3
    tail = np.where(psm, three - two, two - one) - 3
    low[moved] += head
    high[moved] -= tail
    starts, shifts, _, _ = displace(offsets, low, high, form)
    text = np.empty(offsets[-1], np.uint8)
    for lo, hi, place in places(starts, shifts, len(text)):
        text[lo:hi] = made[place]
    return text, offsets


def chars_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before each of the places `at`, in order, counted window by window."""
    out, total = np.zeros(len(at), np.int64), 0
    for lo in range(0, len(data), WINDOW):
        part = np.cumsum((data[lo : lo + WINDOW] & 0xC0) != 0x80)
        i, j = np.searchsorted(at, [lo + 1, lo + len(part) + 1])
        out[i:j] = total + part[at[i:j] - lo - 1]
        total += int(part[-1])
    return out


def transform(texts: pa.Array, drawn: pa.Array) -> pa.Array:
    """Arrow arrays of texts and draws to the struct of `add_middle`."""
    data, offsets = text_bytes(texts)
    h = np.frombuffer(b"".join(drawn.to_pylist()), ">u4").reshape(-1, 8)[:, :4].astype(np.int64)
    n, low, high = scan_cuts(data, offsets, h[:, 0], h[:, 1])
    form = np.where(h[:, 3] % 100 < SPM_PERCENT, SPM, PSM)
    form[(h[:, 2] % 100 >= PLAIN_PERCENT) | (np.diff(offsets) == 0)] = PLAIN
    form[scan_sentinels(data, offsets)[1]] = PLAIN
    made, out = scatter(data, offsets, low, high, form)
    chars = chars_before(data, np.stack([offsets[:-1], low, high], 1).ravel()).reshape(-1, 3)
    plain = form == PLAIN
    return pa.StructArray.from_arrays([
        text_array(made, out), pa.array(np.array(FORMS, object)[form], pa.string()), pa.array(n, pa.int64()),
        pa.array(chars[:, 1] - chars[:, 0], pa.int64(), mask=plain), pa.array(chars[:, 2] - chars[:, 1], pa.int64(), mask=plain),
    ], names=["output", "form", "n", "prefix_chars", "middle_chars"])


def add_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "fim", seed: int = SEED) -> DataFrame:
    """`docs` with a struct column `out`: output, form (plain, psm, spm), n (tokens),
    prefix_chars, middle_chars (code points; null if plain). Null texts count as
    empty and stay plain, as do texts that hold a sentinel. Rows of equal id and text
    have equal results. A column named `out` is replaced. No rows move."""
    run = F.arrow_udf(transform, "struct<output string, form string, n bigint, prefix_chars bigint, middle_chars bigint>")
    return docs.withColumn(out, run(F.col(f"`{text}`"), draws(F.col(f"`{doc_id}`"), seed)))


def restored(output: Column, form: Column) -> Column:
    """The text that became `output` under `form`. Nulls give empty texts."""

    def run(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        made, out = text_bytes(outputs)
        codes = np.array([FORMS.index(f) if f else PLAIN for f in forms.to_pylist()], np.int64)
        return text_array(*gather(made, out, codes))

    return F.arrow_udf(run, "string")(output, form)

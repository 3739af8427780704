"""Packing documents into training sequences by vector bin packing.

A document's ids and one end id are placed as whole pieces or cut. A piece asks
for three things at once: tokens, one segment, and tokens that bear loss; a
sequence has a limit on each. Pieces go to the open sequence whose remaining
room points the same way as their needs (largest dot product of the two vectors,
each in shares of the limits). When too many sequences are open, the fullest is
filled up with the head of the piece in hand and closed.

Each task packs its own documents and keeps a bounded number of sequences open,
so memory does not grow with the input. What is open at a task's end is joined
into full sequences and a rest whose lengths are powers of two."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
LIMITS = (4096, 512, 4096)  # tokens, segments, loss-bearing tokens of a sequence
OPEN = 16
CACHE = 800_000  # chunks of text whose ids a worker keeps
BATCH_IDS = 1 << 20

FIELDS = (
    "doc_id {id}, start long, length long, doc_tokens long, sequence_id long, offset long, loss_tokens long, ids binary"
)

# A chunk takes the short way only if it is made of these characters; there
# normalising is plain lower-casing and splitting is by this pattern. All other
# chunks go through the whole tokenizer.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
# Blanks for Python that are characters for the vocabulary.
ODD_BLANKS = re.compile("[\x1c-\x1f]").search
BLANKS = re.compile(r"[^\S\x1c-\x1f]+").split


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for the 256 bytes: printable
    ones stand for themselves, the others follow from code point 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Chunks(dict):
    """Number of every chunk met, with its ids kept one after the other. A new
    chunk is encoded when it is first asked for."""

    def __init__(self, whole: Tokenizer, letters: dict[int, str]):
        super().__init__()
        self.whole, self.model, self.letters = whole, whole.model, letters
        self.words: dict[str, tuple[int, ...]] = {}
        self.new_ids: list[int] = []
        self.new_sizes: list[int] = []
        self.flat = np.zeros(0, np.uint32)
        self.first = np.zeros(1, np.int64)

    def __missing__(self, chunk: str) -> int:
        before = len(self.new_ids)
        if PLAIN(chunk) and "<|" not in chunk:
            for word in SPLIT(chunk.lower()):
                ids = self.words.get(word)
                if ids is None:
                    spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                    ids = self.words[word] = tuple([t.id for t in self.model.tokenize(spelled)])
                self.new_ids += ids
        else:
            self.new_ids += self.whole.encode(chunk, add_special_tokens=False).ids
        self.new_sizes.append(len(self.new_ids) - before)
        at = self[chunk] = len(self)
        return at

    def settle(self) -> None:
        """Moves the ids of new chunks to the arrays."""
        if self.new_sizes:
            self.flat = np.concatenate([self.flat, np.array(self.new_ids, np.uint32)])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.array(self.new_sizes, np.int64))])
            self.new_ids, self.new_sizes = [], []


class WordTokenizer:
    """Ids of whole texts with the vocabulary at `path`. The vocabulary never joins
    across blanks, so what stands between them is looked up once and remembered."""

    def __init__(self, path: str | None = None):
        self.whole = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        self.letters = byte_letters()
        self.chunks = Chunks(self.whole, self.letters)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.chunks) > CACHE:
            self.chunks = Chunks(self.whole, self.letters)
        places = []
        for t in texts:
            chunks = [c for c in BLANKS(t) if c] if ODD_BLANKS(t) else t.split()
            places.append(np.fromiter(map(self.chunks.__getitem__, chunks), np.int64, len(chunks)))
        self.chunks.settle()
        first, flat = self.chunks.first, self.chunks.flat
        out = []
        for at in places:
            begin = first[at]
            size = first[at + 1] - begin
            shift = np.cumsum(size) - size
            out.append(flat[np.repeat(begin - shift, size) + np.arange(int(size.sum()))])
        return out


class Packer:
    """Open sequences of one task. Pieces leave as (piece, sequence, offset) when
    their sequence is closed."""

    def __init__(self, limits=LIMITS, open_limit: int = OPEN):
        self.limits = np.array(limits, float)
        self.open_limit = open_limit
        self.used = np.zeros((0, 3))
        self.held: list[list[tuple]] = []
        self.next_id = 0
        self.done: list[tuple] = []

    def _close(self, k: int) -> None:
        self._emit(self.held.pop(k))
        self.used = np.delete(self.used, k, 0)

    def _emit(self, pieces: list[tuple]) -> None:
        at = 0
        for p in pieces:
            self.done.append((*p, self.next_id, at))
            at += p[2]
        self.next_id += 1

    def _put(self, k: int, piece: tuple, need: np.ndarray) -> None:
        self.held[k].append(piece)
        self.used[k] += need
        # Full in tokens or out of segments or loss: nothing more can go in.
        if (self.limits - self.used[k] < 1).any() and self.used[k, 0] >= self.limits[0]:
            self._close(k)

    def add(self, doc, length: int, loss: np.ndarray | None = None) -> None:
        """Places tokens 0 .. length of a document; `doc` is carried along. Where
        `loss` is given it marks the tokens that bear loss, else all do."""
        total = None if loss is None else np.concatenate([[0], np.cumsum(loss)])
        bears = (lambda a, b: b - a) if total is None else (lambda a, b: int(total[b] - total[a]))
        start = 0
        while start < length:
            size = min(length - start, int(self.limits[0]))
            size = self._fit_loss(bears, start, size)
            need = np.array([size, 1, bears(start, start + size)], float)
            room = self.limits - self.used
            fits = (room >= need).all(1)
            if fits.any():
                score = (room / self.limits) @ (need / self.limits)
                # Least room left among equals keeps sequences filling up.
                score[~fits] = -1
                k = int(score.argmax())
            elif len(self.held) < self.open_limit:
                k = self._open()
            else:
                # Fill the sequence that has most tokens with the piece's head.
                k = int(self.used[:, 0].argmax())
                size = min(size, int(room[k, 0])) if room[k, 1] >= 1 else 0
                size = self._fit_loss(bears, start, size, int(room[k, 2])) if size else 0
                if not size:
                    self._close_short(k)
                    continue
                need = np.array([size, 1, bears(start, start + size)], float)
                self._put(k, (doc, start, size, int(need[2])), need)
                start += size
                if k < len(self.held) and self.used[k, 0] < self.limits[0] and (self.limits - self.used[k] < 1).any():
                    self._close_short(k)
                continue
            self._put(k, (doc, start, size, int(need[2])), need)
            start += size

    def _open(self) -> int:
        self.held.append([])
        self.used = np.vstack([self.used, np.zeros(3)])
        return len(self.held) - 1

    def _fit_loss(self, bears, start: int, size: int, most: int | None = None) -> int:
        """Longest head within `size` whose loss-bearing tokens keep the limit."""
        most = int(self.limits[2]) if most is None else most
        if bears(start, start + size) <= most:
            return size
        low, high = 0, size
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if bears(start, start + mid) <= most else (low, mid - 1)
        return low

    def _close_short(self, k: int) -> None:
        """Closes a sequence that is not full, cut into lengths that need no padding."""
        pieces = self.held.pop(k)
        self.used = np.delete(self.used, k, 0)
        self._emit_powers(pieces)

    def _emit_powers(self, pieces: list[tuple]) -> None:
        left = sum(p[2] for p in pieces)
        queue = list(reversed(pieces))
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            part = []
            while room:
                doc, start, size, loss = queue.pop()
                take = min(size, room)
                part.append((doc, start, take, loss if take == size else None))
                if take < size:
                    queue.append((doc, start + take, size - take, None))
                room -= take
            self._emit(part)

    def finish(self) -> None:
        """Joins the open sequences into full ones and a rest without padding. A
        joined sequence keeps the limits on segments and loss."""
        pieces = [p for held in self.held for p in held]
        self.held, self.used = [], np.zeros((0, 3))
        part, used = [], np.zeros(3)
        queue = list(reversed(pieces))
        while queue:
            doc, start, size, loss = queue.pop()
            room = self.limits - used
            if room[1] < 1 or room[2] < (loss or 0) and part:
                self._emit_powers(part)
                part, used, room = [], np.zeros(3), self.limits.copy()
            take = min(size, int(room[0]))
            if take < size and loss not in (None, size):
                # Where loss is uneven a piece stays whole.
                self._emit_powers(part)
                part, used, take = [], np.zeros(3), size
            borne = loss if take == size else take
            part.append((doc, start, take, borne))
            used += (take, 1, borne or 0)
            if take < size:
                queue.append((doc, start + take, size - take, size - take))
            if used[0] >= self.limits[0]:
                self._emit(part)
                part, used = [], np.zeros(3)
        self._emit_powers(part)

    def take(self) -> list[tuple]:
        out, self.done = self.done, []
        return out


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limits=LIMITS, vocabulary: str | None = None, turns: str | None = None
) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, doc_tokens, sequence_id,
    offset, loss_tokens, ids). `ids` are the piece's token ids, little-endian
    unsigned 32 bits. A null text is an empty one and has the end id alone. Rows are
    packed one by one, so repeated rows are packed repeatedly. sequence_id is unique;
    its high part is the task.

    Every token bears loss, unless `turns` names a column of instruction data,
    array<struct<text string, loss boolean>>: a document is then its turns, each
    encoded for itself, and the tokens of the turns with `loss` bear it; the end id
    does if the last turn does. Null turns, texts and flags are empty, empty, false."""
    kind = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 36
        tokenizer = shared_tokenizer(vocabulary)
        packer = Packer(limits)
        id_type = None

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            docs_, starts, sizes, _, sequences, offsets = zip(*pieces)
            data = [d[1][s : s + n].tobytes() for d, s, n in zip(docs_, starts, sizes)]
            losses = [n if d[2] is None else int(d[2][s : s + n].sum()) for d, s, n in zip(docs_, starts, sizes)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([d[0] for d in docs_], id_type), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array([len(d[1]) for d in docs_], pa.int64()), pa.array([task + s for s in sequences], pa.int64()),
                    pa.array(offsets, pa.int64()), pa.array(losses, pa.int64()), pa.array(data, pa.binary()),
                ],
                names,
            )

        def encoded(values: list) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
            """(ids, mask of the tokens that bear loss; None: all)."""
            if turns is None:
                for ids in tokenizer.encode([t or "" for t in values]):
                    yield np.append(ids, np.uint32(END_ID)).astype("<u4"), None
                return
            parts = [[t for t in v or [] if t is not None] for v in values]
            flat = iter(tokenizer.encode([t["text"] or "" for v in parts for t in v]))
            for v in parts:
                ids = [next(flat) for _ in v]
                flags = [bool(t["loss"]) for t in v]
                mask = np.repeat([*flags, flags[-1] if flags else False], [*map(len, ids), 1])
                yield np.concatenate([*ids, [END_ID]]).astype("<u4"), mask

        for batch in batches:
            id_type = batch.schema.field(0).type
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                for key, (ids, mask) in zip(part.column(0).to_pylist(), encoded(part.column(1).to_pylist())):
                    packer.add((key, ids, mask), len(ids), mask)
                pieces = packer.take()
                if pieces:
                    yield rows(pieces)
        packer.finish()
        pieces = packer.take()
        if pieces:
            yield rows(pieces)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{turns or text}`").alias("text")).mapInArrow(
        run, FIELDS.format(id=kind.simpleString())
    )


_TOKENIZERS: dict[str | None, WordTokenizer] = {}


def shared_tokenizer(vocabulary: str | None) -> WordTokenizer:
    """One tokenizer, with what it remembers, for all tasks of a Python worker."""
    if vocabulary not in _TOKENIZERS:
        _TOKENIZERS[vocabulary] = WordTokenizer(vocabulary)
    return _TOKENIZERS[vocabulary]

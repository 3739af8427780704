"""Language identification by segmentation-marginalised unigrams.

Every language has its own probabilities over the pieces of one fixed public
vocabulary. The probability of a word is the sum over all its segmentations into
pieces (forward algorithm); a text's is the product over its words. Piece
probabilities are learned by expectation maximisation (forward-backward)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import first_by_hash, learning_text

VOCABULARY = "piece_bpe_32k.model"
MAX_PIECE = 8  # letters of the longest piece used, with the word mark
MAX_WORD = 48  # longer runs of letters are scored in parts of this length
ROUNDS = 3
SMOOTHING = 0.01
TINY = 1e-100  # sums below this are rescaled
# Bounds of the learning sample: the documents whose ids hash lowest, whole texts up
# to LEARN_BYTES and a window of longer ones.
DOCS_PER_LANGUAGE = 300
LEARN_BYTES = 65_536
CACHE = 400_000  # chunks whose scores a task keeps
SLICE = 256  # documents split into chunks at a time

MARK = "▁"
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def public_pieces(path: str | None = None) -> list[str]:
    """Pieces of letters, lower-cased, of the vocabulary at `path`, and a mark."""
    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in found if len(p) <= MAX_PIECE and (p.lstrip(MARK).isalpha() or p == MARK))


class Pieces:
    """Piece numbers of all substrings of words. A piece is packed into one
    integer (16 bits per letter, two parts) and found in a sorted table; a letter
    of no piece is piece `unknown`."""

    def __init__(self, pieces: list[str]):
        self.names = pieces
        self.unknown = len(pieces)
        keys = np.array([self._key(np.array([[ord(c) for c in p]], np.int64))[0] for p in pieces], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        # A direct table in front of the sorted one: most substrings are no piece.
        self.bits = 20
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[self._slot(self.keys)] = True

    @staticmethod
    def _key(codes: np.ndarray) -> np.ndarray:
        key = np.full(len(codes), codes.shape[1], np.uint64)
        for j in range(codes.shape[1]):
            key = (key ^ codes[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Piece numbers of the rows of `codes`; -1 where there is none."""
        keys = self._key(codes)
        out = np.full(len(keys), -1, np.int64)
        at = np.flatnonzero(self.maybe[self._slot(keys)])
        if len(at):
            pos = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
            hit = self.keys[pos] == keys[at]
            out[at[hit]] = self.order[pos[hit]]
        return out

    def lattice(self, words: list[str]) -> list[tuple[int, int, np.ndarray]]:
        """For words of one length: (start, end, piece number of each word or -1).
        Words are given with the mark in front."""
        codes = np.array([list(w) for w in words], dtype="U1").view(np.uint32).reshape(len(words), -1).astype(np.int64)
        n = codes.shape[1]
        arcs = []
        for end in range(1, n + 1):
            for start in range(max(0, end - MAX_PIECE), end):
                found = self.find(codes[:, start:end])
                if end - start == 1:
                    found[found < 0] = self.unknown
                if (found >= 0).any():
                    arcs.append((start, end, found))
        return arcs


def letter_runs(text: str) -> list[str]:
    """Runs of letters. Numerals such as superscripts are word characters, not letters."""
    out = []
    for run in WORD.findall(text):
        out += [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split()
    return out


def by_length(words: list[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    return groups


def parts(word: str) -> list[str]:
    """Marked word, or marked parts of an overlong one."""
    return [MARK + word[i : i + MAX_WORD] for i in range(0, len(word), MAX_WORD)]


def path_sums(arcs: list[tuple[int, int, np.ndarray]], table: np.ndarray, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, logs), each (place, word, language): sums * exp(logs) is the total of
    all paths from 0 to a place. Arcs come by the place where they end, which has a
    path. Sums that get tiny are rescaled with those an arc can still start from."""
    k = table.shape[1]
    sums, logs = np.zeros((size + 1, n, k)), np.zeros((size + 1, n, k))
    sums[0] = 1.0
    for i, (start, end, found) in enumerate(arcs):
        sums[end] += sums[start] * table[found]
        if (i + 1 == len(arcs) or arcs[i + 1][1] != end) and sums[end].min(initial=1.0) < TINY:
            factor = np.where(sums[end] < TINY, sums[end], 1.0)
            low = max(0, end - MAX_PIECE + 1)
            sums[low : end + 1] /= factor
            logs[low : end + 1] += np.log(factor)
        if end < size and (i + 1 == len(arcs) or arcs[i + 1][1] != end):
            logs[end + 1] = logs[end]
    return sums, logs


@dataclass(frozen=True)
class UnigramModel:
    """languages in order, pieces, probabilities (piece + unknown, language),
    log-priors."""

    languages: tuple[str, ...]
    pieces: tuple[str, ...]
    probs: np.ndarray
    priors: np.ndarray

    def word_scores(self, finder: Pieces, words: list[str]) -> np.ndarray:
        """log probability (word, language), summed over all segmentations."""
        out = np.zeros((len(words), len(self.languages)))
        table = np.vstack([self.probs, np.zeros(len(self.languages))])  # row -1: no piece
        for size, at in by_length(words).items():
            arcs = finder.lattice([words[i] for i in at])
            sums, logs = path_sums(arcs, table, size, len(at))
            out[at] = np.log(sums[size]) + logs[size]
        return out


def learn(counts: dict[str, Counter], doc_counts: dict[str, int], pieces: list[str]) -> UnigramModel:
    """counts: words of each language. Expected piece counts over all
    segmentations, from a flat start, ROUNDS times."""
    languages = tuple(sorted(counts))
    finder = Pieces(pieces)
    k = len(languages)
    words = sorted(set().union(*counts.values()))
    weight = np.array([[counts[l][w] for l in languages] for w in words], float).reshape(len(words), k)
    marked = [MARK + w for w in words]
    groups = [(np.array(at), size, finder.lattice([marked[i] for i in at])) for size, at in by_length(marked).items()]
    rows = len(pieces) + 1
    probs = np.full((rows, k), 1.0 / rows)
    for _ in range(ROUNDS):
        expected = np.full((rows, k), SMOOTHING)
        table = np.vstack([probs, np.zeros(k)])
        for at, size, arcs in groups:
            forward, ahead = path_sums(arcs, table, size, len(at))
            turned = sorted(((size - end, size - start, found) for start, end, found in arcs), key=lambda a: a[1])
            backward, behind = (x[::-1] for x in path_sums(turned, table, size, len(at)))
            scale = weight[at] / forward[size]
            shares = np.concatenate([
                forward[s] * table[f] * backward[e] * np.exp(ahead[s] + behind[e] - ahead[size]) * scale for s, e, f in arcs
            ])
            found = np.concatenate([f for _, _, f in arcs])
            used = found >= 0
            for j in range(k):
                expected[:, j] += np.bincount(found[used], shares[used, j], rows)
        probs = expected / expected.sum(0)
    docs = np.array([doc_counts[l] for l in languages], float)
    return UnigramModel(languages, tuple(pieces), probs, np.log((docs + 1) / (docs.sum() + k)))


def fit(docs: DataFrame, labelled: DataFrame, vocabulary: str | None = None) -> UnigramModel:
    """docs(doc_id, text), labelled(doc_id, lang): the rows to learn from. At most
    DOCS_PER_LANGUAGE documents of each language are read; the languages' shares
    are counted over all labelled rows."""
    labelled = labelled.where("doc_id IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang")
    shares = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    counts: dict[str, Counter] = {}
    for lang in sorted(shares):
        ids = first_by_hash(labelled.where(F.col("lang") == lang).select("doc_id").distinct(), "doc_id", DOCS_PER_LANGUAGE)
        rows = (
            docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most DOCS_PER_LANGUAGE ids
            .where("text IS NOT NULL").select("doc_id", learning_text("text", "doc_id", LEARN_BYTES).alias("text"))
            .orderBy("doc_id", "text").select("text").collect()
        )
        found = Counter(p[len(MARK) :] for r in rows for w in letter_runs(r["text"].lower()) for p in parts(w))
        if found:
            counts[lang] = found
    return learn(counts, shares, public_pieces(vocabulary))


def predict(docs: DataFrame, model: UnigramModel, text: str = "text", out: str = "language") -> DataFrame:
    """`docs` with a struct `out`(lang, score): the likeliest learned language of
    the whole text and its posterior probability (0 to 1). Null text, or text
    without a letter (or a model without languages), gives `und` and 0. Equal
    scores go to the first language in alphabetical order. A column named `out`
    is replaced. No rows move."""

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        finder = Pieces(list(model.pieces))
        k = len(model.languages)
        # What stands between blanks is scored once: sums of word scores, and letters.
        known: dict[str, int] = {}
        table = np.zeros((0, k + 1))

        def label(texts: list[str | None]) -> tuple[list[str], list[float]]:
            nonlocal known, table
            split = [t.lower().split() if t else [] for t in texts]
            if len(known) > CACHE:
                known, table = {}, np.zeros((0, k + 1))
            new = list({c for chunks in split for c in chunks if c not in known})
            words = [letter_runs(c) for c in new]
            flat = [p for ws in words for w in ws for p in parts(w)]
            owner = np.repeat(np.arange(len(new)), [sum(len(parts(w)) for w in ws) for ws in words]) if new else np.zeros(0, int)
            fresh = np.zeros((len(new), k + 1))
            unique = list(dict.fromkeys(flat))
            place = {w: i for i, w in enumerate(unique)}
            scores = model.word_scores(finder, unique)
            index = np.fromiter((place[w] for w in flat), np.int64, len(flat))
            for j in range(k):
                fresh[:, j] = np.bincount(owner, scores[index, j], len(new))
            fresh[:, k] = np.bincount(owner, minlength=len(new))
            known.update(zip(new, range(len(table), len(table) + len(new))))
            table = np.vstack([table, fresh])
            langs, best = [], []
            for chunks in split:
                total = table[list(map(known.__getitem__, chunks))].sum(0)
                if not k or not chunks or not total[k]:
                    langs.append(UNKNOWN)
                    best.append(0.0)
                    continue
                logs = total[:k] + model.priors
                top = int(logs.argmax())
                langs.append(model.languages[top])
                best.append(float(1 / np.exp(logs - logs[top]).sum()))
            return langs, best

        for texts in batches:
            langs: list[str] = []
            scores: list[float] = []
            for i in range(0, len(texts), SLICE):
                some = label(texts.iloc[i : i + SLICE].tolist())
                langs += some[0]
                scores += some[1]
            yield pd.DataFrame({"lang": langs, "score": scores})

    return docs.withColumn(out, run(F.col(f"`{text}`")))

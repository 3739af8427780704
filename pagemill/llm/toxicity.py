"""Toxicity by a two-level bidirectional gated recurrent network, in numpy.

A network over the letters of a word, pooled by attention, makes the word's letter
vector; together with the word's own embedding it is the input of a second network
over the words of a window, pooled by attention again. A text is cut into
overlapping windows, all of which are scored; the highest one is the text's, put on
a probability scale by a logistic curve. Labels belong to whole texts, so learning
follows the window that is highest in its text at that moment."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pagemill.llm.common import first_by_hash, fit_logistic, one_label

LETTERS = 512  # code points with an embedding of their own; others share 64
SHARED = 64
PART = 14  # letters; longer words are several parts in a row
WINDOW, STRIDE = 48, 36
EMBED_LETTER, HIDDEN_LETTER = 8, 8
EMBED_WORD, HIDDEN_WORD = 6, 8
VOCABULARY, LEAST_DOCS = 4_000, 12
# Bounds of the labelled sample. Short texts say best which words a label is due
# to; texts of any length up to CURVE_WORDS fit the curve.
LEARN_DOCS = {1: 1_000, 0: 1_600}
CURVE_DOCS = {1: 300, 0: 1_200}
LEARN_WORDS, CURVE_WORDS = 300, 3_000
EPOCHS, BATCH, RATE = 6, 40, 0.012
SEED = 7
CACHE = 150_000  # word parts whose inputs a worker keeps
SLICE = 128  # texts cut into windows at a time
BLOCK = 1_024  # windows scored at a time


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Recurrent:
    """Forward and backward pass of a bidirectional GRU with attention pooling.

    Sequences are ordered by falling length, so that those still running at a place
    are the first ones. `w` (2, inputs, 3 h), `b` (2, 3 h) and `u` (2, h, 3 h) hold update, reset and
    candidate weights of both directions; `v` (2 h) is the attention."""

    @staticmethod
    def shapes(prefix: str, inputs: int, hidden: int) -> dict[str, tuple[int, ...]]:
        return {
            f"{prefix}w": (2, inputs, 3 * hidden), f"{prefix}b": (2, 3 * hidden), f"{prefix}u": (2, hidden, 3 * hidden),
            f"{prefix}v": (2 * hidden,),
        }

    @staticmethod
    def run(project, lengths: np.ndarray, u: np.ndarray, v: np.ndarray, keep: bool = False):
        """project(t, direction, k) gives x @ w + b (k, 3 h) at place t of the first k
        sequences. Returns the pooled (n, 2 h), and what `back` needs if `keep`."""
        n, steps, h = len(lengths), int(lengths[0]), u.shape[1]
        active = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")
        outs = np.zeros((2, steps, n, h), np.float32)
        saved = []
        for d in range(2):
            state = np.zeros((n, h), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                k = int(active[t])
                before = state[:k]
                x = project(t, d, k)
                a = before @ u[d]
                gates = sigmoid(x[:, : 2 * h] + a[:, : 2 * h])
                z, r = gates[:, :h], gates[:, h:]
                c = np.tanh(x[:, 2 * h :] + r * a[:, 2 * h :])
                if keep:
                    saved.append((d, t, k, before.copy(), z, r, c, a[:, 2 * h :]))
                outs[d, t, :k] = c + z * (before - c)
                state[:k] = outs[d, t, :k]
        e = outs[0] @ v[:h] + outs[1] @ v[h:]
        e[np.arange(steps)[:, None] >= lengths] = -1e9
        share = np.exp(e - e.max(0))
        share /= share.sum(0)
        pooled = np.concatenate([np.einsum("tn,tnh->nh", share, outs[d]) for d in range(2)], 1)
        return pooled, (outs, share, saved) if keep else None

    @staticmethod
    def back(grad: np.ndarray, pooled: np.ndarray, kept, u: np.ndarray, v: np.ndarray):
        """Gradients (x @ w + b as [direction, t, n, 3 h], u, v)."""
        outs, share, saved = kept
        _, steps, n, h = outs.shape
        sides = [grad[:, :h], grad[:, h:]]
        along = sum(np.einsum("nh,tnh->tn", sides[d], outs[d]) for d in range(2))
        de = share * (along - (grad * pooled).sum(1))
        dv = np.concatenate([np.einsum("tn,tnh->h", de, outs[d]) for d in range(2)])
        du = np.zeros_like(u)
        dx = np.zeros((2, steps, n, 3 * h), np.float32)
        carry = np.zeros((2, n, h), np.float32)
        for d, t, k, before, z, r, c, an in reversed(saved):
            own = share[t, :k, None] * sides[d][:k] + de[t, :k, None] * v[d * h : (d + 1) * h]
            g = carry[d, :k] + own
            dz = g * (before - c) * z * (1 - z)
            dc = g * (1 - z) * (1 - c * c)
            dr = dc * an * r * (1 - r)
            da = np.concatenate([dz, dr, dc * r], 1)
            dx[d, t, :k] = np.concatenate([dz, dr, dc], 1)
            du[d] += before.T @ da
            carry[d, :k] = g * z + da @ u[d].T
        return dx, du, dv


def letter_codes(parts: list[str]) -> np.ndarray:
    """Codes (n, longest) of word parts; nought behind their ends."""
    points = np.array(parts, dtype=f"U{max(map(len, parts))}").view(np.uint32).reshape(len(parts), -1).astype(np.int64)
    return np.where(points < LETTERS, points, LETTERS + points % SHARED)


def falling(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by falling length, place of each in that order)."""
    order = np.argsort(-lengths, kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return order, back


def cut(text: str | None) -> list[str]:
    """Word parts of the whole text, lower-cased."""
    out = []
    for w in (text or "").lower().split():
        if len(w) <= PART:
            out.append(w)
        else:
            out += [w[i : i + PART] for i in range(0, len(w), PART)]
    return out


def windows(n: int) -> list[tuple[int, int]]:
    """Overlapping windows that cover n parts."""
    return [(s, min(s + WINDOW, n)) for s in range(0, max(1, n - (WINDOW - STRIDE)), STRIDE)] if n else []


def fill(rows: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    """Rows of unequal length as one array; nought behind their ends."""
    out = np.zeros((len(rows), int(lengths.max())), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.concatenate(rows)
    return out


@dataclass
class ToxicityModel:
    """Weights by name, the words with embeddings of their own, and the curve."""

    weights: dict[str, np.ndarray]
    words: dict[str, int]
    curve: tuple[float, float] = (0.0, 1.0)

    def inputs(self, parts: list[str], keep: bool = False):
        """Inputs (n, embedding + letter vector) of word parts."""
        w = self.weights
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        order, back = falling(lengths)
        codes = letter_codes(parts)[order]
        letters = np.einsum("li,dij->dlj", w["letters"], w["cw"]) + w["cb"][:, None]
        pooled, kept = Recurrent.run(lambda t, d, k: letters[d][codes[:k, t]], lengths[order], w["cu"], w["cv"], keep)
        ids = np.fromiter((self.words.get(p, 0) for p in parts), np.int64, len(parts))
        x = np.concatenate([w["words"][ids], pooled[back]], 1)
        return x, (codes, order, ids, pooled, kept) if keep else None

    def projected(self, parts: list[str]) -> np.ndarray:
        """x @ w + b of word parts for both directions (n, 2, 3 h)."""
        x = np.concatenate([self.inputs(parts[i : i + 2_048])[0] for i in range(0, len(parts), 2_048)])
        return np.einsum("ni,dij->ndj", x, self.weights["ww"]) + self.weights["wb"]

    def window_scores(self, table: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
        """Log-odds of windows given by the places of their parts in `table`."""
        w = self.weights
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        order, back = falling(lengths)
        places = fill(rows, lengths)[order]
        pooled, _ = Recurrent.run(lambda t, d, k: table[places[:k, t], d], lengths[order], w["wu"], w["wv"])
        return (pooled @ w["out"] + w["bias"])[back]

    def highest(self, table: np.ndarray, docs: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Highest log-odds of each text (places of its parts), and its window."""
        rows = [(i, s, e) for i, d in enumerate(docs) for s, e in windows(len(d))]
        best = np.full(len(docs), -np.inf)
        where: list[tuple[int, int]] = [(0, 0)] * len(docs)
        for k in range(0, len(rows), BLOCK):
            some = rows[k : k + BLOCK]
            scores = self.window_scores(table, [docs[i][s:e] for i, s, e in some])
            for (i, s, e), score in zip(some, scores.tolist()):
                if score > best[i]:
                    best[i], where[i] = score, (s, e)
        return best, where


def start_weights(words: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    shapes = {
        "letters": (LETTERS + SHARED, EMBED_LETTER), "words": (words + 1, EMBED_WORD),
        **Recurrent.shapes("c", EMBED_LETTER, HIDDEN_LETTER),
        **Recurrent.shapes("w", EMBED_WORD + 2 * HIDDEN_LETTER, HIDDEN_WORD), "out": (2 * HIDDEN_WORD,), "bias": (1,),
    }
    scale = {"letters": 0.5, "words": 0.1, "cb": 0.0, "wb": 0.0, "bias": 0.0}
    return {
        k: (rng.normal(size=s) * scale.get(k, 1 / np.sqrt(s[-2] if len(s) > 1 else s[0]))).astype(np.float32)
        for k, s in shapes.items()
    }


def window_step(model: ToxicityModel, parts: list[list[str]], labels: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Gradient of the mean log-loss over windows (lists of word parts)."""
    w = model.weights
    unique = list(dict.fromkeys(p for row in parts for p in row))
    place = {p: i for i, p in enumerate(unique)}
    x, (codes, letter_order, ids, letter_pool, letter_kept) = model.inputs(unique, keep=True)
    lengths = np.array([len(row) for row in parts])
    order, _ = falling(lengths)
    labels, lengths = labels[order], lengths[order]
    places = fill([np.array([place[p] for p in parts[j]]) for j in order], lengths)
    table = np.einsum("ni,dij->ndj", x, w["ww"]) + w["wb"]
    pooled, kept = Recurrent.run(lambda t, d, k: table[places[:k, t], d], lengths, w["wu"], w["wv"], keep=True)
    p = sigmoid(pooled @ w["out"] + w["bias"])
    loss = float(-np.mean(np.log(np.where(labels > 0, p, 1 - p) + 1e-7)))
    d = ((p - labels) / len(labels)).astype(np.float32)
    grads = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
    dx, grads["wu"], grads["wv"] = Recurrent.back(d[:, None] * w["out"], pooled, kept, w["wu"], w["wv"])
    dtable = np.zeros_like(table)
    live = np.arange(places.shape[1])[:, None] < lengths
    for k in range(2):
        np.add.at(dtable[:, k], places.T[live], dx[k][live])
    grads["wb"] = dtable.sum(0)
    grads["ww"] = np.einsum("ni,ndj->dij", x, dtable)
    dinput = np.einsum("ndj,dij->ni", dtable, w["ww"])
    grads["words"] = np.zeros_like(w["words"])
    np.add.at(grads["words"], ids, dinput[:, :EMBED_WORD])
    dc, grads["cu"], grads["cv"] = Recurrent.back(dinput[letter_order, EMBED_WORD:], letter_pool, letter_kept, w["cu"], w["cv"])
    grads["cb"] = dc.sum((1, 2))
    by_letter = np.zeros((2, len(w["letters"]), dc.shape[3]), np.float32)
    for k in range(2):
        np.add.at(by_letter[k], codes.T, dc[k])
    grads["cw"] = np.einsum("li,dlj->dij", w["letters"], by_letter)
    grads["letters"] = np.einsum("dlj,dij->li", by_letter, w["cw"])
    return grads, loss


def train(texts: list[str], labels: list[int]) -> ToxicityModel:
    """Network from whole texts and their labels (Adam, fixed seed)."""
    rng = np.random.default_rng(SEED)
    cuts = [cut(t) for t in texts]
    seen = Counter(p for c in cuts for p in set(c))
    kept = sorted((p for p, n in seen.items() if n >= LEAST_DOCS), key=lambda p: (-seen[p], p))[:VOCABULARY]
    model = ToxicityModel(start_weights(len(kept), rng), {p: i + 1 for i, p in enumerate(kept)})
    usable = [i for i, c in enumerate(cuts) if c]
    y = np.array(labels, np.float32)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(usable)
        rate = RATE * (1 - 0.8 * epoch / EPOCHS)
        for k in range(0, len(order), BATCH):
            chosen = order[k : k + BATCH]
            unique = list(dict.fromkeys(p for i in chosen for p in cuts[i]))
            place = {p: j for j, p in enumerate(unique)}
            docs = [np.array([place[p] for p in cuts[i]]) for i in chosen]
            _, where = model.highest(model.projected(unique), docs)
            rows = [cuts[i][s:e] for i, (s, e) in zip(chosen, where)]
            goal = y[chosen]
            # A second window of clean texts, at random.
            more = [i for i in chosen if not y[i]]
            for i in more:
                s, e = windows(len(cuts[i]))[rng.integers(len(windows(len(cuts[i]))))]
                rows.append(cuts[i][s:e])
            grads, _ = window_step(model, rows, np.concatenate([goal, np.zeros(len(more), np.float32)]))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            for name, g in grads.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                unbiased = np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6
                model.weights[name] = (model.weights[name] - rate * first[name] / (1 - 0.9**step) / unbiased).astype(np.float32)
    return model


def score_texts(model: ToxicityModel, texts: list[str | None], known: dict[str, int], table: np.ndarray):
    """Highest log-odds of each text; -inf without words. Returns them and the
    table, which grows by the new word parts (`known` gives their places)."""
    cuts = [cut(t) for t in texts]
    new = list(dict.fromkeys(p for c in cuts for p in c if p not in known))
    if new:
        known.update(zip(new, range(len(table), len(table) + len(new))))
        table = np.concatenate([table, model.projected(new).astype(np.float32)])
    docs = [np.fromiter(map(known.__getitem__, c), np.int64, len(c)) for c in cuts]
    return model.highest(table, docs)[0], table


def fit(docs: DataFrame, labelled: DataFrame) -> ToxicityModel:
    """docs(doc_id, text), labelled(doc_id, label 0/1): the rows to learn from. Of
    each label the ids that hash lowest among texts of up to LEARN_WORDS (the shortest
    ones where all are longer) and CURVE_WORDS words are used, LEARN_DOCS for the
    network and CURVE_DOCS for the curve, which is weighted by the labels' frequency. Without both labels every score is the share of toxic
    rows (smoothed)."""
    labelled = one_label(labelled)
    counts = {int(r["label"]): r["count"] for r in labelled.groupBy("label").count().collect()}
    n_words = F.size(F.split("text", r"\s+"))
    learn: list[tuple[str, int]] = []
    curve: list[tuple[str, int]] = []
    for label in (0, 1):
        most = LEARN_DOCS[label] + CURVE_DOCS[label]
        ids = first_by_hash(labelled.where(F.col("label") == label).select("doc_id"), "doc_id", 4 * most)
        rows = (
            docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most 4 * most ids
            .where("text IS NOT NULL").withColumn("h", F.xxhash64("doc_id")).withColumn("n_words", n_words)
        )
        short = rows.where(F.col("n_words") <= LEARN_WORDS).orderBy("h", "doc_id", "text").limit(LEARN_DOCS[label]).collect()
        if not short:  # none is short: the shortest there are, so many that their words keep the same bound
            by_size = Window.orderBy("n_words", "h", "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0)
            first = rows.orderBy("n_words", "h", "doc_id", "text").limit(LEARN_DOCS[label])
            total = first.withColumn("words", F.sum("n_words").over(by_size)).withColumn("at", F.row_number().over(by_size))
            short = total.where((F.col("words") <= LEARN_WORDS * LEARN_DOCS[label]) | (F.col("at") == 1)).orderBy("at").collect()
        taken = {r["doc_id"] for r in short}
        rest = rows.where(F.col("n_words") <= CURVE_WORDS).orderBy(F.desc("h"), "doc_id", "text").limit(CURVE_DOCS[label]).collect()
        learn += [(r["text"], label) for r in short]
        curve += [(r["text"], label) for r in rest if r["doc_id"] not in taken]
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    prior = float(np.log(share / (1 - share)))
    if len({l for _, l in learn}) < 2:
        return ToxicityModel(start_weights(0, np.random.default_rng(SEED)), {}, (prior, 0.0))
    model = train([t for t, _ in learn], [l for _, l in learn])
    if len({l for _, l in curve}) < 2:
        curve = learn
    known: dict[str, int] = {}
    logits = []
    table = np.zeros((0, 2, 3 * HIDDEN_WORD), np.float32)
    for i in range(0, len(curve), SLICE):
        found, table = score_texts(model, [t for t, _ in curve[i : i + SLICE]], known, table)
        logits.append(found)
    y = np.array([l for _, l in curve], float)
    x = np.maximum(np.concatenate(logits), -20.0)
    weight = np.array([counts[l] / max(1, (y == l).sum()) for _, l in curve])
    w = fit_logistic(np.column_stack([np.ones_like(x), x]), y, weight / weight.mean())
    return ToxicityModel(model.weights, model.words, (float(w[0]), float(w[1])))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """`docs` with the probability of toxic text in `out` (0 to 1), from the whole
    text. Null, empty and blank texts have no window and get the value of the
    lowest log-odds. A column named `out` is replaced. No rows move."""

    @F.pandas_udf(DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, int] = {}
        empty = table = np.zeros((0, 2, 3 * HIDDEN_WORD), np.float32)
        a, b = model.curve
        for texts in batches:
            found = [np.zeros(0)]
            for i in range(0, len(texts), SLICE):
                if len(known) > CACHE:
                    known, table = {}, empty
                some, table = score_texts(model, texts.iloc[i : i + SLICE].tolist(), known, table)
                found.append(some)
            x = np.clip(np.concatenate(found), -20.0, 20.0)
            yield pd.Series(1 / (1 + np.exp(-(a + b * x))))

    return docs.withColumn(out, run(F.col(f"`{text}`")))

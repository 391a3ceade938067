"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its own vector (words that ``MIN_TEXTS`` texts of the training
sample hold) beside the mean of its character n-grams' vectors; two gated recurrent
layers read a window of ``LENGTH`` words forwards and backwards; attention pools their states; a
logistic unit scores the window.  Windows overlap (a new one every ``STRIDE`` words) and
cover the whole text; a document's score is that of its worst window.

The network is trained on the driver with a bounded sample (``max_docs`` labelled documents of
either label, picked by a hash of the id).  Their whole texts are cut into windows in tasks; of a text with more than
``MAX_WINDOWS`` of them, as many equal parts give a window each, picked by a hash of id and part; scoring is a
single pass over the texts without a shuffle, with the weights as the only broadcast.  Input projections
of words are kept in a table of bounded size.

Defined cases: null, empty or word-less text is one empty window (the network's score for no input);
with labels of one kind only, or none, that kind's share (0 if none) is every score; a repeated label row
counts once, of differing labels the larger; null labels and null ids teach nothing; repeated documents
get a row each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches

LENGTH, STRIDE = 64, 56
WORD_DIMS, CHAR_DIMS, HIDDEN, ATTEND = 8, 8, 8, 8
#: Lengths and buckets of character n-grams; words of the vocabulary, and texts of the sample that must hold one.
GRAMS, CHAR_BUCKETS, MAX_VOCAB, MIN_TEXTS = (3, 4, 5, 6), 16384, 10_000, 10
#: Bounds of the training sample: documents of label 0 and of label 1, and windows of a text of either label.
MAX_DOCS, MAX_WINDOWS = (4000, 1500), (6, 32)
#: Logit below which the worst window of a label 0 text teaches nothing more.
EASY = -6.0
EPOCHS, RATE, DECAY, BATCH, SEED = 10, 0.01, 0.02, 128, 11
#: Words whose projections a Python worker keeps; windows scored at a time.
MEMO, AT_ONCE = 300_000, 768
#: Texts that are split and looked up together.
AHEAD = 64
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters and digits."""
    return _WORD.findall(text.lower())


def windows_of(n: int) -> list[tuple[int, int]]:
    """(start, end) of the overlapping windows over n words; one at least."""
    starts = range(0, max(1, n - (LENGTH - STRIDE)), STRIDE)
    return [(s, min(n, s + LENGTH)) for s in starts]


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of ``<word>``, word after word, and how many each word has."""
    code = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.cumsum(code == ord("<")) - 1  # words are letters and digits, so the marks are ours
    buckets, owners = [], []
    for n in GRAMS:
        size = max(0, len(code) - n + 1)
        h = np.full(size, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(1_000_003) + code[j : j + size]
        inside = word[:size] == word[n - 1 : n - 1 + size]
        buckets.append(((h ^ (h >> np.uint64(29))) % np.uint64(CHAR_BUCKETS))[inside].astype(np.int64))
        owners.append(word[:size][inside])
    owner = np.concatenate(owners)
    return np.concatenate(buckets)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights, and the passes over windows given as rows of word numbers (-1: past the end)."""

    def __init__(self, vocab: dict[str, int], base: float = 0.0):
        r = np.random.default_rng(SEED)
        size = lambda *shape, by: r.normal(0, by, shape).astype(np.float32)
        wide = WORD_DIMS + CHAR_DIMS
        self.vocab, self.base = vocab, base
        self.w = {
            "word": size(len(vocab) + 1, WORD_DIMS, by=0.1), "char": size(CHAR_BUCKETS, CHAR_DIMS, by=0.1),
            "x": size(2, wide, 3 * HIDDEN, by=0.3), "h": size(2, HIDDEN, 3 * HIDDEN, by=0.3), "b": np.zeros((2, 3 * HIDDEN), np.float32),
            "a": size(2 * HIDDEN, ATTEND, by=0.3), "ab": np.zeros(ATTEND, np.float32), "v": size(ATTEND, by=0.3),
            "o": size(2 * HIDDEN, by=0.3), "ob": np.zeros(1, np.float32),
        }
        self.w["word"][0] = 0

    def inputs(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Input vectors of distinct words, and what their gradient needs."""
        number = np.fromiter((self.vocab.get(w, 0) for w in words), np.int64, len(words))
        flat, count = grams_of(words)
        chars = np.zeros((len(words), CHAR_DIMS), np.float32)
        have = count.nonzero()[0]
        if len(have):
            starts = (np.cumsum(count) - count)[have]
            chars[have] = np.add.reduceat(self.w["char"][flat], starts, axis=0) / count[have, None]
        return np.concatenate([self.w["word"][number], chars], axis=1).astype(np.float32), (number, flat, count)

    def projected(self, vectors: np.ndarray) -> np.ndarray:
        """(words, 2, 3 * HIDDEN): what each word adds to the gates in either direction."""
        return np.einsum("nd,kdg->nkg", vectors, self.w["x"], optimize=True) + self.w["b"]

    def forward(self, table: np.ndarray, windows: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logits of windows (rows of numbers into ``table``, longest first); with ``keep``, also the trace."""
        n, steps, hid = len(windows), int(lengths.max(initial=0)), HIDDEN
        states = np.zeros((2, n, max(steps, 1), hid), np.float32)
        h, trace = np.zeros((2, n, hid), np.float32), []
        alive = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")
        for t in range(steps):
            m = int(alive[t])
            rows = np.arange(m)
            x = np.stack([table[windows[:m, t], 0], table[windows[rows, lengths[:m] - 1 - t], 1]])
            past = h[:, :m]
            u = past @ self.w["h"]
            gates = _sigmoid(x[..., : 2 * hid] + u[..., : 2 * hid])
            z, r = gates[..., :hid], gates[..., hid:]
            c = np.tanh(x[..., 2 * hid :] + r * u[..., 2 * hid :])
            new = past + z * (c - past)
            if keep:
                trace.append((m, past.copy(), z, r, c, u[..., 2 * hid :]))
            h[:, :m] = new
            states[0, :m, t] = new[0]
            states[1, rows, lengths[:m] - 1 - t] = new[1]
        both = np.concatenate([states[0], states[1]], axis=2)
        there = np.arange(max(steps, 1)) < lengths[:, None]
        inner = np.tanh(both @ self.w["a"] + self.w["ab"])
        weight = np.where(there, np.exp(inner @ self.w["v"]), 0)
        weight = weight / np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,ntd->nd", weight, both)
        logit = pooled @ self.w["o"] + self.w["ob"][0]
        return (logit, trace, both, there, inner, weight, pooled) if keep else logit

    def gradients(self, table, windows, lengths, target) -> tuple[dict, np.ndarray]:
        """Gradients of the mean logistic loss, and that of ``table``."""
        logit, trace, both, there, inner, weight, pooled = self.forward(table, windows, lengths, keep=True)
        n, hid, w = len(windows), HIDDEN, self.w
        d = ((_sigmoid(logit) - target) / n).astype(np.float32)
        g = {"o": d @ pooled, "ob": d.sum(keepdims=True)}
        d_pool = d[:, None] * w["o"]
        d_both = weight[..., None] * d_pool[:, None]
        d_weight = np.einsum("ntd,nd->nt", both, d_pool)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True)) * there
        g["v"] = np.einsum("nt,nta->a", d_score, inner)
        d_inner = d_score[..., None] * w["v"] * (1 - inner**2)
        g["a"], g["ab"] = np.einsum("ntd,nta->da", both, d_inner), d_inner.sum(axis=(0, 1))
        d_both = d_both + d_inner @ w["a"].T
        d_state = np.stack([d_both[..., :hid], d_both[..., hid:]])
        d_table, g["h"] = np.zeros_like(table), np.zeros_like(w["h"])
        d_h = np.zeros((2, n, hid), np.float32)
        for t in range(len(trace) - 1, -1, -1):
            m, past, z, r, c, uc = trace[t]
            rows = np.arange(m)
            d_new = d_h[:, :m].copy()
            d_new[0] += d_state[0, :m, t]
            d_new[1] += d_state[1, rows, lengths[:m] - 1 - t]
            d_c = d_new * z * (1 - c**2)
            d_z = d_new * (c - past) * z * (1 - z)
            d_r = d_c * uc * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_c], axis=2)
            d_u = np.concatenate([d_z, d_r, d_c * r], axis=2)
            g["h"] += np.swapaxes(past, 1, 2) @ d_u
            d_h[:, :m] = d_new * (1 - z) + d_u @ np.swapaxes(w["h"], 1, 2)
            np.add.at(d_table, (windows[:m, t], 0), d_x[0])
            np.add.at(d_table, (windows[rows, lengths[:m] - 1 - t], 1), d_x[1])
        return g, d_table

    def step(self, batch: list[list[str]], target: np.ndarray, moments: dict, number: int) -> None:
        """One Adam step on a batch of windows (lists of words)."""
        order = sorted(range(len(batch)), key=lambda i: -len(batch[i]))
        names, windows, lengths = self.table([batch[i] for i in order])
        vectors, (word, flat, count) = self.inputs(names)
        table = self.projected(vectors)
        g, d_table = self.gradients(table, windows, lengths, target[order])
        g["b"] = d_table.sum(axis=0)
        g["x"] = np.einsum("nd,nkg->kdg", vectors, d_table, optimize=True)
        d_in = np.einsum("nkg,kdg->nd", d_table, self.w["x"], optimize=True)
        g["word"], g["char"] = np.zeros_like(self.w["word"]), np.zeros_like(self.w["char"])
        np.add.at(g["word"], word, d_in[:, :WORD_DIMS])
        g["word"][0] = 0
        np.add.at(g["char"], flat, np.repeat(d_in[:, WORD_DIMS:] / np.maximum(count, 1)[:, None], count, axis=0))
        for k, grad in g.items():
            m, v = moments.setdefault(k, (np.zeros_like(grad), np.zeros_like(grad)))
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            self.w[k] -= (RATE * (m / (1 - 0.9**number)) / (np.sqrt(v / (1 - 0.999**number)) + 1e-8)).astype(np.float32)
            self.w[k] *= 1 - RATE * DECAY

    @staticmethod
    def table(batch: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words, windows as rows of their numbers, lengths."""
        names: dict[str, int] = {}
        lengths = np.fromiter(map(len, batch), np.int64, len(batch))
        windows = np.full((len(batch), max(1, int(lengths.max(initial=0)))), -1, np.int64)
        for i, words in enumerate(batch):
            windows[i, : len(words)] = [names.setdefault(w, len(names)) for w in words]
        return list(names) or [""], windows, lengths


class Scorer:
    """Scores texts with a trained network; keeps words' projections."""

    def __init__(self, network: Network):
        self.net = network
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((0, 2, 3 * HIDDEN), np.float32)

    def _learn(self, words: set[str]) -> None:
        """Adds the projections of words not yet kept."""
        new = [w for w in words if w not in self.number]
        first = len(self.number)
        self.number.update((w, first + i) for i, w in enumerate(new))
        if len(self.number) > len(self.table):
            bigger = np.zeros((max(len(self.number), 2 * len(self.table), 4096), 2, 3 * HIDDEN), np.float32)
            bigger[:first] = self.table[:first]
            self.table = bigger
        for s in range(0, len(new), 20_000):
            part = new[s : s + 20_000]
            self.table[first + s : first + s + len(part)] = self.net.projected(self.net.inputs(part)[0])

    def _worst(self, windows: list[np.ndarray], owner: list[int], out: np.ndarray) -> None:
        order = sorted(range(len(windows)), key=lambda i: -len(windows[i]))
        lengths = np.fromiter((len(windows[i]) for i in order), np.int64, len(order))
        rows = np.full((len(order), max(1, int(lengths[0]))), -1, np.int64)
        for k, i in enumerate(order):
            rows[k, : lengths[k]] = windows[i]
        table = self.table if len(self.table) else np.zeros((1, 2, 3 * HIDDEN), np.float32)
        np.maximum.at(out, np.array([owner[i] for i in order]), self.net.forward(table, rows, lengths))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        worst = np.full(len(texts), -np.inf, np.float32)
        for start in range(0, len(texts), AHEAD):
            split = [words_of(t or "") for t in texts[start : start + AHEAD]]
            missing = set().union(*split) - self.number.keys()
            if missing:
                if len(self.number) > MEMO:
                    self.forget()
                    missing = set().union(*split)
                self._learn(missing)
            known = self.number
            numbers = [np.array([known[w] for w in words], np.int64) for words in split]
            places = [(i, a, b) for i, words in enumerate(split) for a, b in windows_of(len(words))]
            for s in range(0, len(places), AT_ONCE):
                part = places[s : s + AT_ONCE]
                self._worst([numbers[i][a:b] for i, a, b in part], [start + i for i, _, _ in part], worst)
        return _sigmoid(worst.astype(np.float64))


def sampled_windows(text: str, key: str, most: int) -> list[str]:
    """The windows of a text, words joined by spaces; of more than ``most``, one of each of ``most`` equal parts, by a hash."""
    words = words_of(text)
    spans = windows_of(len(words))
    if len(spans) > most:
        edges = [k * len(spans) // most for k in range(most + 1)]
        spans = [spans[a + zlib.crc32(f"{key}:{k}".encode()) % (b - a)] for k, (a, b) in enumerate(pairwise(edges))]
    return [" ".join(words[a:b]) for a, b in spans]


def train(texts: list[list[str]], labels: np.ndarray) -> Network:
    """A network from windows of labelled texts: every window with its text's label first, then the worst window of each text."""
    split = [[x.split() for x in windows] for windows in texts]
    seen = Counter(w for parts in split for w in set().union(*parts))
    vocab = {w: i + 1 for i, (w, n) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:MAX_VOCAB]) if n >= MIN_TEXTS}
    net, moments, number = Network(vocab), {}, 0
    r = np.random.default_rng(SEED)
    windows = [(w, i) for i, parts in enumerate(split) for w in parts]
    y = labels.astype(np.float32)
    for epoch in range(EPOCHS):
        if epoch < 2:  # all windows of label 1, one of each other text
            one = {}
            for k in r.permutation(len(windows)):
                one.setdefault(windows[k][1], k)
            used = [x for k, x in enumerate(windows) if y[x[1]] == 1 or one[x[1]] == k]
        else:  # what a text is judged by, its worst window, and all windows wrongly near label 1
            scored = _window_scores(net, windows)
            best: dict[int, int] = {}
            for k, (_, i) in enumerate(windows):
                if i not in best or scored[k] > scored[best[i]]:
                    best[i] = k
            used = [x for k, x in enumerate(windows) if best[x[1]] == k and (y[x[1]] == 1 or scored[k] > EASY) or y[x[1]] == 0 and scored[k] > -2]
        order = r.permutation(len(used))
        for s in range(0, len(order), BATCH):
            part = [used[k] for k in order[s : s + BATCH]]
            number += 1
            net.step([w for w, _ in part], y[[i for _, i in part]], moments, number)
    return net


def _window_scores(net: Network, windows: list[tuple]) -> np.ndarray:
    out = np.zeros(len(windows), np.float32)
    by_size = sorted(range(len(windows)), key=lambda k: -len(windows[k][0]))
    for s in range(0, len(by_size), AT_ONCE):
        part = by_size[s : s + AT_ONCE]
        names, rows, lengths = Network.table([windows[k][0] for k in part])
        out[part] = net.forward(net.projected(net.inputs(names)[0]), rows, lengths)
    return out


def held_out() -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3 (a null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_sample(docs: DataFrame, labels: DataFrame, max_docs: tuple[int, int] = MAX_DOCS) -> list[tuple]:
    """(doc_id, toxic, windows) of a bounded sample of ``docs`` that ``labels`` marks and that are not held out."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    place = F.xxhash64(F.col("doc_id").cast("string"))
    ids = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(place, "doc_id").limit(max_docs[label])
        ids = part if ids is None else ids.union(part)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    found = texts.join(F.broadcast(ids), "doc_id")  # sum(max_docs) rows of two numbers

    @F.pandas_udf("array<string>")
    def windows(text: pd.Series, key: pd.Series, toxic: pd.Series) -> pd.Series:
        return pd.Series([sampled_windows(t, k, MAX_WINDOWS[n]) for t, k, n in zip(text, key, toxic, strict=True)], dtype=object)

    cut = found.select("doc_id", "toxic", windows("text", F.col("doc_id").cast("string"), "toxic").alias("windows"))
    # one text of an id
    return sorted((r.doc_id, r.toxic, r.windows) for r in cut.groupBy("doc_id", "toxic").agg(F.min("windows").alias("windows")).collect())


def learn(docs: DataFrame, labels: DataFrame, max_docs: tuple[int, int] = MAX_DOCS) -> Network:
    """The network of the training sample."""
    sample = training_sample(docs, labels, max_docs)
    kinds = {r[1] for r in sample}
    if kinds != {0, 1}:
        net = Network({}, base=float(next(iter(kinds), 0)))
        net.trained = False
        return net
    net = train([r[2] for r in sample], np.array([r[1] for r in sample]))
    net.trained = True
    return net


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_docs: tuple[int, int] = MAX_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, max_docs))

    @F.pandas_udf("double")
    def worst(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for batch in batches:
            if scorer.net.trained:
                yield pd.Series(np.round(scorer.scores(batch.tolist()), 6))
            else:
                yield pd.Series(np.full(len(batch), scorer.net.base))

    return docs.select("doc_id", held_out().alias("held_out"), worst(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))

"""Toxicity by a chain of linear classifiers.

The categories are predicted one after another: insult, contempt, disgust, and
toxic last.  Each link is a logistic regression on hashed words and word
beginnings that also gets the probabilities of the links before it.  In
training these are out-of-fold predictions (a link never sees a probability
made by a model that knew the document), in scoring those of the final links.

Labels mark documents as toxic or not; a toxic document belongs to the
categories whose seed words it has.  The last link learns the mark itself, so
toxic documents without any seed word count in full.

Training reads a bounded, documented sample (the first ``TOXIC`` and ``CLEAN``
labelled documents in a hash order of the ids, never rows with crc32(id) mod 3
of 1); scoring every whole text.  Null, empty and word-less texts have no
features and are scored by the intercepts; without labels of both classes
nothing is toxic (all probabilities 0).  Rows are scored one by one, so ids
may be null or repeated; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import blocks_of, bucket, points_of, powers, word_bounds, word_hashes
from .quality_classifier import held_out, sample

BITS, PREFIXES, FOLDS = 18, (3, 4, 5, 6, 7, 8), 3
TOXIC, CLEAN, EPOCHS, RATE, L1, L2, HEAVIEST, SEED = 1500, 3000, 6, 0.3, 12.0, 0.1, 10.0, 23
# --- fixed values: seed words of the categories -----------------------------------
SEEDS = {
    "insult": ("idiot", "moron", "loser", "clown", "fool", "imbecile", "dumb"),
    "contempt": ("pathetic", "worthless", "stupid", "useless", "ridiculous"),
    "disgust": ("disgusting", "scum", "trash", "filth", "vermin", "garbage"),
}
# ----------------------------------------------------------------------------------
LINKS = (*SEEDS, "toxic")


def _words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    c = points_of(text.lower())
    ascii_word = ((c >= 48) & (c <= 57)) | ((c >= 97) & (c <= 122))
    c[(c < 128) & ~ascii_word] = 32
    return c, *word_bounds(c)


def features(text: str | None) -> np.ndarray:
    """Distinct feature numbers: whole words and their beginnings."""
    out = []
    for block in blocks_of(text):
        c, first, stop = _words(block)
        if not len(first):
            continue
        out.append(bucket(word_hashes(c, first, stop), 1, BITS))
        h, p, length = np.zeros(len(first), np.uint64), powers(max(PREFIXES)), stop - first
        for k in range(max(PREFIXES)):
            h = h + c[np.minimum(first + k, len(c) - 1)] * p[k]
            if k + 1 in PREFIXES:
                out.append(bucket(h[length > k], k + 2, BITS))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)


def categories(text: str | None) -> int:
    """Bits of the categories whose seeds the text has."""
    bits = 0
    for block in blocks_of(text):
        c, first, stop = _words(block)
        words = {"".join(map(chr, c[a:b].tolist())) for a, b in zip(first, stop) if b - a <= 12}
        for i, seeds in enumerate(SEEDS.values()):
            bits |= (not words.isdisjoint(seeds)) << i
    return bits


@dataclass
class Link:
    """A logistic regression on features and the probabilities before it."""

    weights: np.ndarray
    before: np.ndarray
    bias: float

    def probability(self, ids: np.ndarray, earlier: list[float]) -> float:
        z = self.bias + float(self.weights[ids].sum(dtype=np.float64)) + float(np.dot(self.before, earlier))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def fit_link(rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, seed: int) -> Link:
    """Follow-the-regularised-leader with an L1 term (McMahan et al. 2013):
    only features with steady evidence get a weight, so the many words of a
    long clean text add up to nothing.  A rare class weighs more, up to
    ``HEAVIEST`` times, until it has half the weight of the other."""
    rare = float(np.clip((len(y) - y.sum()) / (2 * max(1.0, y.sum())), 1, HEAVIEST))
    rng = np.random.default_rng(seed)
    z, n, weights = (np.zeros(1 << BITS, np.float32) for _ in range(3))
    before, bias, wide = np.zeros(earlier.shape[1]), 0.0, np.full(earlier.shape[1] + 1, 1.0)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            ids = rows[i]
            score = bias + float(weights[ids].sum()) + float(before @ earlier[i])
            g = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - y[i]) * (rare if y[i] else 1.0)
            if len(ids):
                was = np.sqrt(n[ids])
                n[ids] += np.float32(g * g)
                now = np.sqrt(n[ids])
                z[ids] += np.float32(g) - (now - was) / RATE * weights[ids]
                over = np.abs(z[ids]) - L1
                weights[ids] = np.where(over > 0, -np.sign(z[ids]) * over / ((1 + now) / RATE + L2), 0)
            own = np.append(g * earlier[i], g)
            wide += own * own
            move = RATE * own / np.sqrt(wide)
            before, bias = before - move[:-1], bias - move[-1]
    return Link(weights, before, float(bias))


@dataclass
class Chain:
    links: list[Link]

    def probabilities(self, text: str | None) -> list[float]:
        if not self.links:
            return [0.0] * len(LINKS)
        ids, out = features(text), []
        for link in self.links:
            out.append(link.probability(ids, out))
        return out


def fit(rows: list[tuple[int, int, np.ndarray]]) -> Chain:
    """``rows``: toxic mark, category bits, features."""
    marks, bits = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    if len(set(marks.tolist())) < 2:
        return Chain([])
    bags = [r[2] for r in rows]
    # Texts with equal features lie in one fold, so that no link sees a probability by a model that knew the text.
    first: dict[bytes, int] = {}
    fold = np.array([first.setdefault(bag.tobytes(), len(first)) for bag in bags]) % FOLDS
    earlier, links = np.zeros((len(rows), 0)), []
    for k, name in enumerate(LINKS):
        y = (marks if name == "toxic" else marks * (bits >> k & 1)).astype(float)
        links.append(fit_link(bags, earlier, y, SEED + k))
        if k + 1 == len(LINKS):
            break
        outside = np.zeros(len(rows))
        for f in range(FOLDS):
            inside = np.flatnonzero(fold != f)
            link = fit_link([bags[i] for i in inside], earlier[inside], y[inside], SEED + k)
            for i in np.flatnonzero(fold == f):
                outside[i] = link.probability(bags[i], earlier[i].tolist())
        earlier = np.column_stack([earlier, outside])
    return Chain(links)


def train(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> Chain:
    @F.pandas_udf("bits int, ids binary")
    def bag(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(categories(t), features(t).astype("<i4").tobytes()) for t in texts], columns=["bits", "ids"])

    got = sample(docs, labels, "toxic", {0: clean, 1: toxic}).select("label", bag("text").alias("b")).select("label", "b.*")
    rows = [(r["label"], r["bits"], np.frombuffer(r["ids"], "<i4")) for r in got.collect()]  # at most toxic + clean rows
    order = np.random.default_rng(SEED).permutation(len(rows))
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    return fit([rows[i] for i in order])


def classify(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> DataFrame:
    """One row per document: ``doc_id, held_out``, a probability for each link
    (``p_insult`` ... ``p_toxic``), ``score`` (that of the last link) and the
    verdict ``toxic``."""
    chain = train(docs, labels, toxic, clean)

    @F.pandas_udf(", ".join(f"p_{n} double" for n in LINKS))
    def score(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([chain.probabilities(t) for t in texts], columns=[f"p_{n}" for n in LINKS])

    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("p")).select("doc_id", "held_out", "p.*")
    return out.withColumn("score", F.col("p_toxic")).withColumn("toxic", F.col("p_toxic") >= 0.5)

"""Quality classifier on supervised subword embeddings.

A document is the mean of learned vectors of its hashed features: words,
character n-grams within words (with their boundaries), and two marker words,
"same as the word before" and "these three words again".  A softmax over two
outputs follows; vectors and outputs are trained by stochastic gradient
descent in numpy.  As nothing is nonlinear before the softmax, scoring uses
one number per feature: the difference of the two outputs for its vector.

Training reads a bounded sample of the labelled documents (``per_class`` of
each class, the first in a hash order of the ids), scoring every whole text.
Only labels of rows with crc32(id) mod 3 other than 1 are learned from; the
text is the only input of a score.

Defined results: a text without features (null, empty, white space) scores as
the mean document of none, 0.5 for any model; ids may be null or repeated
(each row is scored; null ids are held in and carry no label); without labels
of both classes all scores are 0.5.  Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import small_batches
from .hashing import BASE, blocks_of, bucket, points_of, word_bounds, word_hashes

BITS, DIM, NGRAMS = 16, 16, (3, 4, 5)
SAME, AGAIN = 1 << BITS, (1 << BITS) + 1  # marker words
FEATURES = (1 << BITS) + 2
PER_CLASS, EPOCHS, RATE, SEED = 2000, 12, 4.0, 17


def features(text: str) -> np.ndarray:
    """Feature numbers of a block of text, one for each occurrence."""
    c = points_of(text)
    first, stop = word_bounds(c)
    if not len(first):
        return np.zeros(0, np.int64)
    words = word_hashes(c, first, stop)
    out = [bucket(words, 1, BITS)]
    inner = c != 32
    h, ok = c[:-1] * BASE + c[1:], np.ones(len(c) - 1, bool)
    for n in range(3, max(NGRAMS) + 1):
        if len(c) < n:
            break
        h = h[:-1] * BASE + c[n - 1:]
        ok = ok[:-1] & inner[n - 2:-1]  # spaces at the ends only
        if n in NGRAMS:
            out.append(bucket(h[ok], n, BITS))
    out.append(np.full(int((words[1:] == words[:-1]).sum()), SAME))
    if len(words) > 2:
        three = words[:-2] * BASE * BASE + words[1:-1] * BASE + words[2:]
        out.append(np.full(len(three) - len(np.unique(three)), AGAIN))
    return np.concatenate(out)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    """What scoring needs: a number for each feature."""

    logit: np.ndarray

    def score(self, text: str | None) -> float:
        total = n = 0
        for block in blocks_of(text):
            found = features(block)
            total, n = total + float(self.logit[found].sum(dtype=np.float64)), n + len(found)
        return 1.0 / (1.0 + np.exp(-np.clip(total / max(n, 1), -500, 500)))


def bags(docs: DataFrame) -> DataFrame:
    """(label, ids, weights) of ``docs`` (text, label), arrays as bytes."""
    @F.pandas_udf("ids binary, weights binary")
    def bag(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            counts = sum((np.bincount(features(b), minlength=FEATURES) for b in blocks_of(t)), np.zeros(FEATURES, np.int64))
            ids = np.flatnonzero(counts)
            rows.append((ids.astype("<i4").tobytes(), (counts[ids] / max(1, counts.sum())).astype("<f4").tobytes()))
        return pd.DataFrame(rows, columns=["ids", "weights"])

    return docs.select("label", bag("text").alias("b")).select("label", "b.*")


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int]) -> DataFrame:
    """(text, label): the first labelled documents of each class in hash order,
    at most ``per_class`` rows each, so that the sample is small enough to send
    to every task.  Rows that share an id are documents with that id's label;
    an id with both labels is a document of both classes."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id"))).distinct()
    chosen = None
    for value, most in per_class.items():
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = small_batches(docs).select(F.col("doc_id").alias("id"), F.col("text"))
    # An id may stand on many rows: the bound holds for the rows, in every task and in all.
    rows = texts.join(F.broadcast(chosen), "id").withColumn("tie", F.xxhash64("text"))
    place = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id", "tie")
    rows = rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= max(per_class.values()))
    bound = F.create_map(*[F.lit(x) for pair in per_class.items() for x in pair])
    return rows.where(F.col("place") <= bound[F.col("label")]).select("text", "label")


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Stochastic gradient descent, one document a step."""
    if len({y for y, _, _ in rows}) < 2:
        return Model(np.zeros(FEATURES, np.float32))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (FEATURES, DIM)).astype(np.float32)
    outputs = np.zeros((DIM, 2), np.float32)
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, ids, weights = rows[i]
            lr = rate * (1 - step / steps)
            step += 1
            if not len(ids):
                continue
            own = vectors[ids]
            mean = (weights[:, None] * own).sum(axis=0)
            z = mean @ outputs
            p = np.exp(z - z.max())
            error = p / p.sum()
            error[y] -= 1
            back = outputs @ error
            outputs -= lr * np.outer(mean, error)
            vectors[ids] = own - (lr * weights)[:, None] * back
    return Model((vectors * (outputs[:, 1] - outputs[:, 0])).sum(axis=1).astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    got = bags(sample(docs, labels, label, {0: per_class, 1: per_class})).collect()  # at most 2 * per_class rows
    rows = [(r["label"], np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["weights"], "<f4")) for r in got]
    return fit(sorted(rows, key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes())))


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    model = train(docs, labels, "quality", per_class)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)

    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))

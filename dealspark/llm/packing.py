"""Packing documents into sequences by cutting-stock column generation.

Documents become token ids; what exceeds ``capacity`` is cut off in whole
sequences, and the rest of each document is a piece to be packed.  Spark counts
the pieces by length class (``capacity / UNIT`` classes).  On these counts, a
few hundred numbers whatever the corpus, a linear program over patterns (how
many pieces of each class share a sequence) is solved by column generation:
the dual prices of the current patterns go into a knapsack dynamic program,
whose best filling becomes a new pattern while it improves the program.  The
solution is rounded down; the few pieces left over are packed first-fit
decreasing, again as patterns.

Each pattern then takes the next documents of its classes by rank: a piece's
rank in its class is counted in its task and offset by the tasks before, so
one length class, however common, is never sorted or gathered.

Defined results: null and empty texts are the end id alone; repeated ids and
rows are packed as documents of their own; an empty table gives an empty
result.  Only id and text are read, other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize
from .common import small_batches, worker_store

CAPACITY, END_ID = 4096, 2
UNIT = 16  # tokens; lengths are rounded up to it in the linear program
CACHED_WORDS = 700_000  # in a Python worker, some 200 bytes each
PLAIN = re.compile(r"[!-&(-~\u00a1-\u024f]+").fullmatch
PIECE = regex.compile(r"\p{L}+|\p{N}|[^\p{L}\p{N}]+").findall
# The byte-level alphabet: printable Latin-1 signs stand for themselves, the
# other bytes, in order, for the signs from U+0100 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, task int, at long"


class WordTokenizer:
    """Ids of a whole text, word by word through a cache.

    The tokenizer cuts at white space, so a text's ids are those of its words
    one after another, and cuts words into runs of letters, single digits and
    runs of other signs.  Words of plain signs (``PLAIN``: Latin letters that
    no normalisation changes, no apostrophe) are cut here, and their pieces go
    straight to the byte-pair model; any other word goes to the tokenizer, and
    so does, whole, a text that may hold a special token's string."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def piece(self, text: str) -> bytes:
        """Ids of a piece: its UTF-8 bytes, each as the model's sign for it."""
        signs = text if text.isascii() else text.encode().decode("latin-1").translate(BYTE_SIGNS)
        return array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()

    def learn(self, word: bytes) -> bytes:
        """Ids of a word not yet known; pieces of mixed words are known words too."""
        if word.isalpha():  # ASCII letters
            ids = self.piece(word.decode())
        elif (head := word[:-1]).isalpha() and word[-1] in b".,":
            ids = (self.known.get(head) or self.learn(head)) + (self.known.get(word[-1:]) or self.learn(word[-1:]))
        else:
            text = word.decode().lower()
            if not PLAIN(text):
                ids = self.whole(word.decode())
            elif len(pieces := PIECE(text)) == 1:
                ids = self.piece(text)
            else:
                ids = b"".join([self.known.get(p) or self.learn(p) for p in map(str.encode, pieces)])
        self.known[word] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        """Ids of a text (UTF-8), as little-endian 32-bit numbers."""
        if b"<|" in text:
            return self.whole(text.decode())
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        words = text.lower().split()  # ASCII capitals and ASCII white space, as the tokenizer does
        found = list(map(self.known.get, words))
        if None in found:
            found = [self.known.get(w) or self.learn(w) if f is None else f for w, f in zip(words, found)]
        return b"".join(found)


def cut_pieces(ids: bytes, end_id: int, capacity: int) -> tuple[list[tuple[int, int, int]], int]:
    """(start, length, crc32) of the pieces of one document, and its tokens."""
    raw = ids + np.array([end_id], "<u4").tobytes()
    n = len(raw) // 4
    return [(s, min(capacity, n - s), zlib.crc32(raw[s * 4:(s + capacity) * 4])) for s in range(0, n, capacity)], n


def pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           unit: int = UNIT, end_id: int = END_ID) -> DataFrame:
    """One row per piece; ``at`` is its number in its class in its task."""
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("word tokenizers")
        task = TaskContext.get().partitionId()
        counts = np.zeros(-(-capacity // unit) + 1, np.int64)
        for batch in batches:
            if vocabulary not in store:
                store[vocabulary] = WordTokenizer(vocabulary)
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                rows, of = [], []
                for i, text in enumerate(texts):
                    cut, n = cut_pieces(store[vocabulary].ids(text), end_id, capacity)
                    rows += [(s, m, crc, n) for s, m, crc in cut]
                    of += [i] * len(cut)
                start, length, crc, tokens = np.array(rows, np.int64).T
                group = -(-length // unit)
                at = counts[group]
                for c in np.unique(group):
                    own = group == c
                    at[own] += np.arange(own.sum())
                counts += np.bincount(group, minlength=len(counts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(of)), pa.array(start), pa.array(length), pa.array(crc), pa.array(tokens),
                     pa.array(group.astype(np.int32)), pa.array(np.full(len(group), task, np.int32)), pa.array(at)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "task", "at"])

    return small_batches(docs).select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(tokenize, PIECES)


def _knapsack(price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The dearest filling of ``capacity`` units with items of 1, 2, ... units."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        value = best[room - 1::-1][:len(price)] + price[:room]
        i = int(np.argmax(value))
        best[room], last[room] = (value[i], i + 1) if value[i] > best[room - 1] else (best[room - 1], 0)
    pattern, room = np.zeros(len(price), np.int64), capacity
    while room:
        if last[room]:
            pattern[last[room] - 1] += 1
        room -= max(1, last[room])
    return best[capacity], pattern


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    # Here and below without the linear-algebra library: its thread pool may
    # stall in a Spark driver, and a few hundred rows do not need it.
    return (matrix * vector).sum(axis=1)


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By Gauss-Jordan elimination with row pivots."""
    n = len(matrix)
    a = np.hstack([matrix, np.eye(n)])
    for i in range(n):
        pivot = i + int(np.argmax(np.abs(a[i:, i])))
        if pivot != i:
            a[[i, pivot]] = a[[pivot, i]]
        a[i] /= a[i, i]
        factors = a[:, i].copy()
        factors[i] = 0
        a -= factors[:, None] * a[i]
    return a[:, n:]


def linear_program(demand: np.ndarray, capacity: int, rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used in the relaxed program that
    covers ``demand[i]`` pieces of ``i + 1`` units with fewest sequences.
    Revised simplex over the classes that occur; the start is one class per
    pattern."""
    sizes = np.flatnonzero(demand) + 1
    need = demand[sizes - 1].astype(float)
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)  # column j: the pattern of basic variable j
    inverse, x = np.diag(1.0 / np.diag(basis)), need / np.diag(basis)
    for step in range(rounds):
        if step % 300 == 299:  # against rounding errors
            inverse = _inverse(basis)
            x = _times(inverse, need)
        dual = inverse.sum(axis=0)
        price = np.zeros(capacity)
        price[sizes - 1] = np.maximum(dual, 0)
        value, pattern = _knapsack(price, capacity)
        if value <= 1 + 1e-7:
            break
        column = pattern[sizes - 1].astype(float)
        move = _times(inverse, column)
        able = move > 1e-9
        if not able.any():
            break
        ratio = np.where(able, x / np.where(able, move, 1.0), np.inf)
        out = int(np.argmin(ratio))
        x = x - ratio[out] * move
        x[out] = ratio[out]
        basis[:, out] = column
        row = inverse[out] / move[out]
        inverse = inverse - np.outer(move, row)
        inverse[out] = row
    patterns = np.zeros((k, len(demand)), np.int64)
    patterns[:, sizes - 1] = basis.T.round().astype(np.int64)
    return patterns, np.maximum(_times(_inverse(basis), need), 0)


def first_fit(left: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns, one per sequence, for the pieces left over: largest first."""
    left, out = left.copy(), []
    while left.any():
        room, pattern = capacity, np.zeros(len(left), np.int64)
        for size in range(capacity, 0, -1):
            n = min(left[size - 1], room // size)
            if n:
                pattern[size - 1] += n
                left[size - 1] -= n
                room -= n * size
        out.append(pattern)
    return out


def solve(demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and whole numbers of sequences that cover ``demand`` exactly."""
    if not demand.any():
        return np.zeros((0, len(demand)), np.int64), np.zeros(0, np.int64)
    patterns, times = linear_program(demand, capacity)
    times = np.floor(times + 1e-6).astype(np.int64)
    for j in np.flatnonzero(times):  # rounding errors must not overdraw a class
        used = (patterns * times[:, None]).sum(axis=0)
        while times[j] and (patterns[j][used > demand] > 0).any():
            times[j] -= 1
            used = used - patterns[j]
    left = demand - (patterns * times[:, None]).sum(axis=0)
    rest, n = np.unique(first_fit(left, capacity), axis=0, return_counts=True) if left.any() else (patterns[:0], times[:0])
    patterns, times = np.vstack([patterns, rest]), np.concatenate([times, n])
    return patterns[times > 0], times[times > 0]


def shelves(patterns: np.ndarray, times: np.ndarray) -> pd.DataFrame:
    """For each class and pattern the ranks that the pattern takes: ``first``
    rank, ``each`` per sequence, first sequence ``base``."""
    base = np.cumsum(times) - times
    rows, used = [], np.zeros(patterns.shape[1], np.int64)
    for p, n, b in zip(patterns, times.tolist(), base.tolist()):
        for c in np.flatnonzero(p):
            rows.append((int(c) + 1, int(used[c]), int(p[c]), b))
            used[c] += p[c] * n
    return pd.DataFrame(rows, columns=["class", "first", "each", "base"]).sort_values(["class", "first"])


def pack(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         unit: int = UNIT, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.  ``vocabulary`` is the path of the tokenizer's file
    on the executors."""
    if capacity % unit:
        raise ValueError("unit must divide capacity")
    cut = materialize(pieces(docs, vocabulary, doc_id, text, capacity, unit, end_id), "packing-pieces")
    tasks = cut.groupBy("class", "task").agg(F.count("*").alias("n"))
    tasks = materialize(tasks, "packing-counts")
    demand = np.zeros(capacity // unit, np.int64)
    for r in tasks.groupBy("class").agg(F.sum("n").alias("n")).collect():  # at most one row per class
        demand[r["class"] - 1] = r["n"]
    plan = shelves(*solve(demand, capacity // unit))
    before = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("class", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(tasks, ["class", "task"]).withColumn("rank", F.col("before") + F.col("at"))
    by_class = {int(c): (g["first"].to_numpy(), g["each"].to_numpy(), g["base"].to_numpy()) for c, g in plan.groupby("class")}

    @F.pandas_udf("long")
    def sequence(classes: pd.Series, ranks: pd.Series) -> pd.Series:
        out = np.zeros(len(ranks), np.int64)
        for c, at in classes.groupby(classes).indices.items():
            first, each, base = by_class[int(c)]
            r = ranks.to_numpy()[at]
            i = np.searchsorted(first, r, "right") - 1
            out[at] = base[i] + (r - first[i]) // each[i]
        return pd.Series(out)

    placed = ranked.withColumn("sequence_id", sequence("class", "rank"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("bigint").alias("offset"))

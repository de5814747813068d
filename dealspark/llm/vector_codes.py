"""Vector codes by product quantisation, nearest entries through memoised cells.

Every vector becomes integers (``floor(scale * x)``) and is cut into equal
consecutive parts, each with a codebook of its own.  A part lies in a coarse
cell, the box of all integer points with the same ``floor(x / cell)`` in every
component.  For a cell the entries are bounded at once: an entry whose least
distance to the box exceeds the largest distance of some other entry can be
nearest to no point in it.  The entries that are left are cached under the
cell's coordinates (a dict compares them whole, so equal hashes do no harm),
and a part is evaluated exactly against the entries of its cell only.

A round reads the stored integers once.  Each task sums its parts by entry
before anything is shuffled, and what reaches the driver is one row per
codebook entry, whatever the size of the input.  The cache lives in a worker
across its tasks, is bounded by bytes and belongs to one codebook.

Defined results: rows whose vector is null, empty, or holds null or non-finite
components are dropped, and so are vectors of another length than the kept
vector with the smallest id (equal ids: the smallest integers).  Null ids come
last in that order and keep their rows.  Repeated rows are coded each.  With
fewer rows than entries the codebook is as small as the rows.  An empty table
gives an empty result.  Components beyond ``LIMIT`` fail the job, as their
squares would not fit the error; a length that cannot be cut into equal parts
fails it too.  Only id, vector and label are read, so other columns may have
any name.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import worker_store

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
CELL = 64  # side of a cell: 1/16 of the unit
LIMIT = 250_000.0  # largest component: 64 squares of differences fit a long
CACHE_BYTES = 64 << 20  # of a worker's memoised cells
ENTRY_BYTES = 250  # of a cell's dict entry beside its candidates
PAIRS = 1 << 18  # parts times entries evaluated at once


def integers(vector: Column, scale: int = SCALE) -> Column:
    """Components as integers; fails where one is too large."""
    scaled = F.transform(vector.cast("array<double>"), lambda x: F.when(F.abs(x) <= LIMIT, F.floor(x * scale)).otherwise(
        F.raise_error(F.lit(f"a vector component exceeds {LIMIT}"))).cast("int"))
    return scaled


def kept_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """(id, label, q) of the rows whose vector is whole, q its integers."""
    v = F.col(f"`{vector}`")
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = rows.where(v.isNotNull() & (F.size(v) > 0) & ~broken)
    return whole.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), integers(v, scale).alias("q"))


class Cells:
    """The entries of one codebook that can be nearest within a cell."""

    def __init__(self, book: np.ndarray, cell: int, memo: dict | None = None):
        self.book, self.cell, self.memo, self.bytes = book, cell, {} if memo is None else memo, 0

    def bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest squared distance of every entry to the boxes: per
        component a table over the coordinates that occur, then sums of rows."""
        low = np.zeros((len(cells), len(self.book)), np.int64)
        high = np.zeros_like(low)
        for d in range(cells.shape[1]):
            at, where = np.unique(cells[:, d], return_inverse=True)
            first, e = (at * self.cell)[:, None], self.book[:, d][None]
            last = first + self.cell - 1
            low += (np.maximum(np.maximum(first - e, e - last), 0) ** 2)[where]
            high += (np.maximum(np.abs(first - e), np.abs(last - e)) ** 2)[where]
        return low, high

    def candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """Per cell the entries, ascending, that none other dominates."""
        keys = [c.tobytes() for c in cells]
        new = [i for i, k in enumerate(keys) if k not in self.memo]
        found: dict[int, np.ndarray] = {}
        step = max(1, PAIRS // len(self.book))
        for at in range(0, len(new), step):
            some = new[at:at + step]
            low, high = self.bounds(cells[some])
            open_ = low <= high.min(axis=1)[:, None]
            ends = np.cumsum(open_.sum(axis=1))
            entries = np.nonzero(open_)[1].astype(np.int16)
            for i, e in zip(some, np.split(entries, ends[:-1])):
                found[i] = e.copy()
        out = [found[i] if i in found else self.memo[k] for i, k in enumerate(keys)]
        for i, e in found.items():
            self.bytes += e.nbytes + len(keys[i]) + ENTRY_BYTES
            if self.bytes > CACHE_BYTES:
                self.memo.clear()
                self.bytes = e.nbytes + len(keys[i]) + ENTRY_BYTES
            self.memo[keys[i]] = e
        return out

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per part its nearest entry (ties: the lower) and the squared distance."""
        cells, of = np.unique(parts // self.cell, axis=0, return_inverse=True)
        lists = self.candidates(cells)
        sizes = np.array([len(x) for x in lists])
        flat, begin = np.concatenate(lists).astype(np.int64), np.r_[0, np.cumsum(sizes)[:-1]]
        entry, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        of = of.reshape(-1)
        step = max(1, PAIRS // len(self.book))
        for at in range(0, len(parts), step):
            rows = np.arange(at, min(at + step, len(parts)))
            n = sizes[of[rows]]
            starts = np.r_[0, np.cumsum(n)[:-1]]
            which = np.repeat(begin[of[rows]] - starts, n) + np.arange(n.sum())
            e = flat[which]
            diff = np.repeat(parts[rows], n, axis=0) - self.book[e]
            dist = np.einsum("ij,ij->i", diff, diff)
            least = np.minimum.reduceat(dist, starts)
            entry[rows] = np.minimum.reduceat(np.where(dist == np.repeat(least, n), e, len(self.book)), starts)
            error[rows] = least
        return entry, error


def _worker_cells(name: str, books: np.ndarray, cell: int) -> list[Cells]:
    """The worker's caches for a codebook; those of an earlier one go."""
    store = worker_store("vector-cells")
    if store.get("name") != name:
        store.clear()
        store["name"] = name
        store["cells"] = [Cells(b, cell) for b in books]
    return store["cells"]


def _parts(batch: pa.RecordBatch, books: np.ndarray) -> np.ndarray:
    n, (parts, _, width) = batch.num_rows, books.shape
    return batch.column("q").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, parts, width)


def _sums(vectors: DataFrame, books: np.ndarray, cell: int) -> list:
    """(part, entry, n, sum of each component), one row per entry in use."""
    name, width = uuid.uuid4().hex, books.shape[2]
    columns = [f"s{i}" for i in range(width)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, total, count = _worker_cells(name, books, cell), np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _parts(batch, books)
            for p, c in enumerate(cells):
                entry, _ = c.nearest(q[:, p])
                np.add.at(total[p], entry, q[:, p])
                count[p] += np.bincount(entry, minlength=books.shape[1])
        part, entry = np.nonzero(count)
        used = total[part, entry]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(count[part, entry]), *[pa.array(used[:, i]) for i in range(width)]],
                                         names=["part", "entry", "n", *columns])

    schema = ", ".join(["part long", "entry long", "n long", *[f"{c} long" for c in columns]])
    found = vectors.select("q").mapInArrow(scan, schema)
    return found.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *columns)]).collect()


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> tuple[np.ndarray, int]:
    """The codebooks made of the first vectors, and the vectors' length."""
    order = [F.col("id").asc_nulls_last(), "q"]
    first = vectors.orderBy(*order).select(F.size("q").alias("n")).first()
    length = first["n"] if first else 0
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    head = vectors.where(F.size("q") == length).orderBy(*order).select("q").limit(entries).collect()
    q = np.array([r["q"] for r in head], np.int64).reshape(len(head), parts, length // parts)
    return q.transpose(1, 0, 2).copy(), length


def train(vectors: DataFrame, books: np.ndarray, rounds: int = ROUNDS, cell: int = CELL) -> np.ndarray:
    """The codebooks after ``rounds`` of assigning every part to its nearest
    entry and moving every used entry to the floor of its parts' mean."""
    for _ in range(rounds):
        moved = books.copy()
        for r in _sums(vectors, books, cell):
            moved[r["part"], r["entry"]] = [x // r["n"] for x in r[3:]]
        books = moved
    return books


def encode(vectors: DataFrame, books: np.ndarray, cell: int = CELL) -> DataFrame:
    """``vec_id, label, code, error`` of every row."""
    name = uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _worker_cells(name, books, cell)
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _parts(batch, books)
            found = [c.nearest(q[:, p]) for p, c in enumerate(cells)]
            codes = np.stack([e for e, _ in found], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(["".join(f"{x:02x}" for x in row) for row in codes.tolist()], pa.string()),
                 pa.array(sum(d for _, d in found))], names=["vec_id", "label", "code", "error"])

    kind = dict(vectors.dtypes)
    return vectors.select("id", "label", "q").mapInArrow(scan, f"vec_id {kind['id']}, label {kind['label']}, code string, error long")


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, cell: int = CELL, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: ``vec_id, code, error, label_error,
    codebooks_sha256``; ``label_error`` is the error summed over its label."""
    vectors = materialize(kept_vectors(rows, vec_id, vector, label, scale), "codes-integers")
    books, length = first_books(vectors, parts, entries)
    vectors = vectors.where(F.size("q") == length)
    books = train(vectors, books, rounds, cell)
    coded = materialize(encode(vectors, books, cell), "codes-coded")
    # Stored, so that Spark knows its size: broadcast if small, else shuffled with hot labels split.
    by_label = materialize(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "codes-labels")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))

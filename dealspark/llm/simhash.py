"""SimHash near-duplicates, candidates pruned by the pigeonring principle.

A fingerprint is cut into a ring of ``SEGMENTS`` segments.  If two fingerprints
differ in at most ``k`` bits, some start on the ring has, for every length
``l``, at most ``floor(l * k / SEGMENTS)`` differing bits in the first ``l``
segments from there.  For 16 segments and 3 bits that is none in 5 segments
(20 bits), at most one in 10 and at most two in 15.

Candidates meet by key: the start, the segments with budget zero, and one half
of the segments up to budget one (one differing bit leaves a half untouched).
Distinct fingerprints only, so a group of copies is one row.  Rows of a key
are compared in the task that holds it: first the chain budgets from that
start, then the full Hamming distance.  A task emits a spanning forest, not
all pairs: what is already connected is not compared again.

Defined results: null and empty texts, and texts without words, have the
fingerprint zero and are linked like any other; a null id cannot name a
component while another id can, and ids that are null or repeat link nothing;
rows that share id and text are one document.
Only id and text are read, other columns may have any name; empty tables give
empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import small_batches, words_of
from .components import connected

SHINGLE, MAX_BITS, SEGMENTS, SEED = 3, 3, 16, 42
WIDTH = 64 // SEGMENTS


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, each set if more than half of the shingles' hashes have it set."""
    words = [w.lower() for w in words_of(text)]
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    joined, k = b" ".join(words), min(shingle, len(words))
    starts = [0, *ends[: len(words) - k].tolist()]
    stops = (ends[k - 1:] - 1).tolist()
    h = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 65536):
        hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts[at:at + 65536], stops[at:at + 65536])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp, text_hash): the fingerprint as the signed 64-bit number of its
    bits, and a hash of the text that tells rows of one id apart."""
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([text_fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    body = F.col(f"`{text}`")
    return small_batches(docs).select(F.col(f"`{doc_id}`").alias("id"), fingerprint(body).alias("fp"), F.xxhash64(body).alias("text_hash"))


def budgets(max_bits: int) -> list[tuple[int, int]]:
    """(bits of the prefix, differing bits allowed in it): the longest chain for each budget."""
    out = []
    for b in range(max_bits + 1):
        longest = SEGMENTS if b == max_bits else -(-(b + 1) * SEGMENTS // max_bits) - 1
        out.append((longest * WIDTH, b))
    return out


def _rotated(start: int) -> str:
    s = start * WIDTH
    return "fp" if s == 0 else f"(shiftleft(fp, {s}) | shiftrightunsigned(fp, {64 - s}))"


def keyed(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp, rep): two rows for each start on the ring."""
    exact, second = budgets(max_bits)[0][0], budgets(max_bits)[1][0]
    half = (second - exact) // 2
    keys = []
    for start in range(SEGMENTS):
        x = _rotated(start)
        for part, skip in ((0, exact), (1, second - half)):
            low = f"(shiftrightunsigned({x}, {64 - skip - half}) & {(1 << half) - 1})"
            keys.append(f"{(start * 2 + part) << 40}L + shiftleft(shiftrightunsigned({x}, {64 - exact}), {half}) + {low}")
    return distinct.select(F.explode(F.array(*[F.expr(k) for k in keys])).alias("key"), "fp", "rep")


def _near(xor: np.ndarray, start: np.ndarray | int, limits: list[tuple[int, int]]) -> np.ndarray:
    """Whether the chain from ``start`` keeps its budgets, the last being the full distance."""
    s = np.asarray(start, np.uint64) * np.uint64(WIDTH)
    turned = (xor << s) | np.where(s > 0, xor >> ((np.uint64(64) - s) & np.uint64(63)), np.uint64(0))
    ok = np.ones(xor.shape, bool)
    for bits, most in limits:
        ok &= np.bitwise_count(turned >> np.uint64(64 - bits)) <= most
    return ok


def _forest(fp: np.ndarray, rep: np.ndarray, start: int, limits: list[tuple[int, int]]) -> tuple[list, list]:
    """Links that connect what the near pairs of one key connect: breadth
    first, each reached fingerprint is compared with those not yet reached."""
    left = np.arange(len(fp))
    a, b = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = _near(fp[left] ^ fp[x], start, limits)
            found = left[hit]
            a += [rep[x]] * len(found)
            b += rep[found].tolist()
            queue += found.tolist()
            left = left[~hit]
    return a, b


def links(distinct: DataFrame, max_bits: int = MAX_BITS, small: int = 8) -> DataFrame:
    """(a, b) between representatives: enough links to connect all near pairs."""
    limits = budgets(max_bits)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []  # rows of a key that may go on in the next batch
        for batch in batches:
            if len(batch) == 0:
                continue
            if rest and batch["key"].iloc[0] == batch["key"].iloc[-1] == rest[-1]["key"].iloc[-1]:
                rest.append(batch)
                continue
            rows = pd.concat([*rest, batch]) if rest else batch
            cut = int(np.searchsorted(rows["key"].to_numpy(), rows["key"].iloc[-1], "left"))
            rest = [rows.iloc[cut:]]
            yield from within(rows.iloc[:cut])
        if rest:
            yield from within(pd.concat(rest))

    def within(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        key, fp, rep = rows["key"].to_numpy(), rows["fp"].to_numpy().view(np.uint64), rows["rep"].to_numpy()
        if len(key) < 2:
            return
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[first, len(key)])
        of = np.repeat(size, size)
        start = key >> 41
        for d in range(1, small):
            i = np.flatnonzero((key[d:] == key[:-d]) & (of[d:] <= small))
            i = i[_near(fp[i] ^ fp[i + d], start[i], limits)]
            if len(i):
                yield pd.DataFrame({"a": rep[i], "b": rep[i + d]})
        for f, n in zip(first[size > small].tolist(), size[size > small].tolist()):
            a, b = _forest(fp[f:f + n], rep[f:f + n], int(start[f]), limits)
            if a:
                yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    by_key = keyed(distinct, max_bits).repartition("key").sortWithinPartitions("key", "fp")
    return by_key.mapInPandas(compare, "a long, b long")


def _classes(docs: DataFrame, doc_id: str, text: str, shingle: int, max_bits: int) -> DataFrame:
    """(id, fp, text_hash, best) for every row, ``best`` being the first (id,
    text_hash) of its component, rows without an id last.  Fingerprints are the
    nodes of the graph: ids may be null or repeat."""
    if not 1 <= max_bits <= 7:
        raise ValueError("max_bits must lie between 1 and 7")
    prints = materialize(fingerprints(docs, doc_id, text, shingle), "simhash-fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash")).alias("best")
    distinct = materialize(prints.groupBy("fp").agg(first), "simhash-distinct")
    root = connected(links(distinct.select("fp", F.col("fp").alias("rep")), max_bits))
    # Only fingerprints with a link can take their row from another one.
    linked = distinct.join(root, distinct["fp"] == root["node"]).select("fp", "component", "best")
    linked = materialize(linked, "simhash-linked")
    chosen = materialize(linked.groupBy("component").agg(F.min("best").alias("chosen")), "simhash-chosen")
    chosen = linked.join(chosen, "component").select(F.col("fp").alias("linked_fp"), "chosen")
    of_print = distinct.join(chosen, distinct["fp"] == chosen["linked_fp"], "left").select("fp", F.coalesce("chosen", "best").alias("best"))
    # Stored, so that the join has shuffles of its own and can split a fingerprint that many rows share.
    return prints.join(materialize(of_print, "simhash-named"), "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` differing bits."""
    return _classes(docs, doc_id, text, shingle, max_bits).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("best.id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, with the smallest id and of its texts
    the one with the smallest hash, all columns unchanged."""
    found = _classes(docs, doc_id, text, shingle, max_bits)
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("text_hash") == F.col("best.text_hash"))
    gone = found.where(~stays).select(F.col("id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    # Stored, so that Spark knows its size and joins accordingly.
    gone = materialize(gone.distinct(), "simhash-dropped")
    same = docs[doc_id].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs[text]) == gone["gone_hash"])
    return docs.join(gone, same, "left_anti")

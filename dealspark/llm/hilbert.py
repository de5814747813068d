"""Sharding along a Hilbert curve.

Metadata columns (here source, language and size) become coordinates of a
grid: the number of quantile cuts below the value.  Text columns are ordered
by the 7 bytes after the prefix that all their values share.  Documents are
sorted by their place on the Hilbert curve through the grid and the order is
cut into runs, so that each file covers a small box in every dimension and
min/max statistics prune on any of them.

The global order is one range shuffle of narrow rows; a row's rank is its
number within its partition plus the rows of the partitions before.  The runs
follow the law ``rows``: counts differ by one at most.

The curve's state table is computed from the Gray code rules of Hamilton's
"Compact Hilbert indices" (Dalhousie CS-2006-07).

Defined results: null values of a dimension come last on its axis; null texts
have no bytes (size 1) and crc 0; repeated rows take neighbouring slots; an
empty table gives an empty result.  Columns are taken under own names, so
other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize
from .common import packed

SHARDS, BITS = 8, 5
CODE_BYTES = 7


def curve_table(dims: int) -> tuple[list[int], list[int]]:
    """(digit, next state) at ``state * 2 ** dims + cell``; a state is entry
    corner times ``dims`` plus direction, the first is 0."""
    size = 1 << dims

    def turn(x: int, by: int) -> int:  # to the left, within dims bits
        by %= dims
        return (x << by | x >> (dims - by)) & (size - 1)

    def gray(w: int) -> int:
        return w ^ w >> 1

    def rank(code: int) -> int:
        return next(w for w in range(size) if gray(w) == code)

    def entry(w: int) -> int:
        return gray((w - 1) // 2 * 2) if w else 0

    def direction(w: int) -> int:
        v = w if w % 2 else w - 1
        return (~v & v + 1).bit_length() - 1 if w else 0  # trailing ones

    digits, states = [], []
    for state in range(size * dims):
        corner, axis = divmod(state, dims)
        for cell in range(size):
            w = rank(turn(cell ^ corner, -(axis + 1)))
            digits.append(w)
            states.append((corner ^ turn(entry(w), axis + 1)) * dims + (axis + direction(w) + 1) % dims)
    return digits, states


def curve_index(cells: list[str], bits: int) -> Column:
    """Place on the curve of the grid cell given by columns ``cells``."""
    dims = len(cells)
    digits, states = (f"array({','.join(map(str, x))})" for x in curve_table(dims))
    cell = " | ".join(f"shiftleft(shiftright({c}, level) & 1, {d})" for d, c in enumerate(cells))
    at = f"(acc.state * {1 << dims} + ({cell}))"
    return F.expr(f"aggregate(sequence({bits - 1}, 0, -1), named_struct('state', 0, 'place', 0L), (acc, level) -> "
                  f"named_struct('state', {states}[{at}], 'place', acc.place * {1 << dims} + {digits}[{at}]), acc -> acc.place)")


def _code(value: Column, skip: int) -> Column:
    """A number that orders strings by their bytes from ``skip`` on."""
    part = F.substring(F.encode(value, "UTF-8"), skip + 1, CODE_BYTES)
    return F.conv(F.rpad(F.hex(part), 2 * CODE_BYTES, "0"), 16, 10).cast("bigint")


def _shared_prefix(low: str | None, high: str | None) -> int:
    a, b = (low or "").encode(), (high or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def on_grid(rows: DataFrame, dims: list[str], bits: int) -> tuple[DataFrame, list[str]]:
    """Grid coordinates ``cell_0``, ``cell_1``, ... of the columns ``dims``."""
    texts = [d for d in dims if dict(rows.dtypes)[d] == "string"]
    ends = rows.agg(F.lit(0), *[f(d).alias(f"{n}_{i}") for i, d in enumerate(texts) for n, f in (("low", F.min), ("high", F.max))]).first()
    code = {d: F.col(d).cast("bigint") for d in dims}
    code |= {d: _code(F.col(d), _shared_prefix(ends[f"low_{i}"], ends[f"high_{i}"])) for i, d in enumerate(texts)}
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = rows.agg(*[F.percentile_approx(code[d], shares).alias(f"cut_{i}") for i, d in enumerate(dims)]).first()
    out, cells = rows, []
    for i, d in enumerate(dims):
        below = [F.when(code[d] > c, 1).otherwise(0) for c in cuts[f"cut_{i}"] or []]
        place = F.when(F.col(d).isNull(), F.lit((1 << bits) - 1)).otherwise(sum(below, F.lit(0)))
        out, cells = out.withColumn(f"cell_{i}", place.cast("int")), [*cells, f"cell_{i}"]
    return out, cells


def _narrow(doc_id: Column, text: Column, source: Column, lang: Column) -> list[Column]:
    body = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    return [doc_id.alias("doc_id"), source.alias("source"), lang.alias("lang"),
            (F.octet_length(body) + 1).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32")]


def ranked(rows: DataFrame, dims: list[str], order: list[str], bits: int = BITS) -> DataFrame:
    """``rows`` with ``place`` on the curve, their gapless ``rank`` in the order
    of (place, *order*) and the number of ``total`` rows."""
    placed, cells = on_grid(rows, dims, bits)
    placed = placed.withColumn("place", curve_index(cells, bits)).drop(*cells)
    keys = ["place", *order]
    lined = placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    lined = materialize(lined.withColumn("line", F.monotonically_increasing_id()), "hilbert-order")
    parts = lined.groupBy(F.shiftright("line", 33).alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    # One row per shuffle partition.
    out = lined.withColumn("part", F.shiftright("line", 33)).join(F.broadcast(parts), "part")
    return out.withColumn("rank", F.col("before") + F.col("line").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "before", "line")


def _cut(rows: DataFrame, shards: int) -> DataFrame:
    out = rows.withColumn("shard", F.expr(f"CAST(rank * {shards} DIV total AS INT)"))
    return out.withColumn("slot", F.expr(f"rank - (shard * total + {shards - 1}) DIV {shards}"))


def shards(docs: DataFrame, n_shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", source: str = "source",
           lang: str = "lang", bits: int = BITS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot`` (and
    its ``place``).  Texts are read once and not shuffled."""
    rows = materialize(docs.select(*_narrow(*(F.col(f"`{c}`") for c in (doc_id, text, source, lang)))), "hilbert-rows")
    return _cut(ranked(rows, ["source", "lang", "size"], ["doc_id", "text_crc32", "size"], bits), n_shards).select(
        "doc_id", "size", "text_crc32", "shard", "slot", "place")


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
                 source: str = "source", lang: str = "lang", bits: int = BITS, rows_per_file: int = 100_000,
                 shard_column: str = "shard") -> None:
    """Write whole documents as Parquet under ``path/<shard_column>=N``, in curve
    order with ``rows_per_file`` rows to a file, so that file statistics prune."""
    rows = packed(docs, "document")
    rows = rows.select("document", *_narrow(*(F.col(f"document.`{c}`") for c in (doc_id, text, source, lang))))
    cut = _cut(ranked(rows, ["source", "lang", "size"], ["doc_id", "text_crc32", "size"], bits), n_shards)
    cut = cut.withColumn("run", F.expr(f"slot DIV {rows_per_file}"))
    out = cut.repartitionByRange("shard", "run").sortWithinPartitions("shard", "slot")
    out.select("document.*", F.col("shard").alias(shard_column)).write.option("maxRecordsPerFile", rows_per_file).partitionBy(shard_column).parquet(path)

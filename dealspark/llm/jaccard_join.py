"""Near-duplicates by the Jaccard similarity of word shingles, joined in tiles.

A document's set are the 64-bit hashes of its distinct shingles; documents
with equal sets are one class, told apart by a 128-bit digest.  Two classes
link when 100 * intersection >= percent * union, so with a and b shingles they
differ in at most ``(a + b) * (100 - percent) / (100 + percent)`` of them.

Tiles are banded by size: a set enters the band of its size, and the next one
if a set there may link to it.  A band cuts the range of hashes into macro
segments of about ``MACRO`` shingles, and each of them into small segments,
one more than differences that a macro segment may hold on average.  If two
sets link, some macro segment has no more differences than that, and in it
some small segment is equal in both: a tile is a band, a place, and the hash
of what a small segment holds.  No set is compared with another one that it
shares no tile with, and no link is lost.

A tile's rows carry a bitmap of 64 bits, each flipped by every shingle of the
macro segment that hashes to it.  Differing bits are at most the differing
shingles, so their count bounds the overlap from above.  Only pairs whose
sizes and bitmaps allow it reach the exact intersection of sorted arrays.

1. Tiles are sorted by ranges of (tile, set), which also cuts a tile that
   many sets share, and each row is tried with the first one of its tile and
   ``WINDOW`` neighbours before it: a group of near copies is linked by a few
   pairs per row.
2. In tiles that still hold more than one component all pairs of different
   components are tried.  Beyond ``LIMIT`` rows a tile is cut into blocks: the
   rows of its largest component meet those of the others, and these each
   other, never all rows all rows.  A longer bitmap of the whole sets, which
   only these rows carry, bounds their overlap a second time.

Defined results: words are runs between ASCII white space, A-Z lower-cased; a
text with fewer words than a shingle is one shingle; null texts and texts
without words have no shingle and link with nothing, each its own component.
A null id cannot name a component while another id can; rows that share an id
are documents of their own.  Only id and text are read, other columns may have
any name; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import small_batches, words_of
from .components import connected

SHINGLE, PERCENT = 3, 90
MACRO = 64  # shingles a macro segment holds, and bits of its bitmap
GROWTH = 1.5  # of one band's least size to the next one's
WINDOW = 3  # neighbours a row is tried with at first
LIMIT = 256  # rows of a tile, or of a block of it, compared in one go
STEP = 256  # rows of a block compared with all others at once
SMALL = 8  # rows of units that are compared many at once
SIGNATURE = 1024  # bits of a whole set's bitmap
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))  # odd multipliers


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * A
    h = (h ^ (h >> np.uint64(29))) * B
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    words = [w.lower() for w in words_of(text)]
    if not words:
        return np.zeros(0, np.uint64)
    hashes = xxhash.xxh64_intdigest
    w = np.array([hashes(x) for x in words], np.uint64)
    k = min(shingle, len(w))
    out = np.full(len(w) - k + 1, np.uint64(k) * C)
    for i in range(k):
        out = mixed(out + w[i:len(w) - k + 1 + i] * A)
    return np.unique(out)


def bands(percent: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """Per band its least size, differences, macro segments, small segments of each."""
    least = [1]
    while least[-1] < 1 << 40:
        least.append(max(least[-1] + 1, int(least[-1] * GROWTH)))
    differ = [2 * (top - 1) * (100 - percent) // (100 + percent) for top in least[1:]]
    macros = [-(-(top - 1) // MACRO) for top in least[1:]]
    return least, differ, macros, [d // m + 1 for d, m in zip(differ, macros)]


def tiles_of(s: np.ndarray, percent: int, table: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the tiles of a set, the bitmap at each and its band's macro
    segments; ``table`` holds the bands."""
    least, _, macros, smalls = table
    own = int(np.searchsorted(least, len(s), "right")) - 1
    keys, maps, counts = [], [], []
    for band in (own, own + 1):
        if band > own and 100 * len(s) < percent * least[band]:
            break
        m, g = macros[band], smalls[band]
        macro = ((s >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        small = macro * g + (((s >> np.uint64(12)) & np.uint64(0xFFFFF)) * np.uint64(g) >> np.uint64(20)).astype(np.int64)
        odd = np.bincount(macro * 64 + (s & np.uint64(63)).astype(np.int64), minlength=64 * m) & 1
        bitmap = np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")
        held = np.zeros(m * g, np.uint64)
        np.add.at(held, small, mixed(s + C))
        place = np.arange(m * g, dtype=np.uint64) + np.uint64(band << 48)
        keys.append(mixed(held * B + mixed(place)))
        maps.append(np.repeat(bitmap, g))
        counts.append(np.full(m * g, m, np.int32))
    return np.concatenate(keys), np.concatenate(maps), np.concatenate(counts)


def signature_of(s: np.ndarray) -> bytes:
    """A bitmap of the whole set, each bit flipped by what hashes to it."""
    odd = np.bincount(((s >> np.uint64(6)) & np.uint64(SIGNATURE - 1)).astype(np.int64), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def digest_of(s: np.ndarray) -> bytes:
    return hashlib.sha256(s.tobytes()).digest()[:16]


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(id, text_hash, n, digest, signature, tiles) of every document."""
    table = bands(percent)
    kind = pa.struct([("key", pa.int64()), ("bitmap", pa.int64()), ("macros", pa.int32())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, signs, keys, maps, counts, ends = [], [], [], [], [], [], [0]
            for t in batch.column("body"):
                s = shingle_set(t.as_py(), shingle)
                n.append(len(s))
                digests.append(digest_of(s) if len(s) else None)
                signs.append(signature_of(s) if len(s) else None)
                if len(s):
                    for found, part in zip((keys, maps, counts), tiles_of(s, percent, table)):
                        found.append(part)
                ends.append(ends[-1] + (len(keys[-1]) if len(s) else 0))
            join = lambda x, t: np.concatenate(x).view(t) if x else np.zeros(0, t)
            tiles = pa.StructArray.from_arrays([pa.array(join(keys, np.int64)), pa.array(join(maps, np.int64)), pa.array(join(counts, np.int32))], fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signs, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tiles)],
                names=["id", "text_hash", "n", "digest", "signature", "tiles"])

    body = F.col(f"`{text}`")
    rows = small_batches(docs).select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))
    return rows.mapInArrow(scan, f"id {dict(rows.dtypes)['id']}, text_hash long, n long, digest binary, signature binary, "
                                 "tiles array<struct<key: long, bitmap: long, macros: int>>")


class _May:
    """Whether the sizes and bitmaps of two rows of a tile allow a link."""

    def __init__(self, percent: int):
        self.percent = percent

    def differ(self, n1, n2):
        return (n1 + n2) * (100 - self.percent) // (100 + self.percent)

    def __call__(self, n1, map1, n2, map2, macros):
        return (100 * np.minimum(n1, n2) >= self.percent * np.maximum(n1, n2)) & (np.bitwise_count(map1 ^ map2) <= self.differ(n1, n2) // macros)

    def whole(self, n1, sign1, n2, sign2):
        """By the bitmaps of the whole sets."""
        return np.bitwise_count(sign1 ^ sign2).sum(axis=-1, dtype=np.int64) <= self.differ(n1, n2)


TILE = ["key", "node", "n", "bitmap", "macros"]


def shared_tiles(classes: DataFrame, percent: int = PERCENT, window: int = WINDOW) -> DataFrame:
    """The rows of tiles that more than one class may share, each with the
    first row of the tile in its task (``p0``) and the neighbours before it
    (``p1``..) where it may link to them."""
    near = [f"p{d}" for d in range(window + 1)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = _May(percent)
        done, first = 0, True  # rows of ``held`` that were given out before
        held, leader = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy() for c in TILE]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            out, leader = given(held, done, len(held[0]) - 1, first, leader, may)
            yield out
            first = False
            cut = max(0, len(held[0]) - 1 - window)
            done, held = len(held[0]) - 1 - cut, [x[cut:] for x in held]
        if held is not None:
            yield given(held, done, len(held[0]), first, leader, may, last=True)[0]

    def given(rows: list, start: int, stop: int, first: bool, leader: tuple | None, may: _May, last: bool = False) -> tuple:
        """The rows from ``start`` to ``stop`` whose tile has other rows (it
        may go on beyond both ends of a task), and the leader of the last tile."""
        key, node, n, bits, macros = rows
        new = np.r_[True, key[1:] != key[:-1]]
        head = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        lead = [x[head] for x in (node, n, bits)]
        if leader is not None:  # a tile that began before the rows held
            for x, value in zip(lead, leader[1:]):
                x[key == leader[0]] = value
        same = np.r_[first, ~new[1:], last]
        at = np.arange(start, stop)
        at = at[same[at] | same[at + 1]]
        partners = [(lead[0][at], (lead[0][at] != node[at]) & may(n[at], bits[at], lead[1][at], lead[2][at], macros[at]))]
        for d in range(1, window + 1):
            i = np.maximum(at - d, 0)
            partners.append((node[i], (at >= d) & (key[at] == key[i]) & may(n[at], bits[at], n[i], bits[i], macros[at])))
        arrays = [pa.array(x[at]) for x in rows] + [pa.array(x, mask=~ok) for x, ok in partners]
        return pa.RecordBatch.from_arrays(arrays, names=[*TILE, *near]), (key[-1], *[x[-1] for x in lead])

    tiles = classes.select("node", "n", F.explode("tiles").alias("t")).select("t.key", "node", "n", "t.bitmap", "t.macros")
    tiles = tiles.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    return tiles.mapInArrow(scan, "key long, node long, n long, bitmap long, macros int, " + ", ".join(f"{c} long" for c in near))


def first_pairs(tiles: DataFrame, window: int = WINDOW) -> DataFrame:
    by = tiles.select("node", F.explode(F.array(*[F.col(f"p{d}") for d in range(window + 1)])).alias("other")).where("other IS NOT NULL")
    return by.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def other_pairs(tiles: DataFrame, components: DataFrame, signatures: DataFrame, percent: int = PERCENT, limit: int = LIMIT) -> DataFrame:
    """All pairs of different components in a tile that may link; given
    (node, component) where linked and (node, signature)."""
    half = lambda at: F.conv(F.hex(F.substring("component", at, 8)), 16, -10).cast("bigint")
    # A node without a component is one.
    rows = tiles.select(*TILE).join(components, "node", "left")
    rows = rows.select(*TILE, F.coalesce(half(1), "node").alias("of1"), F.coalesce(half(9), F.lit(0)).alias("of2"))
    rows = materialize(rows, "jaccard-tiles")
    parts = rows.groupBy("key", "of1", "of2").agg(F.count("*").alias("rows"))
    open_ = parts.groupBy("key").agg(F.count("*").alias("components"), F.sum("rows").alias("rows"), F.max(F.struct("rows", "of1", "of2")).alias("most"))
    blocks = lambda c: F.ceil(c / limit).cast("long")
    open_ = open_.where("components > 1").select("key", (F.col("rows") <= limit).alias("small"), "most.of1", "most.of2", blocks(F.col("most.rows")).alias("majors"),
                                                 blocks(F.col("rows") - F.col("most.rows")).alias("minors"))
    open_ = materialize(open_.withColumnsRenamed({"of1": "top1", "of2": "top2"}), "jaccard-open")
    rows = rows.join(open_, "key").withColumn("major", (F.col("of1") == F.col("top1")) & (F.col("of2") == F.col("top2")))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", "key"), F.when(F.col("major"), F.col("majors")).otherwise(F.col("minors"))))
    unit = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"))
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    units = (F.when(F.col("small"), F.array(unit(0, F.lit(0), F.lit(0))))
             .when(F.col("major"), F.transform(upto("minors"), lambda j: unit(1, F.col("block"), j)))
             .otherwise(F.concat(F.transform(upto("majors"), lambda i: unit(1, i, F.col("block"))),
                                 F.transform(upto("minors"), lambda j: unit(2, F.least(j, F.col("block")), F.greatest(j, F.col("block")))))))
    where, of = ["key", "kind", "i", "j"], ["of1", "of2", "major"]
    rows = rows.join(signatures, "node").select(*TILE, *of, "signature", F.explode(units).alias("u")).select(*TILE, *of, "signature", "u.*")
    columns = [*where, "node", "n", "bitmap", "macros", *of]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may, rest = _May(percent), None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
            rows.append(np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u8").reshape(batch.num_rows, -1))
            rows = rows if rest is None else [np.concatenate(x) for x in zip(rest, rows)]
            first = np.flatnonzero(starts(rows))
            yield from within([x[:first[-1]] for x in rows], may)
            rest = [x[first[-1]:] for x in rows]  # its unit may go on; a unit is bounded
        if rest is not None:
            yield from within(rest, may)

    def starts(rows: list) -> np.ndarray:
        return np.r_[True, np.any([x[1:] != x[:-1] for x in rows[:len(where)]], axis=0)]

    def within(rows: list, may: _May) -> Iterator[pa.RecordBatch]:
        _, kind, _, _, node, n, bits, macros, of1, of2, major, sign = rows
        if len(node) < 2:
            return
        first = np.flatnonzero(starts(rows))
        size = np.diff(np.r_[first, len(node)])
        unit, of = np.repeat(np.arange(len(first)), size), np.repeat(size, size)

        def passed(i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
            ok = ((of1[i] != of1[j]) | (of2[i] != of2[j])) & ((kind[i] != 1) | (major[i] != major[j])) & may(n[i], bits[i], n[j], bits[j], macros[i])
            i, j = i[ok], j[ok]
            ok = may.whole(n[i], sign[i], n[j], sign[j])
            a, b = node[i[ok]], node[j[ok]]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for d in range(1, SMALL):
            i = np.flatnonzero((unit[d:] == unit[:-d]) & (of[d:] <= SMALL))
            yield from passed(i, i + d)
        for f, m in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist()):
            for x in range(f, f + m, STEP):
                i, j = np.meshgrid(np.arange(x, min(x + STEP, f + m)), np.arange(x, f + m), indexing="ij")
                yield from passed(i[i < j], j[i < j])

    # By number, as few bytes make much work here: adaptive coalescing goes by bytes.
    dealt = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *where).sortWithinPartitions(*where)
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             percent: int = PERCENT) -> DataFrame:
    """(a, b) digests of the pairs whose sets link, by exact intersection.  The
    sets are made again from one text of each class in a pair."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = classes.join(nodes, "node").select("node", "best")
    wanted = materialize(wanted.select(F.col("best.id").alias("wanted_id"), F.col("best.text_hash").alias("wanted_hash")), "jaccard-wanted")
    body = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))
    rows = rows.join(wanted, F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("text_hash") == F.col("wanted_hash")), "left_semi")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), shingle) for t in batch.column("body")]
            digests = [digest_of(s) for s in found]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            held = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([_node(d) for d in digests], pa.int64()), pa.array(digests, pa.binary()),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(held))], names=["node", "digest", "hashes"])

    made = small_batches(rows).select("body").mapInArrow(scan, "node long, digest binary, hashes array<long>")
    made = materialize(made.groupBy("digest").agg(F.first("node").alias("node"), F.first("hashes").alias("hashes")), "jaccard-sets")

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                # In the order of unsigned numbers, as they were made.
                x, y = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                x, y = (x, y) if len(x) < len(y) else (y, x)
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64())).select(["da", "db"])

    side = lambda name, key, d: made.select(F.col("node").alias(key), F.col("digest").alias(d), F.col("hashes").alias(name))
    both = pairs.join(side("x", "a", "da"), "a").join(side("y", "b", "db"), "b").select("da", "db", "x", "y")
    return small_batches(both).mapInArrow(intersect, "da binary, db binary").select(F.col("da").alias("a"), F.col("db").alias("b"))


def _classes(docs: DataFrame, doc_id: str, text: str, shingle: int, percent: int, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored: sets of the documents, classes, and (digest, component) of linked classes."""
    if not 0 < percent <= 100:
        raise ValueError("percent must lie between 1 and 100")
    found = materialize(sets(docs, doc_id, text, shingle, percent), "jaccard-documents")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash")).alias("best")
    classes = found.where("n > 0").groupBy("digest").agg(first, F.first("n").alias("n"), F.first("signature").alias("signature"),
                                                          F.first("tiles").alias("tiles"))
    # The node is the first 8 bytes; classes that share one are told apart when pairs are verified.
    node = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("bigint")
    classes = materialize(classes.withColumn("node", node), "jaccard-classes")
    tiles = materialize(shared_tiles(classes, percent), "jaccard-shared")
    pairs = materialize(first_pairs(tiles), "jaccard-pairs")
    links = materialize(verified(pairs, classes, docs, doc_id, text, shingle, percent), "jaccard-links")
    components = connected(links)
    named = classes.select("digest", "node").join(components, F.col("digest") == components["node"]).select(classes["node"], "component")
    rest = other_pairs(tiles, materialize(named, "jaccard-components"), classes.select("node", "signature"), percent, limit)
    rest = rest.join(pairs, ["a", "b"], "left_anti")
    rest = materialize(rest, "jaccard-rest")
    if not rest.isEmpty():
        more = materialize(verified(rest, classes, docs, doc_id, text, shingle, percent), "jaccard-links")
        components = connected(links.unionByName(more))
    return found, classes, components


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
                    limit: int = LIMIT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``, the smallest
    id reachable over links of at least ``percent`` similarity."""
    found, classes, components = _classes(docs, doc_id, text, shingle, percent, limit)
    linked = classes.select("digest", "best").join(components, F.col("digest") == F.col("node")).select("digest", "component", "best")
    linked = materialize(linked, "jaccard-linked")
    chosen = materialize(linked.groupBy("component").agg(F.min("best").alias("chosen")), "jaccard-chosen")
    chosen = linked.join(chosen, "component").select(F.col("digest").alias("linked"), "chosen")
    of_class = classes.select("digest", "best").join(chosen, F.col("digest") == F.col("linked"), "left")
    # Stored, so that the join has shuffles of its own and can split a large group of copies.
    of_class = materialize(of_class.select("digest", F.coalesce("chosen", "best")["id"].alias("component_id")), "jaccard-named")
    out = ["id", "n", "component_id"]
    named = found.where("n > 0").select("digest", "id", "n").join(of_class, "digest").select(*out)
    return named.unionByName(found.where("n = 0").select("id", "n", F.col("id").alias("component_id"))).toDF("doc_id", "n_shingles", "component_id")

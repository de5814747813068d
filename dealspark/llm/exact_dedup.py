"""Exact deduplication with an extendible-hash index on shared files.

Texts are equal when identical after white space is deleted.  Three tables in
the folder of ``spark.checkpoint.dir`` make up the index:

* ``keys``: one narrow row per document (hash, length, SHA-256), from one scan.
* ``index``: one row per distinct hash with its number of documents, in the
  bucket that a directory names.  The directory doubles (looks at one more
  leading bit) wherever a bucket holds more than ``capacity`` hashes; bucket
  files are written by owner tasks, each with a range of (bucket, hash).
* ``chains``: the documents whose hash is not alone, with their texts, again
  by ranges of (bucket, hash, id), so that one group of copies is spread over
  many tasks.

Inside a chain the texts themselves are compared, byte by byte, by grouping on
hash and text: copies collapse in each task before anything is shuffled.  A
hash that stands alone proves its text unique, so no other text is moved.

Of equal texts the row with the most code points in the original text stays,
then the smallest id, then (rows that repeat an id) one of them.  Null texts
count as empty and are equal to each other and to texts of white space only;
a null id stays only if its group has no other.  An empty table gives an empty
result.  Other columns are carried in a struct, so their names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE, packed

CAPACITY = 100_000  # hashes a bucket holds before it splits
MAX_DEPTH = 16  # the directory has at most 2 ** MAX_DEPTH slots
FILTER_BITS = 24  # 2 MiB


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def _hashed(docs: DataFrame, doc_id: str, text: str, hash_bits: int) -> DataFrame:
    """row, id, norm, points, h."""
    out = packed(docs).select("row", F.col(f"row.`{doc_id}`").alias("id"), normalised(F.col(f"row.`{text}`")).alias("norm"),
                              F.char_length(F.coalesce(F.col(f"row.`{text}`"), F.lit(""))).cast("bigint").alias("points"))
    return out.withColumn("h", F.xxhash64("norm").bitwiseAND(F.lit(-1 << (64 - hash_bits))))


def directory(hashes: DataFrame, capacity: int, max_depth: int) -> tuple[DataFrame, int]:
    """Slots of the directory over distinct hashes ``h``: each points to the
    bucket of the shortest prefix that is not overfull.  At most ``2 **
    max_depth`` rows, and no more than the hashes ask for."""
    depth = max(1, min(max_depth, math.ceil(math.log2(max(1, hashes.count() / capacity))) + 3))
    slots = hashes.groupBy(F.shiftrightunsigned("h", 64 - depth).alias("slot")).agg(F.count("*").alias("n"))
    levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(slot, {depth} - d)"))
    fits = levels.groupBy("d", "prefix").agg(F.sum("n").alias("n"), F.collect_list("slot").alias("slots"))
    fits = fits.where((F.col("n") <= capacity) | (F.col("d") == depth))
    local = fits.select(F.explode("slots").alias("slot"), "d").groupBy("slot").agg(F.min("d").alias("local_depth"))
    first = F.expr(f"shiftleft(shiftright(slot, {depth} - local_depth), {depth} - local_depth)")
    return local.select("slot", "local_depth", first.alias("bucket")), depth


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                max_depth: int = MAX_DEPTH, hash_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """The stored tables ``keys`` and ``index``."""
    hashed = _hashed(docs, doc_id, text, hash_bits)
    keys = materialize(hashed.select("id", "h", F.sha2("norm", 256).alias("sha")), "dedup-keys")
    counted = materialize(keys.groupBy("h").agg(F.count("*").alias("documents")), "dedup-hashes")
    slots, depth = directory(counted, capacity, max_depth)
    index = counted.withColumn("slot", F.shiftrightunsigned("h", 64 - depth)).join(F.broadcast(slots), "slot")
    index = index.select("bucket", "local_depth", "h", "documents").repartitionByRange("bucket", "h")
    return keys, materialize(index.sortWithinPartitions("bucket", "h"), "dedup-index")


def _marked(hashed: DataFrame, crowded: DataFrame) -> DataFrame:
    """``hashed`` with ``marked``: whether the leading ``FILTER_BITS`` bits of
    the hash are those of some hash in ``crowded``; where not, the hash is not
    there.  The bitmap is of fixed size, 4 KiB for each of ``2 ** FILTER_BITS /
    32768`` rows; where it fills up, more rows are marked, and a join decides."""
    slot = F.shiftrightunsigned("h", 64 - FILTER_BITS) + 1
    maps = crowded.groupBy(F.bitmap_bucket_number(slot).alias("map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    rows = hashed.withColumn("map", F.bitmap_bucket_number(slot)).withColumn("bit", F.bitmap_bit_position(slot))
    rows = rows.join(F.broadcast(maps), "map", "left")
    byte = "CAST(conv(hex(substring(bits, CAST(bit DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    return rows.withColumn("marked", F.expr(f"coalesce(shiftright({byte}, CAST(bit % 8 AS INT)) & 1 = 1, false)")).drop("map", "bit", "bits")


def _chains(marked: DataFrame, crowded: DataFrame) -> DataFrame:
    """Documents whose hash is not alone, dealt to owners by key range."""
    out = marked.where("marked").join(crowded, "h")
    return out.repartitionByRange("bucket", "h", "id").sortWithinPartitions("bucket", "h", "id")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
            max_depth: int = MAX_DEPTH, hash_bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    keys, index = build_index(docs, doc_id, text, capacity, max_depth, hash_bits)
    alone = keys.join(index.where("documents > 1"), "h", "left_anti").select(
        F.col("id").alias("doc_id"), F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    crowded = index.where("documents > 1").select("bucket", "h")
    chains = _chains(_marked(_hashed(docs.select(doc_id, text), doc_id, text, hash_bits), crowded), crowded)
    # Written once, so that the row numbers below stay as they are.
    chains = materialize(chains.select("bucket", "h", "norm", "id", "points", F.monotonically_increasing_id().alias("at")),
                         "dedup-chains")
    # The complement reverses an order and cannot overflow as a minus can.
    best = F.max(F.struct("points", F.bitwise_not("id").alias("id"), F.bitwise_not("at").alias("at"))).alias("best")
    groups = chains.groupBy("bucket", "h", "norm").agg(best, F.count("*").alias("group_size"))
    groups = groups.select("bucket", "h", "norm", "group_size", F.bitwise_not("best.id").alias("keep_id"),
                           F.bitwise_not("best.at").alias("keep_at"))
    # Stored, so that the join has shuffles of its own and can split a large group.
    groups = materialize(groups, "dedup-groups")
    members = chains.join(groups, ["bucket", "h", "norm"]).select(
        F.col("id").alias("doc_id"), "keep_id", F.col("group_size").cast("bigint").alias("group_size"),
        (F.col("at") == F.col("keep_at")).alias("kept"), F.sha2("norm", 256).alias("text_sha256"))
    return alone.unionByName(members)


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                max_depth: int = MAX_DEPTH, hash_bits: int = 64) -> DataFrame:
    """The documents that stay, one of each group, all their columns unchanged."""
    _, index = build_index(docs, doc_id, text, capacity, max_depth, hash_bits)
    crowded = index.where("documents > 1").select("bucket", "h")
    marked = _marked(_hashed(docs, doc_id, text, hash_bits), crowded)
    # Unmarked documents are unique and stay where they are; only marked ones,
    # copies and a few others, are moved.
    alone = marked.where("NOT marked").select("row").unionByName(marked.where("marked").join(crowded, "h", "left_anti").select("row"))
    chains = _chains(marked, crowded)
    order = F.struct("points", F.bitwise_not("id"), F.xxhash64("row"))
    stays = chains.groupBy("bucket", "h", "norm").agg(F.max_by("row", order).alias("row")).select("row")
    return alone.unionByName(stays).select("row.*")

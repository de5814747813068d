"""Keyed merges with per-key NULL rules.

``outer_merge`` is a full outer join of a large frame with a keyed side frame,
written as a left join plus the side rows no large row meets, instead of one
``full_outer`` join (which Spark can neither broadcast nor split for skew).
Which plan is used follows a size check of the side (``fits_broadcast``):

small side (checked byte bound, broadcast):
    large LEFT JOIN broadcast(side)
  ∪ side LEFT ANTI broadcast((large keys LEFT SEMI broadcast(side keys)).distinct())
  - the large frame is never shuffled; the semi join filters it where it is
    read, and the anti join meets at most one row per side key.

large side (shuffle joins, adaptive skew splitting of hot keys):
    large LEFT JOIN side
  ∪ side LEFT ANTI (large keys).distinct()
  - the large frame is shuffled once on the keys for the left join, and only
    its distinct keys (partially aggregated map-side) for the anti join, of
    which a bitmap of the side's keys drops most that meet nothing.

Same rows as a full outer join, NULL keys included.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Measured

SIDE = "__r_"


def _on(left: DataFrame, right: DataFrame, null_safe: tuple[str, ...], strict: tuple[str, ...]) -> Column:
    conds = [left[k].eqNullSafe(right[SIDE + k]) for k in null_safe]
    conds += [left[k] == right[SIDE + k] for k in strict]
    return reduce(and_, conds)


def _prefixed(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return df.select([F.col(c).alias(SIDE + c) if c in keys else F.col(c) for c in df.columns])


def fits_broadcast(side: Measured, max_bytes: int) -> bool:
    """Size check before broadcasting a stored frame: by the decoded bytes of
    its rows, which were counted while it was stored."""
    return side.bytes <= max_bytes


BITS_PER_ROW = 16  # of a key bitmap: one row in 16 that meets nothing passes
_BITMAP = 32768  # bits of one row of bitmap_construct_agg


def may_meet(rows: DataFrame, side: DataFrame, keys: tuple[str, ...], side_rows: int, max_bytes: int) -> DataFrame:
    """``rows`` without most of those whose keys no row of ``side`` has: a
    bitmap over hashed keys, ``BITS_PER_ROW`` for each side row but at most
    ``max_bytes``, is broadcast and tested where the rows are read.  Every row
    that meets the side stays (equal keys, NULL like NULL, hash alike); a
    bitmap that is too small for the side lets more of the others pass."""
    slots = max(1, min(-(-side_rows * BITS_PER_ROW // _BITMAP), max_bytes * 8 // _BITMAP))

    def slot(df: DataFrame) -> Column:
        return F.pmod(F.xxhash64(*[df[k] for k in keys]), F.lit(slots * _BITMAP)) + 1

    marks = slot(side)
    maps = side.groupBy(F.bitmap_bucket_number(marks).alias(SIDE + "map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(marks)).alias(SIDE + "bits"))
    at = rows.withColumn(SIDE + "slot", slot(rows))
    at = at.join(F.broadcast(maps), F.bitmap_bucket_number(F.col(SIDE + "slot")) == F.col(SIDE + "map"))
    bit = F.bitmap_bit_position(F.col(SIDE + "slot"))
    byte = F.conv(F.hex(F.substring(F.col(SIDE + "bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return at.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*rows.columns)


def left_merge(large: DataFrame, side: DataFrame, null_safe=(), strict=(), broadcast_side: bool = False) -> DataFrame:
    """Left join keeping the large frame's key columns; NULL keys match NULL
    for ``null_safe`` keys and never for ``strict`` keys.  ``broadcast_side``
    only after a size check of the side."""
    null_safe, strict = tuple(null_safe), tuple(strict)
    keys = null_safe + strict
    right = _prefixed(side, keys)
    right = F.broadcast(right) if broadcast_side else right
    joined = large.join(right, _on(large, right, null_safe, strict), "left")
    return joined.drop(*[SIDE + k for k in keys])


def outer_merge(large: DataFrame, side: DataFrame, null_safe=(), strict=(), broadcast_side: bool = False,
                key_rows: DataFrame | None = None, side_rows: int | None = None, filter_max_bytes: int = 32 << 20) -> DataFrame:
    """Full outer join on the keys; key columns are merged (from whichever side
    has the row).  Columns: the large frame's, then the side's non-key ones.
    ``broadcast_side`` selects the broadcast plan and must follow a size check
    of the side (``fits_broadcast``).  ``key_rows`` may name a cheaper frame
    that holds the same matchable keys as ``large``.  With ``side_rows``, the
    number of side rows, a key bitmap of at most ``filter_max_bytes`` drops
    most large keys that meet nothing before they are shuffled."""
    null_safe, strict = tuple(null_safe), tuple(strict)
    keys = null_safe + strict
    matched = left_merge(large, side, null_safe, strict, broadcast_side)
    large_keys = (large if key_rows is None else key_rows).select(*keys)
    if broadcast_side:
        side_keys = F.broadcast(_prefixed(side.select(*keys), keys))
        met = large_keys.join(side_keys, _on(large_keys, side_keys, null_safe, strict), "left_semi").distinct()
        met = F.broadcast(_prefixed(met, keys))  # at most one row per side key
    else:
        if side_rows is not None:
            large_keys = may_meet(large_keys, side, keys, side_rows, filter_max_bytes)
        met = _prefixed(large_keys.distinct(), keys)
    side_only = side.join(met, _on(side, met, null_safe, strict), "left_anti")
    return matched.unionByName(side_only, allowMissingColumns=True)

"""Prefix trie of conversations by ROLLUP over positional turn-id columns.

A turn's id is the length of its text and a 128-bit digest of role and text.
Every conversation becomes rows of ``BLOCK`` turn-id columns, one row for each
block of turns; a row also names the trie node at which the block before it
ended.  One ``GROUP BY block, prior, ROLLUP(c1, ..., cn)`` then makes all
prefixes of all conversations at once, ``grouping_id`` telling their depth.

The node before a block is a digest of all turns before it, found by doubling
(each round joins a block with the one 1, 2, 4, ... blocks before), so a
conversation of n turns takes log(n / BLOCK) rounds and no task holds it.

Sums over subtrees come out of the same rollup as sums over members.  Call the
smallest member of a node its owner; who owns a node owns its own path from
there to its end.  So a subtree's distinct bytes are what its members own (the
owner's bytes above the node left out), its leaves are the members that own
one, and of its edges only the top of each owner's path leads to a node of
another owner.  A first rollup finds what each conversation owns, a second one
sums it.

The ids of the members that end at a node are hashed in order as a stream:
sorted by ranges, joined to texts of ``CHUNK`` ids in every task, and only the
texts of a node meet in one task, which holds one at a time.

Defined results: rows without a conversation id belong to no conversation;
null turns come first, null roles and texts are empty; turns with an equal
number are ordered by role, then by turn id (repeated rows are further turns);
an empty table has no root.  Other columns are not read and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize

BLOCK = 8  # turn-id columns
CHUNK = 1 << 14  # ids in one text
FAMILY, HEADS = 5, 9  # rebuild: conversations that share a first one, and the modulus of how many turns of it they take
LOCAL = 33  # bits of monotonically_increasing_id within a partition
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """4 bytes of the text's length and 16 of the digest of role and text."""
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.lpad(F.hex(F.octet_length(text)), 8, "0"), F.substring(digest, 1, 32)))


def text_bytes(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, 1, 4)), 16, 10).cast("bigint")


def numbered(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv, n) per conversation, and (conv, rank, turn_id) with ranks from 1.

    Turns are dealt by ranges of (conversation, order), so that a very long one
    spreads; a rank is the distance of two places in that order."""
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = conversations.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("bigint").alias("conv"), F.col(f"`{turn}`").alias("turn"), empty(role).alias("role"),
        turn_id(empty(role), empty(text)).alias("turn_id"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "turn_id"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(rows.select("conv", "turn_id", F.monotonically_increasing_id().alias("at")), "trie-turns")
    parts = rows.groupBy(F.shiftright("at", LOCAL).alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition.
    offsets = F.broadcast(parts.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0))).alias("offset")))

    def place(df: DataFrame, at: str, name: str) -> DataFrame:
        df = df.withColumn("part", F.shiftright(at, LOCAL)).join(offsets, "part")
        return df.withColumn(name, F.col("offset") + F.col(at).bitwiseAND(F.lit((1 << LOCAL) - 1))).drop("part", "offset", at)

    convs = place(rows.groupBy("conv").agg(F.min("at").alias("first"), F.count("*").alias("n")), "first", "start")
    # Stored, so that the join has shuffles of its own and can split a long conversation.
    convs = materialize(convs, "trie-conversations")
    ranked = place(rows, "at", "pos").join(convs.select("conv", "start"), "conv")
    return convs.select("conv", "n"), ranked.select("conv", (F.col("pos") - F.col("start") + 1).alias("rank"), "turn_id")


def plain(conversations: DataFrame, **names: str) -> DataFrame:
    """The conversations as they are, as ``trie`` takes them."""
    convs, ranked = numbered(conversations, **names)
    turns = ranked.join(convs, "conv").select("conv", F.col("n").alias("length"), F.col("rank").alias("pos"), "turn_id")
    return turns.unionByName(_seeds(convs.select("conv", F.col("n").alias("length"))))


def _seeds(convs: DataFrame) -> DataFrame:
    """One row without a turn for every conversation, so that none is lost."""
    return convs.select("conv", "length", F.lit(1).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("turn_id"))


def rebuilt(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS, **names: str) -> DataFrame:
    """(conv, length, pos, turn_id): every conversation c with its first h
    turns replaced by those of conversation ``c - c % family``, h being
    ``crc32(c) % heads``; at most ``heads - 1`` turns of a first conversation
    are repeated, for at most ``2 * family - 1`` others."""
    convs, ranked = numbered(conversations, **names)
    head = lambda c: (F.crc32(c.cast("string").cast("binary")) % heads)
    firsts = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    known = convs.withColumn("base", F.col("conv") - F.col("conv") % family).join(firsts, "base", "left")
    known = known.select("conv", "n", head(F.col("conv")).alias("h"), F.coalesce("base_n", F.lit(0)).alias("base_n"))
    known = known.withColumn("taken", F.least("h", "base_n"))
    known = known.select("conv", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    known = materialize(known, "trie-lengths")
    ranked = materialize(ranked, "trie-ranked")
    own = ranked.join(known, "conv").where("rank > h").select("conv", "length", (F.col("taken") + F.col("rank") - F.col("h")).alias("pos"), "turn_id")
    near = F.transform(F.sequence(F.lit(1 - family), F.lit(family - 1)), lambda d: F.col("conv") + d)
    lent = ranked.where((F.col("rank") < heads) & (F.col("conv") % family == 0)).select(F.explode(near).alias("to"), "conv", "rank", "turn_id")
    lent = lent.where((F.col("to") - F.col("to") % family == F.col("conv")) & (F.col("rank") <= head(F.col("to"))))
    lent = lent.select(F.col("to").alias("conv"), F.col("rank").alias("pos"), "turn_id").join(known.select("conv", "length"), "conv")
    return own.unionByName(lent).unionByName(_seeds(known.select("conv", "length")))


def _digest(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def blocks(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One stored row per conversation and block: ``conv, length, block, c1..,
    own_bytes, prior, before, full``: the node and the bytes before the block,
    and the node at its end where it is full."""
    columns = [f"c{i + 1}" for i in range(block)]
    at = turns.select("conv", "length", F.expr(f"(pos - 1) DIV {block}").alias("block"), ((F.col("pos") - 1) % block).alias("col"), "turn_id")
    rows = at.groupBy("conv", "block").agg(F.max("length").alias("length"), *[
        F.max(F.when(F.col("col") == i, F.col("turn_id"))).alias(c) for i, c in enumerate(columns)])
    size = sum((F.coalesce(text_bytes(F.col(c)), F.lit(0)) for c in columns), F.lit(0).cast("bigint"))
    rows = materialize(rows.withColumn("own_bytes", size), "trie-blocks")
    full = rows.where(F.col(columns[-1]).isNotNull())
    scan = materialize(full.select("conv", "block", _digest(*[F.col(c) for c in columns]).alias("full"), F.col("own_bytes").alias("bytes")), "trie-scan")
    last = rows.agg(F.max("block").alias("last")).first()["last"] or 0
    step = 1
    while step <= last:
        back = scan.select("conv", (F.col("block") + step).alias("block"), F.col("full").alias("first"), F.col("bytes").alias("first_bytes"))
        both = scan.join(back, ["conv", "block"], "left")
        scan = materialize(both.select("conv", "block", F.when(F.col("first").isNull(), F.col("full")).otherwise(_digest(F.col("first"), F.col("full"))).alias("full"),
                                       (F.col("bytes") + F.coalesce("first_bytes", F.lit(0))).alias("bytes")), "trie-scan")
        step *= 2
    rows = rows.join(scan.select("conv", "block", "full"), ["conv", "block"], "left")
    prior = scan.select("conv", (F.col("block") + 1).alias("block"), F.col("full").alias("prior"), F.col("bytes").alias("before"))
    none = F.lit("").cast("binary")
    rows = rows.join(prior, ["conv", "block"], "left")
    rows = rows.withColumn("prior", F.coalesce("prior", none)).withColumn("before", F.coalesce("before", F.lit(0)))
    return materialize(rows, "trie-rows")


def _node(columns: list[str], depth: Column) -> Column:
    """The id of the prefix that ends with the first ``depth`` columns of a
    block (0: the node before it); needs ``prior`` and ``full``."""
    out = F.when(depth == 0, F.col("prior")).when(depth == len(columns), F.col("full"))
    for r in range(1, len(columns)):
        out = out.when(depth == r, _digest(F.lit(f"{r}:"), F.col("prior"), *[F.col(c) for c in columns[:r]]))
    return out


def _rollup(rows: DataFrame, columns: list[str], sums: str) -> DataFrame:
    """All prefixes of ``rows``, one row each: group columns, ``r`` (how many
    columns of the block it holds), ``depth`` and the given aggregates."""
    names, n = ", ".join(columns), len(columns)
    found = rows.sparkSession.sql(
        f"SELECT block, prior, {names}, grouping_id() AS gid, min(before) AS before, min(full) AS full, {sums} "
        f"FROM {{rows}} GROUP BY block, prior, ROLLUP({names})", rows=rows)
    # What a conversation has no turn for is no prefix; the node before a block belongs to the block before.
    valid = (F.col("gid") == (1 << n) - 1) & (F.col("block") == 0)
    r = F.when(F.col("gid") == (1 << n) - 1, 0)
    for i, c in enumerate(columns, 1):
        valid = valid | ((F.col("gid") == (1 << (n - i)) - 1) & F.col(c).isNotNull())
        r = r.when(F.col("gid") == (1 << (n - i)) - 1, i)
    return found.where(valid).withColumn("r", r).withColumn("depth", F.col("block") * n + F.col("r"))


def _ends_sha(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(node, ends_sha256) of (node, conv): the hash of the ordered ids."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []
        for batch in batches:
            for n, c in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist()):
                if n != node or len(ids) == chunk:
                    if ids:
                        out.append((node, ids[0], ",".join(map(str, ids))))
                    node, ids = n, []
                ids.append(c)
            if sum(len(x[2]) for x in out) > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["node", "first", "ids"])
                out = []
        if ids:
            out.append((node, ids[0], ",".join(map(str, ids))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["node", "first", "ids"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if n != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())],
                                             names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["node", "ends_sha256"])

    texts = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(join, "node binary, first long, ids string")
    return texts.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(fold, "node binary, ends_sha256 string")


def trie(turns: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """One row per node of the trie over ``turns`` (conv, length, pos,
    turn_id): ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``."""
    columns = [f"c{i + 1}" for i in range(block)]
    rows = blocks(turns, block)
    last_bytes = F.coalesce(*[F.when(F.col("r") == i, text_bytes(F.col(c))) for i, c in enumerate(columns, 1)], F.lit(0))
    owned = _rollup(rows, columns, "min(conv) AS conv, max(length) AS longest")
    owned = owned.groupBy("conv").agg(F.sum(last_bytes).alias("owned"), F.min("depth").alias("top"),
                                      F.max((F.col("longest") == F.col("depth")).cast("int")).alias("leaf"))
    totals = rows.groupBy("conv").agg(F.sum("own_bytes").alias("total"), F.max("length").alias("length"))
    each = totals.join(owned, "conv", "left").select("conv", "total", F.coalesce("owned", F.lit(0)).alias("owned"),
                                                     F.coalesce("top", F.lit(-1)).alias("top"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    each = materialize(each, "trie-each")
    found = _rollup(rows.join(each, "conv"), columns,
                    "count(*) AS n, min(struct(conv, top, owned, total, length)) AS m, "
                    "sum(total) AS totals, sum(owned) AS owneds, sum(leaf) AS leaves")
    above = F.col("before") + sum((F.when(F.col("r") > i, text_bytes(F.col(c))).otherwise(0) for i, c in enumerate(columns, 1)), F.lit(0))
    saved = F.col("totals") - F.col("n") * F.col("above") - (F.col("owneds") - F.col("m.owned") + F.col("m.total") - F.col("above"))
    found = found.withColumn("above", above).select(
        _node(columns, F.col("r")).alias("node"), F.when(F.col("depth") > 0, _node(columns, F.col("r") - 1)).alias("up"), "depth",
        F.col("m.conv").alias("conv_id"), F.col("n").alias("n_convs"), F.col("leaves").cast("bigint").alias("n_leaves"), saved.alias("saved_tokens"),
        (F.col("m.top") == F.col("depth")).alias("is_top"), (F.col("m.length") > F.col("depth")).cast("bigint").alias("own_child"))
    nodes = materialize(found, "trie-nodes")

    tops = nodes.where("is_top AND depth > 0")
    children = materialize(tops.groupBy(F.col("up").alias("of_node")).agg(F.count("*").alias("others")), "trie-children")
    root = nodes.where("depth = 0").select("conv_id").first()
    # A node below the top of its owner's path has the same owner's node above it, and the root is above depth 1.
    inner = nodes.where("NOT is_top OR depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.when(F.col("is_top"), F.lit(root["conv_id"] if root else None))
                                                                                     .otherwise(F.col("conv_id"))))
    upper = materialize(nodes.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id")).join(
        children.select(F.col("of_node").alias("above")), "above", "left_semi"), "trie-parents")
    outer = nodes.where("is_top AND depth > 1").join(upper, F.col("up") == F.col("above")).drop("above")
    end = F.when(F.col("length") == 0, 0).otherwise((F.col("length") - 1) % block + 1)
    ends = rows.where((F.col("length") <= (F.col("block") + 1) * block)).select(_node(columns, end).alias("node"), "conv")
    hashes = materialize(_ends_sha(ends, chunk).withColumnRenamed("node", "end_node"), "trie-ends")
    out = inner.unionByName(outer)
    out = out.join(children, F.col("node") == F.col("of_node"), "left").join(hashes, F.col("node") == F.col("end_node"), "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", (F.col("own_child") + F.coalesce("others", F.lit(0))).alias("n_children"), "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))

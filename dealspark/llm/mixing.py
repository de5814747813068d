"""Mixing sources to target weights by capped water-filling.

``targets`` raises a common water level over the sources: each gets its weight
times the level, but at most ``max_epochs`` times its size; what a clamped
source cannot take goes to the others by weight, until the asked total is met
(or every source is full).  The level has a closed form: with the sources in
the order of cap per weight, it is the total less the caps before, over the
weights after.

``mix`` turns targets into whole and fractional repetitions: every document of
a source is taken ``floor(target / size)`` times, and the rest of the target
is filled with documents in a seeded hash order.  The document on the boundary
is taken in part, so a source's taken words equal its target to one word.

The boundary is found by sums over hash prefixes, then by the order within one
prefix, in which rows equal in id and text are counted first and told apart
afterwards; no task ever holds a source, nor all rows that lack an id, nor a
large group of copies.  The seeded order depends on seed, id and text alone, so
reruns and other partitionings agree.

Defined results: null and empty texts have size 0 and take 0; the null source
is a source, last in order; rows that share an id are ordered by their texts'
hashes, and of rows that share both, which are alike here, any are taken; an
empty table gives an empty result; a source of size 0 has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize
from .common import packed, word_count

WEIGHTS = (5, 2, 1)  # repeating over the sources in order
SHARE, MAX_EPOCHS, SEED = 1.5, 2.0, "mix-1"
PREFIX = 12  # bits of each of the two prefix levels of the 60-bit order


def seeded_order(doc_id: Column, text: Column, seed: str) -> Column:
    """A 60-bit number from seed, id and text."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def sized(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
          seed: str = SEED) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                       word_count(F.col(f"`{text}`")).alias("size"),
                       seeded_order(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), seed).alias("at"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Per source: ``source, source_size, weight, target``.  From the sums on
    it works on one row per source."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by = by.withColumn("weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    by = by.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    onward = full.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    # The level if the sources before are full; true where it fills none of the others (the highest such level).
    by = by.withColumn("level", level).withColumn("own", F.col("cap") / F.col("weight"))
    by = by.withColumn("water", F.max(F.when(F.col("level") <= F.col("own"), F.col("level"))).over(Window.partitionBy()))
    return by.select("source", "source_size", "weight",
                     F.least(F.col("cap"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap"))).alias("target"))


def plan(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source what its documents take: ``whole`` repetitions each, and one
    more for all documents whose prefix lies before ``cut``, while those with
    prefix ``cut`` share ``left`` words in order."""
    goals = goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
    goals = goals.withColumn("rest", (F.round("target").cast("bigint") - F.col("whole") * F.col("source_size")))
    goals = materialize(goals, "mix-goals")
    cells = sizes.groupBy("source", F.shiftright("at", 60 - 2 * PREFIX).alias("cell")).agg(F.sum("size").alias("size"))
    cells = materialize(cells, "mix-cells").withColumn("top", F.shiftright("cell", PREFIX))

    def crossing(parts: DataFrame, by: str, rest: Column) -> DataFrame:
        """The part in which the sum in order passes ``rest``."""
        before = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        return parts.where((F.col("before") <= rest) & (rest < F.col("before") + F.col("size")))

    named = goals.select(F.col("source").alias("goal"), "rest")
    tops = cells.groupBy("source", "top").agg(F.sum("size").alias("size"))
    tops = tops.join(named, tops["source"].eqNullSafe(named["goal"])).drop("goal")
    tops = crossing(tops, "top", F.col("rest")).select(F.col("source").alias("s"), F.col("top").alias("t"), (F.col("rest") - F.col("before")).alias("rest"))
    inside = cells.join(tops, cells["source"].eqNullSafe(tops["s"]) & (cells["top"] == tops["t"])).drop("s", "t")
    cut = crossing(inside, "cell", F.col("rest")).select(F.col("source").alias("s"), F.col("cell").alias("cut"), (F.col("rest") - F.col("before")).alias("left"))
    out = goals.join(cut, goals["source"].eqNullSafe(cut["s"]), "left").drop("s")
    # A source without a crossing takes no more (rest 0) or all of it once more.
    end = F.when(F.col("rest") > 0, F.lit(1 << 2 * PREFIX)).otherwise(F.lit(-1)).cast("bigint")
    return out.withColumn("cut", F.coalesce("cut", end)).withColumn("left", F.coalesce("left", F.lit(0)))


def _meet(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rows`` with the prefix of their order and the plan of their source."""
    chosen = chosen.withColumnRenamed("source", "goal")
    out = rows.withColumn("cell", F.shiftright("at", 60 - 2 * PREFIX))
    return out.join(chosen, out["source"].eqNullSafe(chosen["goal"])).drop("goal")


def _edge(rows: DataFrame, order: list[str], *carried: Column) -> DataFrame:
    """The rows of the boundary prefix, one per source, each with ``extra``, the
    words it takes beyond the whole repetitions.  Rows equal in ``order`` are
    one row with a count until the words before them are known."""
    groups = rows.where("cell = cut").groupBy("source", "source_size", "target", "whole", "left", *order)
    groups = groups.agg(F.count("*").alias("n"), *carried)
    before = Window.partitionBy("source").orderBy(*[F.col(c).asc_nulls_last() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("n")).over(before), F.lit(0)))
    each = groups.withColumn("copy", F.explode(F.expr("sequence(0L, n - 1)")))
    left = F.col("left") - F.col("before") - F.col("copy") * F.col("size")
    return each.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), left)))


def _taken(sizes: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``sizes`` with the plan of their source and ``extra``."""
    out = _meet(sizes, chosen)
    clear = out.where("cell <> cut").withColumn("extra", F.when(F.col("cell") < F.col("cut"), F.col("size")).otherwise(0))
    columns = ["doc_id", "size", "source_size", "target", "whole", "extra"]
    return clear.select(*columns).unionByName(_edge(out, ["at", "doc_id", "size"]).select(*columns))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` and
    its repetitions, ``whole`` and the ``extra`` words."""
    sizes = materialize(sized(docs, doc_id, source, text, seed), "mix-sizes")
    # Stored, one row per source, so that Spark knows its size and need not
    # shuffle the documents by source to meet it.
    chosen = materialize(plan(sizes, targets(sizes, weights, share, max_epochs)), "mix-plan")
    return _taken(sizes, chosen).select("doc_id", "size", "source_size", "target",
                      (F.col("whole") * F.col("size") + F.col("extra")).cast("bigint").alias("taken"), "whole",
                      F.col("extra").cast("bigint").alias("extra"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
                    seed: str = SEED) -> DataFrame:
    """The corpus of the mix: each document as often as it is taken, a part of
    a document counting as a whole one from one half on; columns unchanged."""
    sizes = materialize(sized(docs, doc_id, source, text, seed), "mix-sizes")
    chosen = materialize(plan(sizes, targets(sizes, weights, share, max_epochs)), "mix-plan")
    rows = packed(docs)
    where = {name: F.col(f"row.`{column}`") for name, column in (("id", doc_id), ("source", source), ("text", text))}
    rows = rows.withColumn("source", where["source"]).withColumn("at", seeded_order(where["id"], where["text"], seed))
    rows = _meet(rows, chosen)
    clear = rows.where("cell <> cut").withColumn("times", F.col("whole") + F.when(F.col("cell") < F.col("cut"), 1).otherwise(0))
    edge = rows.withColumn("doc_id", where["id"]).withColumn("size", word_count(where["text"])).withColumn("same", F.xxhash64("row"))
    edge = _edge(edge, ["at", "doc_id", "size", "same"], F.first("row").alias("row"))
    once_more = F.when((F.col("extra") > 0) & (2 * F.col("extra") >= F.col("size")), 1).otherwise(0)
    rows = clear.select("row", "times").unionByName(edge.select("row", (F.col("whole") + once_more).alias("times")))
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).select("row.*")

"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _towards_min(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation: each node links its larger (``large``) or smaller
    neighbours to the least node it knows."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # Stored, so that the join below can broadcast it or split a node with very many neighbours.
    least = materialize(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "components-least")
    moved = around.join(least, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint), component
    being the smallest node reachable.  Alternating large-star and small-star
    rounds until nothing moves; each round is stored, so lineage stays short
    and a lost executor costs one round.  Only counts reach the driver."""
    now, before = materialize(edges.where("a <> b").select("a", "b").distinct(), "components"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        now = materialize(_towards_min(_towards_min(now, True), False), "components")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

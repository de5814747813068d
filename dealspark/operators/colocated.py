"""Joins over bucketed tables: the ledger side is written in buckets of a join
key once, and neither its aggregation nor its joins shuffle it again.

The key is a digest of the join's columns (NULL like NULL, so that a null-safe
join is an equality Spark can bucket by) and a salt of the row's other columns:
a deal key or a team that holds a third of all rows lies in ``salts`` buckets,
not in one.  The side, which is small beside the ledger, is repeated for every
salt and is all that is shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

KEY = "__bucket_key"


def digest(columns: tuple[str, ...]) -> Column:
    """128 bits of the columns' values, NULL unlike any value."""
    named = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]))
    return F.substring(F.sha2(named, 256), 1, 32)


def salted_key(columns: tuple[str, ...], others: tuple[str, ...], salts: int) -> Column:
    return F.concat(digest(columns), F.lit("#"), F.pmod(F.xxhash64(*others), F.lit(salts)).cast("string"))


def every_salt(side: DataFrame, columns: tuple[str, ...], salts: int) -> DataFrame:
    """The side once for each salt, with the key."""
    salt = F.explode(F.array(*[F.lit(str(i)) for i in range(salts)]))
    return side.withColumn("__salt", salt).withColumn(KEY, F.concat(digest(columns), F.lit("#"), F.col("__salt"))).drop("__salt")


def bucketed(df: DataFrame, buckets: int, name: str) -> DataFrame:
    """``df`` written once in buckets of ``KEY``, one file each, sorted, and
    read back as a table that Spark knows to be bucketed."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/buckets/{table}"
    df.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(table)
    return spark.table(table)


def outer_merge(large: DataFrame, side: DataFrame, keys: tuple[str, ...], salts: int) -> DataFrame:
    """Null-safe full outer join of a frame clustered by ``KEY`` with a side
    frame.  Columns: the large frame's with ``KEY``, then the side's other
    ones."""
    rest = [c for c in side.columns if c not in keys]
    right = every_salt(side, keys, salts).select(F.col(KEY).alias("__key"), *rest)
    matched = large.join(right, large[KEY] == right["__key"], "left").drop("__key")
    # The side rows whose key no salt has met: only narrow side rows move.
    met = large.select(F.col(KEY).alias("__key")).groupBy("__key").agg(F.lit(True).alias("__met"))
    flagged = every_salt(side, keys, salts)
    flagged = flagged.join(met, flagged[KEY] == met["__key"], "left").groupBy(*keys, *rest).agg(F.max("__met").alias("__met"))
    return matched.unionByName(flagged.where("__met IS NULL").drop("__met"), allowMissingColumns=True)

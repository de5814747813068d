"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space and words of all contracts: ASCII white space only.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes; ``bytes.split`` splits on exactly ``SPACE``."""
    return text.encode().split() if text else []


def word_count(text: Column) -> Column:
    """Number of words, without Python."""
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACE + "+"), "")), F.lit(0)).cast("bigint")


def packed(df: DataFrame, row: str = "row") -> DataFrame:
    """All columns as one struct, so that added columns cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, its session handing texts to Python in batches of some hundred
    rows: the default of 10,000 whole texts would fill a worker's memory.  A
    setting other than the default stays."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return df


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks (the
    functions of this package arrive anew with each task)."""
    return sys.__dict__.setdefault("_dealspark_llm", {}).setdefault(name, {})

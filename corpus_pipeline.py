"""The corpus pipeline: five stages of ``dealspark.llm`` over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
every stage but the last returns the columns of ``documents``.  The rows
between two stages are written as Parquet to the folder of
``spark.checkpoint.dir`` and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dealspark.llm import exact_dedup, mixing, packing, rule_ledger, simhash
from dealspark.llm.queries import word_vocabulary
from dealspark.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clean policy rejects go."""
    return rule_ledger.filter_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or sampled so that sources meet their targets."""
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs, word_vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("source_mixing", source_mix),
    ("packing", sequences),
]

# Fingerprints by XXH64, tokenizing and column generation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

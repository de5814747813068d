"""The registered queries of this package: each operator with its production
parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import (exact_dedup, hilbert, html_extract, jaccard_join, mixing, packing, prefix_trie, quality_classifier, rule_ledger, simhash,
               toxicity, vector_codes, warc)
from .common import table


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_subword_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored once: policies and ablations read the ledger, not the texts.
    ledger = materialize(rule_ledger.build_ledger(table(spark, sf_dir, "documents")), "rule-ledger")
    judged = rule_ledger.judged(ledger, (rule_ledger.CLEAN_1,), rule_ledger.CLEAN)
    judged = judged.withColumn("base_failed", rule_ledger.fails(F.col("fail_bits"), rule_ledger.BASE))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines",
                         "n_adjacent_words", "n_letters", "n_capitals", "n_wide", "fail_bits", "kept_clean_1", "only_rule", "given_back")


def op4_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = hilbert.shards(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op8_extendible_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(table(spark, sf_dir, "documents"))


def op9_pigeonring_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_column_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_vocabulary())


def op11_memoised_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_turn_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op13_banded_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_subword_embeddings, op2_classifier_chain, op3_rule_ledger, op4_water_filling, op5_host_suffix_array,
                            op6_warc_transactions, op7_hilbert_shards, op8_extendible_hash, op9_pigeonring_simhash,
                            op10_column_generation, op11_memoised_cells, op12_turn_rollup, op13_banded_tiles)
}

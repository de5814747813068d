"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document and its outcome kept as one bit of
``fail_bits`` beside the measurements.  A policy is a versioned set of rules,
that is a mask: applying another version, or asking what a rule costs, reads
the ledger and never the texts again.

Defined results: a null text measures like the empty text (all zero, which
fails ``few_words``); null ids pass through; repeated rows are measured
independently; an empty table gives an empty ledger.  Only the id and the text
are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, words_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_adjacent_words",
            "n_letters", "n_capitals")
SYMBOLS = b"#*$%&|<>"
WINDOW = 8  # words


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside a ``window``-word window that occurs twice or more (the
    first occurrence counts).  Windows get exact ranks by doubling: the rank of
    2k words is the rank of the pair of ranks of k words."""
    n = len(ids)
    if n <= window:
        return 0
    rank, k = ids.astype(np.int64), 1
    while k < window:
        pair = rank[:-k] * (int(rank.max()) + 1) + rank[k:]
        _, rank, counts = np.unique(pair, return_inverse=True, return_counts=True)
        k *= 2
        if len(counts) == len(rank):  # all windows of k words differ, so do longer ones
            return 0
    starts = np.flatnonzero(counts[rank] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:n]) > 0).sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``."""
    words = words_of(text)
    if not words:
        return (0,) * len(MEASURES)
    raw = text.encode()
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    space = int(seen[9:14].sum() + seen[32])
    points = int(seen.sum() - seen[128:192].sum())  # without UTF-8 continuation bytes
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    capitals = int(seen[65:91].sum())
    return (len(words), points - space, int(sum(seen[c] for c in SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(ids), len(lines), int((ids[1:] == ids[:-1]).sum()), capitals + int(seen[97:123].sum()),
            capitals)


@F.pandas_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measure(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in text], columns=list(MEASURES))


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str  # SQL over the measurements


# A bit never changes its meaning: a changed rule gets a new bit.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 30 * n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "adjacent_repeats", "100 * n_adjacent_words > 30 * n_words"),
    Rule(5, "capitals", "100 * n_capitals > 50 * n_letters"),
    Rule(6, "word_length", "word_chars < 2 * n_words OR word_chars > 40 * n_words"),
    # Only where most characters are ASCII: other scripts may have no capitals, or no spaces between words.
    Rule(7, "ascii_capitals", "100 * n_capitals > 50 * n_letters AND 2 * n_wide <= word_chars"),
    Rule(8, "ascii_word_length", "word_chars < 2 * n_words OR (word_chars > 40 * n_words AND 2 * n_wide <= word_chars)"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[x] for x in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
CLEAN_1 = Policy("clean", 1, tuple(r.name for r in RULES[:7]))
CLEAN = Policy("clean", 2, ("few_words", "repeated_windows", "symbols", "duplicate_lines", "adjacent_repeats", "ascii_capitals",
                            "ascii_word_length"))
POLICIES = (BASE, CLEAN_1, CLEAN)


def wide(text: Column) -> Column:
    """``n_wide``: UTF-8 continuation bytes, none in ASCII, one to three in any other character."""
    return F.coalesce(F.octet_length(text) - F.char_length(text), F.lit(0)).cast("bigint")


def fail_bits() -> Column:
    """Bits of the rules that fail, over the columns of measurements."""
    out = F.lit(0).cast("bigint")
    for r in RULES:
        out = out.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("bigint"))
    return out


def build_ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, measurements, ``fail_bits``."""
    out = small_batches(docs).select(F.col(doc_id).alias("doc_id"), measure(F.col(text)).alias("m"), wide(F.col(text)).alias("n_wide"))
    return out.select("doc_id", "m.*", "n_wide").withColumn("fail_bits", fail_bits())


def fails(bits: Column, policy: Policy) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask).cast("bigint")) != 0


def apply_policy(ledger: DataFrame, policy: Policy, into: str = "kept") -> DataFrame:
    """The ledger with the policy's verdict."""
    return ledger.withColumn(into, ~fails(F.col("fail_bits"), policy))


def ablations(ledger: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule: documents, those the policy rejects, those failing
    the rule, and those only this rule rejects (what dropping it would give
    back).  The ledger is first counted by bit pattern - at most two to the
    number of rules rows - so the cost does not depend on the number of
    policies."""
    patterns = ledger.groupBy("fail_bits").agg(F.count("*").alias("n"))
    bits = {r.name: r.bit for r in RULES}
    plan = [(p.name, p.version, p.mask, r, 1 << bits[r]) for p in policies for r in p.rules]
    spec = F.array(*[F.struct(F.lit(n).alias("policy"), F.lit(v).alias("version"), F.lit(m).cast("bigint").alias("mask"),
                              F.lit(r).alias("rule"), F.lit(b).cast("bigint").alias("bit")) for n, v, m, r, b in plan])
    by = patterns.select("fail_bits", "n", F.explode(spec).alias("p")).select("fail_bits", "n", "p.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("bigint")
    return by.groupBy("policy", "version", "rule").agg(
        F.sum("n").cast("bigint").alias("documents"), count(hit != 0).alias("rejected"),
        count(hit.bitwiseAND(F.col("bit")) != 0).alias("failed_rule"), count(hit == F.col("bit")).alias("only_this_rule"))


def judged(ledger: DataFrame, policies: tuple[Policy, ...], current: Policy) -> DataFrame:
    """A stored ledger with the verdict of every policy (``kept_<name>_<version>``;
    ``kept``: of the current one) and, from the ablations of the current one:
    ``only_rule``, the rule that alone rejects the document, and ``given_back``,
    how many documents dropping that rule would give back.  The ablations have
    one row per rule and are broadcast."""
    bits = {r.name: 1 << r.bit for r in RULES}
    hit = F.col("fail_bits").bitwiseAND(F.lit(current.mask).cast("bigint"))
    only = F.coalesce(*[F.when(hit == bits[r], F.lit(r)) for r in current.rules])
    back = ablations(ledger, (current,)).select(F.col("rule").alias("only_rule"), F.col("only_this_rule").alias("given_back"))
    out = apply_policy(ledger, current)
    for p in policies:
        out = apply_policy(out, p, f"kept_{p.name}_{p.version}")
    return out.withColumn("only_rule", only).join(F.broadcast(back), "only_rule", "left")


def filter_documents(docs: DataFrame, policy: Policy = CLEAN, text: str = "text") -> DataFrame:
    """The documents the policy keeps, all their columns unchanged."""
    measured = small_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), measure(F.col(text)).alias("m"),
                                           wide(F.col(text)).alias("n_wide"))
    bits = measured.select("row", "m.*", "n_wide").withColumn("fail_bits", fail_bits())
    return bits.where(~fails(F.col("fail_bits"), policy)).select("row.*")

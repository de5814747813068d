"""Deal ledger (S1): one row per deal grain with a column per account.

One hash aggregation over 12 grain keys computes the 32 single-account sums and
4 composite sums as conditional sums (partial aggregation map-side, one
Exchange).  A conditional sum, unlike ``pivot``, gives 0 for an account the
group lacks and NULL only when every matching amount is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ReportConfig
from ..functions.chart import Chart, account_column
from ..functions.columns import deal_key, normalized_region
from ..functions.money import to_cents

GRAIN_KEYS = (
    "market_region", "team_id", "deal_id", "side_represented", "listing_type", "location_name",
    "department_name", "ending_period", "close_date", "final_close_price", "vendor_agent_id",
    "company_agent_id",
)

# Output column order of the deal ledger.
LEADING = (
    "market_region", "side_represented", "deal_id", "listing_type", "location_name",
    "department_name", "team_id", "close_date", "ending_period", "final_close_price",
)
MEASURES = ("total_gci", "gci_less_referral", "commission_expense", "company_dollar", "aep",
            "company_dollar_plus_aep")
TRAILING = ("vendor_agent_id", "company_agent_id")
GRAIN_DIGEST = "__grain"


def _conditional_sum(match_sql: str) -> str:
    return f"SUM(CASE WHEN {match_sql} THEN amount ELSE CAST(0 AS BIGINT) END)"


def _in_list(accounts) -> str:
    return "account_number IN (" + ", ".join(f"'{a}'" for a in accounts) + ")" if accounts else "false"


def by_grain(lines: DataFrame) -> DataFrame:
    """``lines`` dealt out by a digest of their grain, for sums over lines read
    straight from files: there one task reads what the scan's split holds, up
    to 128 MB packed, and its partial sums hold a wide row for each grain of
    it.  The rebalance deals in pieces of the advisory size, and cuts a grain
    with very many lines by the tasks that sent them.  The digest is no grain
    key, so the sums are still combined before they are shuffled."""
    grain = [deal_key(lines), *[F.col(c) for c in GRAIN_KEYS if c != "deal_id"]]
    return lines.withColumn(GRAIN_DIGEST, F.xxhash64(*grain)).hint("rebalance", GRAIN_DIGEST)


def account_sums(lines: DataFrame, cfg: ReportConfig, extra: tuple[str, ...] = ()) -> DataFrame:
    """Ledger lines summed at the deal grain: 12 keys, composites, accounts
    (money in cents).  A grain has one ``ending_period``, so the sums of a
    period need no other period's lines.  ``extra`` columns depend on the grain
    and are carried."""
    keyed = lines.select(
        normalized_region(F.col("market_region"), F.col("location_name"), cfg.split_region).alias("market_region"),
        deal_key(lines).alias("deal_id"),
        *[c for c in GRAIN_KEYS if c not in ("market_region", "deal_id")],
        F.col("account_number").cast("string").alias("account_number"),
        to_cents(F.col("amount")).alias("amount"),
        *extra,
    )
    chart = cfg.chart
    composite_aggs = [F.expr(_conditional_sum(_in_list(accts))).alias(name) for name, accts in chart.composites]
    account_aggs = [F.expr(_conditional_sum(f"account_number = '{a}'")).alias(account_column(a)) for a in chart.accounts]
    return keyed.groupBy(*GRAIN_KEYS, *extra).agg(*composite_aggs, *account_aggs)


def deal_measures(sums: DataFrame, chart: Chart, extra: tuple[str, ...] = ()) -> DataFrame:
    """The deal ledger's columns from its sums."""
    gci, referral = F.col("total_gci"), F.col("total_referral")
    commission, aep = F.col("commission_expense"), F.col("aep")
    gci_less_referral = referral + gci
    company_dollar = gci_less_referral + commission
    return sums.select(
        *LEADING,
        gci.alias("total_gci"),
        gci_less_referral.alias("gci_less_referral"),
        commission.alias("commission_expense"),
        company_dollar.alias("company_dollar"),
        aep.alias("aep"),
        (company_dollar + aep).alias("company_dollar_plus_aep"),
        *[F.col(f"`{c}`") for c in chart.columns],
        *TRAILING,
        *extra,
    )


def deal_ledger(lines: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Aggregate windowed ledger lines to the deal grain (money in cents)."""
    return deal_measures(account_sums(lines, cfg), cfg.chart)


def accounts_outside(lines: DataFrame, chart: Chart) -> DataFrame:
    """Ledger accounts without a measure column, with their lines and amounts:
    what the deal ledger leaves out.  The chart is broadcast, its size being
    bounded by ``MOST_ACCOUNTS``."""
    by = lines.select(F.col("account_number").cast("string").alias("account_number"), to_cents(F.col("amount")).alias("amount"))
    by = by.groupBy("account_number").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("amount").alias("amount"))
    known = lines.sparkSession.createDataFrame([(a,) for a in chart.accounts], "known string")
    return by.join(F.broadcast(known), F.col("account_number") == F.col("known"), "left_anti")

"""Flat-fee isolation (standalone result; the deal output does not use it).

Fee lines are summed per deal and account, subtracted from the matching
account column of each deal, and their per-deal total is added to the flat-fee
account.  Join keys: NULL matches NULL, except the department, where a NULL on
the deal side never matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chart import DEFAULT_CHART, Chart, account_column, column_for_account
from .merge import left_merge, outer_merge

FEE_NULL_SAFE = ("deal_id", "team_id", "ending_period", "market_region", "location_name", "side_represented",
                 "listing_type")
FEE_STRICT = ("department_name",)
FEE_KEYS = FEE_NULL_SAFE + FEE_STRICT


def fee_sums(fee_lines: DataFrame) -> DataFrame:
    """A5: fee amount per deal keys and account (a NULL amount counts as 0)."""
    return fee_lines.groupBy(*FEE_KEYS, "account_number").agg(
        F.sum(F.coalesce(F.col("amount"), F.lit(0).cast("bigint"))).alias("flat_fees_isolated")
    )


def fee_totals(sums: DataFrame) -> DataFrame:
    """The per-account sums re-aggregated per deal keys."""
    return sums.groupBy(*FEE_KEYS).agg(F.sum("flat_fees_isolated").alias("flat_fees_isolated"))


def unmapped_fee_accounts(sums: DataFrame, chart: Chart = DEFAULT_CHART) -> DataFrame:
    """J3's report: fee accounts no measure column carries (they adjust
    nothing), with the number of (deal, account) sums and their total; a
    distributed result, not a print."""
    columns = chart.columns
    mapped = [a for a in chart.accounts if column_for_account(a, columns) is not None]
    return (sums.filter(~F.col("account_number").isin(mapped) | F.col("account_number").isNull())
            .groupBy("account_number")
            .agg(F.count(F.lit(1)).alias("n_sums"), F.sum("flat_fees_isolated").alias("flat_fees_isolated")))


def fee_by_account(deals: DataFrame, sums: DataFrame, broadcast_fees: bool = False, chart: Chart = DEFAULT_CHART) -> DataFrame:
    """J2 + J3: one copy of a deal per matching fee account, with that
    account's column reduced by the fee.  Fee accounts outside the chart
    adjust nothing."""
    joined = left_merge(deals, sums, null_safe=FEE_NULL_SAFE, strict=FEE_STRICT, broadcast_side=broadcast_fees)
    acct, fee = F.col("account_number"), F.col("flat_fees_isolated")
    columns = chart.columns
    adjusted = {}
    for account in chart.accounts:
        target = column_for_account(account, columns)
        if target is not None:
            adjusted[target] = (
                F.when((acct == F.lit(account)) & fee.isNotNull(), F.col(target) - fee).otherwise(F.col(target))
            )
    return joined.select(
        [adjusted[c].alias(c) if c in adjusted else F.col(c) for c in joined.columns
         if c not in ("account_number", "flat_fees_isolated")]
    )


def fee_isolated_ledger(by_account: DataFrame, totals: DataFrame, broadcast_fees: bool = False,
                        key_rows: DataFrame | None = None, chart: Chart = DEFAULT_CHART, total_rows: int | None = None,
                        filter_max_bytes: int = 32 << 20) -> DataFrame:
    """Full outer merge with the per-deal fee totals; the flat-fee account
    gains the total (NULL where either side is missing).  ``key_rows``: the
    deal ledger, whose keys are all that a total can meet (J2 changes no key,
    and an AEP-only row has no department)."""
    merged = outer_merge(by_account, totals, null_safe=FEE_NULL_SAFE, strict=FEE_STRICT,
                         broadcast_side=broadcast_fees, key_rows=key_rows, side_rows=total_rows, filter_max_bytes=filter_max_bytes)
    flat = account_column(chart.flat_fee_account)
    return merged.withColumn(flat, F.col(flat) + F.col("flat_fees_isolated"))

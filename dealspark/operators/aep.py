"""Agent-equity (AEP) reclass: AEP totals per deal move out of commission expense."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merge import outer_merge

AEP_KEYS = ("deal_id", "team_id", "ending_period", "market_region", "side_represented", "listing_type")


def aep_totals(aep_lines: DataFrame) -> DataFrame:
    """A4: AEP amount per 6-key deal; NULL keys form their own groups."""
    return aep_lines.groupBy(*AEP_KEYS).agg(F.sum("amount").alias("aep_adjusted"))


def deal_aep_outer(deals: DataFrame, totals: DataFrame, broadcast_totals: bool = False, total_rows: int | None = None,
                   filter_max_bytes: int = 32 << 20) -> DataFrame:
    """Every deal with its AEP total, plus AEP totals no deal has (those
    carry only the 6 keys).  A total lands on every deal row sharing its keys.
    ``broadcast_totals`` only after a size check of the totals."""
    return outer_merge(deals, totals, null_safe=AEP_KEYS, broadcast_side=broadcast_totals, side_rows=total_rows, filter_max_bytes=filter_max_bytes)


def reclass_commission(merged: DataFrame) -> DataFrame:
    """Commission expense less the AEP total where one matched."""
    adj = F.col("aep_adjusted")
    return merged.withColumn(
        "commission_expense",
        F.when(adj.isNotNull(), F.col("commission_expense") - adj).otherwise(F.col("commission_expense")),
    )

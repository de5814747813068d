"""Principal summary: per principal and year, years pivoted to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ReportConfig
from ..functions.columns import ratio
from .deals import roster_join

YEAR_KEYS = ("team_id", "account_team_name", "ending_year", "market_region", "location_name", "listing_type",
             "market", "original_start_date")
INDEX = ("team_id", "account_team_name", "market_region", "location_name", "listing_type", "market",
         "original_start_date")
SUMMED = ("commission_expense", "gci_less_referral", "net_company_dollar", "aep_total")
PIVOTED = ("deal_count", "ncd_margin", "gci_less_referral", "commission_expense", "net_company_dollar", "aep_total")


LEDGER_SIDE = ("team_id", "ending_year", "market_region", "location_name", "listing_type", "deal_id")


def principal_year(rows: DataFrame, slim_roster: DataFrame, broadcast_roster: bool = False,
                   clustered: tuple[str, DataFrame] | None = None) -> DataFrame:
    """A7 + P18: distinct deals (a NULL deal id counts once) and four sums per
    principal and year over the filled deal output, plus the NCD margin.

    The deal output repeats each deal row once per principal of its team, so
    the deal rows are first summed per (team, year, region, location, listing,
    deal) and only those sums meet the roster.  Then per principal and deal
    (rows of unmatched teams share the NULL principal) and per principal: two
    small aggregations instead of a distinct aggregate."""
    key = (clustered[0],) if clustered else ()
    per_team_deal = rows.groupBy(*LEDGER_SIDE, *key).agg(*[F.sum(c).alias(c) for c in SUMMED])
    joined = roster_join(per_team_deal, slim_roster, broadcast_roster, clustered).select(
        F.col("roster_team_id").alias("team_id"),
        *[c for c in YEAR_KEYS if c != "team_id"],
        "deal_id",
        *SUMMED,
    )
    per_deal = joined.groupBy(*YEAR_KEYS, "deal_id").agg(*[F.sum(c).alias(c) for c in SUMMED])
    per_year = per_deal.groupBy(*YEAR_KEYS).agg(
        F.count(F.lit(1)).alias("deal_count"), *[F.sum(c).alias(c) for c in SUMMED]
    )
    return per_year.withColumn(
        "ncd_margin", F.coalesce(ratio(F.col("net_company_dollar"), F.col("gci_less_referral")), F.lit(0.0))
    )


def principal_pivot(per_year: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """R1 + R2: one row per principal index, ``<value>_<year>`` columns for the
    given years (no discovery job), which are all the windows can hold; a
    missing year gives NULLs."""
    labels = [str(y) for y in years]
    piv = per_year.groupBy(*INDEX).pivot("ending_year", labels).agg(*[F.max(v).alias(v) for v in PIVOTED])
    return piv.select(
        *INDEX, *[F.col(f"{y}_{v}").alias(f"{v}_{y}") for v in PIVOTED for y in labels]
    )


def crosswalk_frame(spark: SparkSession, cfg: ReportConfig) -> DataFrame:
    """The configured (market_region, market) pairs, deduplicated."""
    pairs = sorted(set(cfg.crosswalk))
    return spark.createDataFrame(pairs, "market_region string, market string")


def market_scope(pivoted: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Keep principals whose (region, market) pair is configured.  The
    crosswalk is config-sized, so it is broadcast."""
    return pivoted.join(F.broadcast(crosswalk), ["market_region", "market"], "left_semi")


def with_producing_flags(scoped: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """1 where the principal has any row in the year."""
    return scoped.select(
        "*",
        *[F.col(f"gci_less_referral_{y}").isNotNull().cast("int").alias(f"num_producing_principals_{y}")
          for y in years],
    )


"""Principal cohorts by start date, compared within each market."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CohortBand, ReportConfig
from ..functions.columns import ratio
from ..session import materialize

_OPS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "==": operator.eq,
        "!=": operator.ne}

GROUP = ("cohort", "market_region", "market", "location_name", "team_id", "account_team_name", "listing_type")
# Order of rows inside a (market, cohort) group for the positional share; NULL
# sorts as the text 'tmp'.
POSITION_ORDER = ("market", "location_name", "team_id", "account_team_name", "listing_type")
NULL_TEXT = "tmp"


def band_predicate(band: CohortBand, start: Column) -> Column:
    """The band's bounds ANDed; no bounds selects everything."""
    if not band.bounds:
        return F.lit(True)
    return reduce(operator.and_, [_OPS[op](start, F.lit(day)) for op, day in band.bounds])


def cohort_members(principals: DataFrame, bands: tuple[CohortBand, ...]) -> DataFrame:
    """Each principal row once per band it falls in, labelled ``cohort``.
    One narrow pass (explode of the matching labels), no join and no rescan."""
    start = F.col("original_start_date")
    labels = F.array_compact(F.array(*[F.when(band_predicate(b, start), F.lit(b.name)) for b in bands]))
    return principals.select(F.explode(labels).alias("cohort"), "*")


def _sum_measures(years: tuple[int, ...]):
    out = []
    for y in years:
        out.append((f"num_producing_principals_{y}", f"num_producing_principals_{y}"))
    for y in years:
        out.append((f"deal_count_{y}", f"unit_total_{y}"))
    for v in ("gci_less_referral", "commission_expense", "net_company_dollar", "aep_total"):
        for y in years:
            out.append((f"{v}_{y}", f"{v}_{y}"))
    return out


def cohort_totals(members: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """12 sums per cohort and principal key; a sum over no values is 0."""
    aggs = [F.coalesce(F.sum(src), F.lit(0).cast("bigint")).alias(name) for src, name in _sum_measures(years)]
    return members.groupBy(*GROUP).agg(*aggs)


def with_margins(totals: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """P20 + P21: NCD margin per year (NULL on zero GCI), variance last - first."""
    margins = [ratio(F.col(f"net_company_dollar_{y}"), F.col(f"gci_less_referral_{y}")).alias(f"ncd_margin_{y}")
               for y in years]
    out = totals.select("*", *margins)
    return out.withColumn("ncd_variance", F.col(f"ncd_margin_{years[-1]}") - F.col(f"ncd_margin_{years[0]}"))


def with_position(totals: DataFrame) -> DataFrame:
    """1-based position of each row inside its (market, cohort) group.

    No task sorts a group: the rows are range-partitioned by (market, cohort,
    order), numbered where they are and stored; a row's place is its number
    plus the rows of the partitions before, its position the distance to the
    first place of its group."""
    order = ["market_region", "cohort", *[F.coalesce(F.col(c), F.lit(NULL_TEXT)) for c in POSITION_ORDER]]
    lined = totals.repartitionByRange(*order).sortWithinPartitions(*order)
    lined = materialize(lined.withColumn("__line", F.monotonically_increasing_id()), "cohort-positions")
    part = F.shiftright("__line", 33).alias("__part")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = lined.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))  # one row per shuffle partition
    parts = parts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    placed = lined.withColumn("__part", part).join(F.broadcast(parts), "__part")
    placed = placed.withColumn("__at", F.col("__before") + F.col("__line").bitwiseAND(F.lit((1 << 33) - 1)))
    first = placed.groupBy(F.col("market_region").alias("__m"), F.col("cohort").alias("__c")).agg(F.min("__at").alias("__first"))
    # One row per region in scope and cohort band, both from the config.
    out = placed.join(F.broadcast(first), placed["market_region"].eqNullSafe(first["__m"]) & (placed["cohort"] == first["__c"]))
    return out.select(*totals.columns, (F.col("__at") - F.col("__first") + 1).cast("int").alias("position"))


def positional_share(totals: DataFrame, years: tuple[int, ...], total_cohort: str) -> DataFrame:
    """W1 + J7 + P22: a row's GCI over the GCI of the total-cohort row at the
    same position in the same market (the established report's alignment);
    the total cohort itself gets 1.  The total row's value is fetched with a
    window over (market, position), so the summary is computed once (no
    self-join)."""
    ranked = with_position(totals)
    is_total = F.col("cohort") == F.lit(total_cohort)
    at_position = Window.partitionBy("market_region", "position")
    fetched = ranked.select(
        "*",
        *[F.max(F.when(is_total, F.col(f"gci_less_referral_{y}"))).over(at_position).alias(f"total_gci_at_position_{y}")
          for y in years],
    )
    return fetched.select(
        "*",
        *[F.when(is_total, F.lit(1.0))
          .otherwise(ratio(F.col(f"gci_less_referral_{y}"), F.col(f"total_gci_at_position_{y}")))
          .alias(f"pct_gci_less_referral_{y}") for y in years],
    )


def market_total_share(totals: DataFrame, years: tuple[int, ...], total_cohort: str) -> DataFrame:
    """A row's GCI over the market's total-cohort GCI: one sum per market
    (partial sums in each task), joined back by broadcast - the markets in
    scope come from the config.  ``totals`` is read twice, so hand in a stored
    frame."""
    is_total = F.col("cohort") == F.lit(total_cohort)
    markets = totals.where(is_total).groupBy(F.col("market_region").alias("__m")).agg(
        *[F.sum(f"gci_less_referral_{y}").alias(f"market_gci_less_referral_{y}") for y in years])
    summed = totals.join(F.broadcast(markets), totals["market_region"].eqNullSafe(markets["__m"]), "left")
    return summed.select(
        *totals.columns,
        *[f"market_gci_less_referral_{y}" for y in years],
        *[ratio(F.col(f"gci_less_referral_{y}"), F.col(f"market_gci_less_referral_{y}")).alias(f"pct_gci_less_referral_{y}")
          for y in years],
    )


MIX_LEADING = ("cohort", "market", "location_name", "team_id", "account_team_name", "listing_type")


def cohort_mix(totals: DataFrame, cfg: ReportConfig) -> DataFrame:
    """principal_mix_data: cohort sums with margins, variance and GCI share."""
    years = cfg.report_years
    if cfg.share_mode == "positional":
        shared = positional_share(totals, years, cfg.total_cohort)
    else:
        shared = market_total_share(materialize(totals, "cohort-totals"), years, cfg.total_cohort)
    out = with_margins(shared, years)
    sums = [name for _, name in _sum_measures(years)]
    return out.select(
        *MIX_LEADING, *sums, *[f"ncd_margin_{y}" for y in years], "ncd_variance",
        *[f"pct_gci_less_referral_{y}" for y in years], "market_region",
    )

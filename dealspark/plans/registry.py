"""Named queries: every operator of the job as a DataFrame over ``sf_dir``.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
given tables.  Extracts and their aggregates are lazy; what builds on the AEP
or fee merge stores the merge's side first (``Stages``).  Money leaves as
double (exact long cents inside).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ReportConfig
from ..functions.columns import deal_key as deal_key_col
from ..functions.columns import money_to_double, normalized_region
from ..operators import cohorts, deals, roster
from ..sources.extracts import fixture_view_inputs
from ..sources.fixtures import LATE, MAIN
from .operations import operations
from .pipeline import Stages

Query = Callable[[SparkSession, str], DataFrame]


def _stages(spark: SparkSession, sf_dir: str, cfg: ReportConfig) -> Stages:
    return Stages(spark, fixture_view_inputs(spark, sf_dir), cfg)


def _stage(name: str, cfg: ReportConfig = MAIN) -> Query:
    return lambda spark, sf_dir: money_to_double(getattr(_stages(spark, sf_dir, cfg), name))


def _extract(name: str, cfg: ReportConfig = MAIN) -> Query:
    return lambda spark, sf_dir: money_to_double(getattr(_stages(spark, sf_dir, cfg).extracts, name))


def normalized_region_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 over the whole ledger: lines per (region, location) with the region
    the job uses."""
    lines = fixture_view_inputs(spark, sf_dir).ledger(None)
    return lines.groupBy("market_region", "location_name").agg(F.count(F.lit(1)).alias("n_lines")).select(
        "market_region", "location_name",
        normalized_region(F.col("market_region"), F.col("location_name"), MAIN.split_region).alias("normalized_region"),
        "n_lines",
    )


def deal_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2-P4 over the whole ledger: lines per (deal id, line id) with the
    canonical deal key."""
    lines = fixture_view_inputs(spark, sf_dir).ledger(None)
    return lines.groupBy("deal_id", "deal_line_id").agg(F.count(F.lit(1)).alias("n_lines")).select(
        "deal_id", "deal_line_id", deal_key_col(lines).alias("deal_key"), "n_lines"
    )


def roster_agents_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _stages(spark, sf_dir, MAIN)
    return money_to_double(roster.roster_agents(st.extracts.roster))


def deal_splits_q(cfg: ReportConfig) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return money_to_double(deals.with_splits(_stages(spark, sf_dir, cfg).reclassed))
    return q


def cohort_share_positional_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _stages(spark, sf_dir, MAIN)
    years = MAIN.report_years
    shared = cohorts.positional_share(st.cohort_totals, years, MAIN.total_cohort)
    return money_to_double(shared.select(
        *cohorts.GROUP, "position",
        *[f"gci_less_referral_{y}" for y in years],
        *[f"total_gci_at_position_{y}" for y in years],
        *[f"pct_gci_less_referral_{y}" for y in years],
    ))


def cohort_share_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _stages(spark, sf_dir, MAIN)
    years = MAIN.report_years
    shared = cohorts.market_total_share(st.store("cohort_totals"), years, MAIN.total_cohort)
    return money_to_double(shared.select(
        *cohorts.GROUP,
        *[f"gci_less_referral_{y}" for y in years],
        *[f"market_gci_less_referral_{y}" for y in years],
        *[f"pct_gci_less_referral_{y}" for y in years],
    ))


def registry() -> dict[str, Query]:
    return {
        # sources
        "deal_ledger": _extract("transactions"),
        "aep_lines": _extract("aep"),
        "aep_lines_reset": _extract("aep", LATE),
        "fee_lines": _extract("fees"),
        "fee_lines_reset": _extract("fees", LATE),
        "principal_roster": _extract("roster"),
        # scalar expressions
        "normalized_region": normalized_region_q,
        "deal_key": deal_key_q,
        "roster_agents": roster_agents_q,
        "roster_slim": _stage("roster_slim"),
        # AEP reclass and the deal output
        "aep_totals": _stage("aep_totals"),
        "deal_aep_outer": _stage("deal_aep_outer"),
        "deal_aep_outer_late": _stage("deal_aep_outer", LATE),
        "deal_aep_reclass": _stage("reclassed"),
        "deal_splits": deal_splits_q(MAIN),
        "deal_splits_late": deal_splits_q(LATE),
        "deal_data": _stage("deal_data"),
        "deal_data_late": _stage("deal_data", LATE),
        # principal summary
        "principal_year": _stage("principal_year"),
        "principal_pivot": _stage("principal_pivot"),
        "principal_pivot_late": _stage("principal_pivot", LATE),
        "market_scope": _stage("market_scope"),
        "principal_data": _stage("principal_data"),
        "principal_data_late": _stage("principal_data", LATE),
        # cohorts
        "cohort_members": _stage("cohort_members"),
        "cohort_totals": _stage("cohort_totals"),
        "cohort_share_positional": cohort_share_positional_q,
        "cohort_share": cohort_share_q,
        "cohort_mix": _stage("principal_mix_data"),
        "cohort_mix_late": _stage("principal_mix_data", LATE),
        # flat-fee isolation
        "fee_sums": _stage("fee_sums"),
        "fee_totals": _stage("fee_totals"),
        "fee_unmapped_accounts": _stage("unmapped_fee_accounts"),
        "fee_by_account": _stage("fee_by_account"),
        "fee_isolated_ledger": _stage("fee_isolated_ledger"),
        # how results are kept and published
        **operations(),
    }

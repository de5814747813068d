"""The job: extracts -> deal output -> two summaries -> sinks."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..config import ReportConfig
from ..functions.columns import money_to_decimal
from ..operators import aep, cohorts, deals, fees, principals, roster
from ..operators.merge import fits_broadcast
from ..session import Measured, materialize, materialize_measured
from ..sources import extracts
from ..sources.extracts import Inputs
from ..sources.sinks import REJECTED, write_outputs
from .restart import StageStore


class Stages:
    """Every intermediate result of the job, built on first use.  Building a
    stage after the AEP or fee merge, or a positional share, runs jobs: it
    stores the merge's side, the slim roster or the numbered cohort rows.  Money stays exact
    (long cents) throughout."""

    def __init__(self, spark: SparkSession, inputs: Inputs, cfg: ReportConfig, kept: StageStore | None = None):
        self.spark, self.inputs, self.cfg, self.kept = spark, inputs, cfg, kept

    @cached_property
    def extracts(self) -> extracts.Extracts:
        return extracts.get_extracts(self.inputs, self.cfg)

    @cached_property
    def aep_totals(self) -> DataFrame:
        return aep.aep_totals(self.extracts.aep)

    # The merges read their side frame several times, so it is stored once on
    # first use; its rows and decoded bytes are counted on the way, for the
    # size check before broadcasting and for the key bitmap.
    @cached_property
    def aep_stored(self) -> Measured:
        return materialize_measured(self.aep_totals, "aep-totals")

    @cached_property
    def fees_stored(self) -> Measured:
        return materialize_measured(self.fee_sums, "fee-sums")

    @cached_property
    def roster_stored(self) -> Measured:
        return materialize_measured(self.roster_slim, "roster-slim")

    def _small(self, stored: Measured) -> bool:
        return fits_broadcast(stored, self.cfg.broadcast_max_bytes)

    @cached_property
    def deal_aep_outer(self) -> DataFrame:
        totals = self.aep_stored
        return aep.deal_aep_outer(self.extracts.transactions, totals.frame, self._small(totals), totals.rows, self.cfg.filter_max_bytes)

    @cached_property
    def reclassed(self) -> DataFrame:
        return aep.reclass_commission(self.deal_aep_outer)

    @cached_property
    def roster_slim(self) -> DataFrame:
        return roster.roster_slim(self.extracts.roster)

    @cached_property
    def deal_rows(self) -> DataFrame:
        return deals.deal_rows(self.reclassed)

    @cached_property
    def deal_data(self) -> DataFrame:
        return deals.attach_roster(self.deal_rows, self.roster_stored.frame, self._small(self.roster_stored))

    @cached_property
    def principal_year(self) -> DataFrame:
        return principals.principal_year(self.deal_rows, self.roster_stored.frame, self._small(self.roster_stored))

    @cached_property
    def principal_pivot(self) -> DataFrame:
        return principals.principal_pivot(self.principal_year, self.cfg.pivot_years)

    @cached_property
    def market_scope(self) -> DataFrame:
        return principals.market_scope(self.principal_pivot, principals.crosswalk_frame(self.spark, self.cfg))

    @cached_property
    def principal_data(self) -> DataFrame:
        return principals.with_producing_flags(self.market_scope, self.cfg.pivot_years)

    @cached_property
    def cohort_members(self) -> DataFrame:
        return cohorts.cohort_members(self.principal_data, self.cfg.cohorts)

    @cached_property
    def cohort_totals(self) -> DataFrame:
        return cohorts.cohort_totals(self.cohort_members, self.cfg.report_years)

    @cached_property
    def principal_mix_data(self) -> DataFrame:
        return cohorts.cohort_mix(self.cohort_totals, self.cfg)

    # flat-fee isolation: standalone, not used by the outputs
    @cached_property
    def fee_sums(self) -> DataFrame:
        return fees.fee_sums(self.extracts.fees)

    @cached_property
    def fee_totals(self) -> DataFrame:
        return fees.fee_totals(self.fee_sums)

    @cached_property
    def fee_totals_stored(self) -> Measured:
        return materialize_measured(fees.fee_totals(self.fees_stored.frame), "fee-totals")

    @cached_property
    def unmapped_fee_accounts(self) -> DataFrame:
        return fees.unmapped_fee_accounts(self.fee_sums, self.cfg.chart)

    @cached_property
    def fee_by_account(self) -> DataFrame:
        return fees.fee_by_account(self.reclassed, self.fees_stored.frame, self._small(self.fees_stored), self.cfg.chart)

    @cached_property
    def fee_isolated_ledger(self) -> DataFrame:
        totals = self.fee_totals_stored
        return fees.fee_isolated_ledger(self.fee_by_account, totals.frame, self._small(totals), key_rows=self.extracts.transactions,
                                        chart=self.cfg.chart, total_rows=totals.rows, filter_max_bytes=self.cfg.filter_max_bytes)

    def store(self, name: str) -> DataFrame:
        """Cut lineage at a stage: store it once; all that builds on it reads
        the stored table.  With a stage store, a stage that an earlier run
        finished is not even built."""
        stored = self.kept.get(name, lambda: getattr(self, name)) if self.kept else materialize(getattr(self, name), name)
        self.__dict__[name] = stored
        return stored


@dataclass(frozen=True)
class Outputs:
    deal_data: DataFrame
    principal_data: DataFrame
    principal_mix_data: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"deal_data": self.deal_data, "principal_data": self.principal_data,
                "principal_mix_data": self.principal_mix_data}


def build_outputs(stages: Stages) -> Outputs:
    """The three outputs, money as ``decimal(38,2)``."""
    return Outputs(
        deal_data=money_to_decimal(stages.deal_data),
        principal_data=money_to_decimal(stages.principal_data),
        principal_mix_data=money_to_decimal(stages.principal_mix_data),
    )


def run(spark: SparkSession, inputs: Inputs, cfg: ReportConfig, out_base: str, run_date: dt.date,
        fmt: str = "csv", null_label: str | None = None, partition_deals_by_year: bool = False,
        stage_root: str | None = None) -> dict[str, str]:
    """Run the job and publish the three outputs, and the rejected lines where
    the source may have any.

    The deal rows (ledger pivot + AEP reclass + splits, before the roster
    fan-out) feed the deal output and both summaries, and the principal summary
    is an output and the cohorts' input, so both are stored once in the
    cluster's checkpoint folder: the outputs read those tables - the summaries
    only the columns they use - and a lost executor does not send the job back
    to the raw ledger.  ``partition_deals_by_year`` writes the deal output in
    one folder per ``ending_year``.  With ``stage_root`` the stored stages are
    kept there, and a rerun over the same inputs (their ``version``) and
    settings goes on after the last one finished."""
    if stage_root and not inputs.version:
        raise ValueError("stages are kept for inputs of a known version only")
    stages = Stages(spark, inputs, cfg, StageStore(spark, stage_root, cfg, inputs.version()) if stage_root else None)
    stages.store("deal_rows")
    stages.store("principal_data")
    partition_by = {"deal_data": ("ending_year",)} if partition_deals_by_year else None
    outputs = build_outputs(stages).as_dict()
    if inputs.rejected is not None:
        outputs[REJECTED] = inputs.rejected(cfg.whole_window)
    return write_outputs(outputs, out_base, run_date, fmt=fmt, null_label=null_label, partition_by=partition_by)

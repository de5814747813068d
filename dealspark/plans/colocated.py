"""The job's stages over bucketed tables (J1, J5), for sides too large to
broadcast: the ledger lines lie in buckets of the AEP key, the deal rows in
buckets of the team."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ReportConfig
from ..functions.columns import deal_key, normalized_region
from ..operators import colocated, deals, principals
from ..operators.aep import AEP_KEYS
from ..operators.colocated import KEY
from ..operators.ledger import GRAIN_KEYS, account_sums, deal_measures
from ..sources.extracts import Inputs, ledger_window
from .pipeline import Stages

BUCKETS, SALTS = 16, 16
OTHER_GRAIN = tuple(k for k in GRAIN_KEYS if k not in AEP_KEYS)
TEAM = ("team_id",)
TEAM_OTHERS = ("deal_id", "ending_period", "market_region", "location_name", "listing_type")


class BucketedStages(Stages):
    """``buckets``: tasks of the joins; ``salts``: buckets that one key spreads
    over at most."""

    def __init__(self, spark: SparkSession, inputs: Inputs, cfg: ReportConfig, buckets: int = BUCKETS, salts: int = SALTS):
        super().__init__(spark, inputs, cfg)
        self.buckets, self.salts = buckets, salts

    @cached_property
    def bucketed_lines(self) -> DataFrame:
        """The window's lines in buckets of the AEP key.  All lines of a deal
        grain share the key: salt and digest are of grain columns."""
        lines = ledger_window(self.inputs, self.cfg).drop("item_name", "item_id", "item_type_name")
        region = normalized_region(F.col("market_region"), F.col("location_name"), self.cfg.split_region)
        grain = [{"deal_id": deal_key(lines), "market_region": region}.get(c, F.col(c)).alias(c) for c in GRAIN_KEYS]
        rows = lines.select(F.struct(*lines.columns).alias("line"), *grain)
        rows = rows.select("line.*", colocated.salted_key(AEP_KEYS, OTHER_GRAIN, self.salts).alias(KEY))
        return colocated.bucketed(rows, self.buckets, "ledger_lines")

    @cached_property
    def clustered_deals(self) -> DataFrame:
        """The deal ledger with its bucket key; no shuffle."""
        lines = self.bucketed_lines
        sums = account_sums(lines, self.cfg, extra=(KEY,))
        return deal_measures(sums, self.cfg.chart, extra=(KEY,))

    @cached_property
    def deal_aep_outer(self) -> DataFrame:
        return colocated.outer_merge(self.clustered_deals, self.aep_stored.frame, AEP_KEYS, self.salts).drop(KEY)

    @cached_property
    def bucketed_deal_rows(self) -> DataFrame:
        """The deal rows, before the roster fan-out, in buckets of the team."""
        rows = self.deal_rows.withColumn(KEY, colocated.salted_key(TEAM, TEAM_OTHERS, self.salts))
        return colocated.bucketed(rows, self.buckets, "deal_rows")

    @cached_property
    def clustered_roster(self) -> DataFrame:
        slim = self.roster_stored.frame
        side = colocated.every_salt(slim.withColumn("team_id", F.col("roster_team_id")), TEAM, self.salts)
        return side.drop("team_id").withColumnRenamed(KEY, "__roster_key")

    @cached_property
    def deal_data(self) -> DataFrame:
        return deals.attach_roster(self.bucketed_deal_rows, self.roster_stored.frame, clustered=(KEY, self.clustered_roster))

    @cached_property
    def principal_year(self) -> DataFrame:
        return principals.principal_year(self.bucketed_deal_rows, self.roster_stored.frame, clustered=(KEY, self.clustered_roster))

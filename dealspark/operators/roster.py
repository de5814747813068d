"""Roster adjustments and the roster side of the deal join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Roster columns carried into the deal output, in order.
SLIM_COLUMNS = (
    "team_id", "account_team_name", "original_start_date", "market", "separation_date", "number_of_agents",
    "total_split", "base_split", "resource_fee_type", "resource_fee_option", "resource_fee_pct",
    "resource_fee_cap", "actual_resource_fee", "policy_resource_fee",
)


def roster_agents(roster: DataFrame) -> DataFrame:
    """P10: a principal with 0 agents counts as 1 (NULL stays NULL)."""
    n = F.col("number_of_agents")
    return roster.withColumn("number_of_agents", F.when(n == 0, F.lit(1).cast(roster.schema["number_of_agents"].dataType)).otherwise(n))


def roster_slim(roster: DataFrame) -> DataFrame:
    """F8 + P24: principals with a team, reduced to the columns the deal output
    carries; the team key is renamed so both team columns can coexist."""
    kept = roster_agents(roster).filter(F.col("team_id").isNotNull())
    return kept.select(*SLIM_COLUMNS).withColumnRenamed("team_id", "roster_team_id")

"""Deal output: roster join, split ratios, fills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import fill_numeric_zero, ratio

DERIVED = ("agent_split", "company_split", "net_company_dollar", "aep_total", "ncd_and_aep_total", "ending_year")


def with_splits(reclassed: DataFrame) -> DataFrame:
    """P12-P17 (+N5, N8): ratios and totals from the raw operands; every fill
    happens last, so a missing operand yields 0 rather than a partial sum."""
    c, g = F.col("commission_expense"), F.col("gci_less_referral")
    aep, adj = F.col("aep"), F.col("aep_adjusted")
    zero = F.lit(0).cast("bigint")
    split = ratio(c, g)
    ncd = g + c
    aep_total = aep + F.coalesce(adj, zero)
    return reclassed.select(
        *[F.col(x) for x in reclassed.columns if x != "aep_adjusted"],
        F.coalesce(adj, zero).alias("aep_adjusted"),
        F.coalesce(split, F.lit(0.0)).alias("agent_split"),
        F.coalesce(F.lit(1.0) + split, F.lit(0.0)).alias("company_split"),
        F.coalesce(ncd, zero).alias("net_company_dollar"),
        F.coalesce(aep_total, zero).alias("aep_total"),
        F.coalesce(ncd + aep_total, zero).alias("ncd_and_aep_total"),
        F.year("ending_period").cast("string").alias("ending_year"),
    )


def deal_rows(reclassed: DataFrame) -> DataFrame:
    """Splits and the numeric fill on the deal rows, before the roster join:
    they depend on deal columns only, so they run once per deal row."""
    return fill_numeric_zero(with_splits(reclassed))


def roster_join(rows: DataFrame, slim_roster: DataFrame, broadcast_roster: bool = False,
                clustered: tuple[str, DataFrame] | None = None) -> DataFrame:
    """Left join of rows with the principals of their team.  ``clustered``
    names the rows' bucket key and gives the roster by that key (column
    ``__roster_key``); then only the roster moves."""
    if clustered is not None:
        key, side = clustered
        return rows.join(side, F.col(key) == F.col("__roster_key"), "left").drop(key, "__roster_key")
    roster_side = F.broadcast(slim_roster) if broadcast_roster else slim_roster
    return rows.join(roster_side, F.col("team_id") == F.col("roster_team_id"), "left")


def attach_roster(rows: DataFrame, slim_roster: DataFrame, broadcast_roster: bool = False,
                  clustered: tuple[str, DataFrame] | None = None) -> DataFrame:
    """J5 + N6: every deal row once per principal of its team (NULL team never
    matches); the roster's numeric columns are 0 where no principal matched.

    ``broadcast_roster`` (only after a size check of the roster) keeps the
    deal rows where they are; ``clustered`` (see ``roster_join``) does so with
    bucketed rows; otherwise both sides are shuffled on the team key, with
    adaptive skew splitting of the deal side."""
    joined = roster_join(rows, slim_roster, broadcast_roster, clustered)
    columns = [c for c in rows.columns if clustered is None or c != clustered[0]]
    numeric = [f.name for f in slim_roster.schema.fields if isinstance(f.dataType, T.NumericType)]
    return fill_numeric_zero(joined.select(*slim_roster.columns, *columns), only=tuple(numeric))


"""Inputs and the four extracts (ledger window, AEP lines, fee lines, roster).

An ``Inputs`` holds the ledger as a function of the period window, so every
extract hands its window to the source and the restriction reaches the scan
(Parquet ``PushedFilters`` / partition pruning on ``ending_period``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ReportConfig
from ..functions.columns import deal_key, normalized_region
from ..functions.money import SOURCE_MONEY, to_cents
from . import files, fixtures

Window = tuple[dt.date, dt.date]
STORED_ORDER = ("ending_period", "account_number", "item_id")  # of the lines in a stored file


@dataclass(frozen=True)
class Inputs:
    ledger: Callable[[Window | None], DataFrame]  # ledger lines with ending_period in the window (None: all)
    roster: DataFrame  # principal roster history
    # Kept sums of the window's lines at the deal grain (``ledger_store``), where there are any.
    account_sums: Callable[[Window], DataFrame] | None = None
    # Lines of the window, and those without a period, that the job cannot use, with a reason; where the source may have any.
    rejected: Callable[[Window], DataFrame] | None = None
    # What tells one state of the input tables from another (``plans.restart``), where known; called when needed.
    version: Callable[[], str] | None = None


def fixture_view_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Inputs as lazy views over the driver tables: every read re-derives the
    ledger from the TPC-H-style tables (the period window still reaches the
    orders scan).  Nothing is stored, no job runs."""
    base = fixtures.ledger_base(spark, sf_dir)
    return Inputs(
        ledger=lambda w: fixtures.window(base, w),
        roster=fixtures.principal_roster(spark, sf_dir),
    )


def store_inputs(inputs: Inputs, root: str) -> tuple[str, str]:
    """Write ``inputs`` as tables under ``root``: the ledger partitioned by
    ``ending_period`` (how a ledger table is kept), the roster as plain
    Parquet; the paths are returned.  The rebalance hint sizes the write
    tasks by the data: a large period is split, small ones share a task.  A
    file's lines are sorted by account and item, so that its statistics let
    the AEP and fee scans (F2, F3) skip most of it."""
    ledger, roster = f"{root.rstrip('/')}/ledger_lines", f"{root.rstrip('/')}/principal_roster"
    lines = inputs.ledger(None).hint("rebalance", "ending_period").sortWithinPartitions(*STORED_ORDER)
    lines.write.mode("overwrite").partitionBy("ending_period").parquet(ledger)
    inputs.roster.write.mode("overwrite").parquet(roster)
    return ledger, roster


# --- input contract ------------------------------------------------------------

# Ledger columns and the kinds of types they may have.
LEDGER_COLUMNS = {
    "deal_id": "id", "deal_line_id": "id", "team_id": "text", "market_region": "text", "location_name": "text",
    "department_name": "text", "side_represented": "text", "listing_type": "text", "close_date": "date",
    "ending_period": "date", "final_close_price": "money", "vendor_agent_id": "text", "company_agent_id": "text",
    "account_number": "id", "item_type_name": "text", "item_id": "text", "item_name": "text", "amount": "money",
}


def _is(kind: str, dtype: T.DataType) -> bool:
    if kind == "text":
        return isinstance(dtype, T.StringType)
    if kind == "date":
        return isinstance(dtype, T.DateType)
    if kind == "money":  # whole cents: nothing is rounded on the way in
        return isinstance(dtype, T.IntegralType) or (isinstance(dtype, T.DecimalType) and dtype.scale <= 2)
    return isinstance(dtype, (T.StringType, T.IntegralType, T.DecimalType))


def checked_ledger(lines: DataFrame) -> DataFrame:
    """The ledger columns of ``lines``; a column that is missing, or of a type
    that would lose money or dates silently (a finer scale than cents, a
    double, a text date), fails here."""
    types = dict((f.name, f.dataType) for f in lines.schema.fields)
    if missing := [c for c in LEDGER_COLUMNS if c not in types]:
        raise ValueError(f"ledger lacks columns {missing}")
    if wrong := [f"{c} {types[c].simpleString()}" for c, kind in LEDGER_COLUMNS.items() if not _is(kind, types[c])]:
        raise ValueError(f"ledger columns of unsupported types: {wrong}")
    return lines.select(*LEDGER_COLUMNS)


# Reasons for which a line is set aside.
NO_DEAL, TOO_LARGE, NO_PERIOD = "deal id is not a number", "amount too large", "no ending period"


def rejection(lines: DataFrame) -> Column:
    """Why a line cannot be used, NULL if it can: its deal id (or the line id
    in its place) is a text that is no number, its amount does not fit
    ``decimal(18,2)``, or it has no period and so is in no window.  Columns
    whose type rules a reason out cost nothing."""
    types = {f.name: f.dataType for f in lines.schema.fields}
    reason = F.when(F.col("ending_period").isNull(), F.lit(NO_PERIOD))
    if isinstance(types["deal_id"], T.StringType) or isinstance(types["deal_line_id"], T.StringType):
        key = F.coalesce(F.col("deal_id").cast("string"), F.col("deal_line_id").cast("string"))
        number = F.round(key.try_cast("decimal(38,6)"), 0).try_cast("bigint")
        reason = F.when(key.isNotNull() & number.isNull(), F.lit(NO_DEAL)).otherwise(reason)
    if not isinstance(types["amount"], T.DecimalType) or types["amount"].precision - types["amount"].scale > 16:
        large = F.col("amount").isNotNull() & F.col("amount").try_cast(SOURCE_MONEY).isNull()
        reason = F.when(large & reason.isNull(), F.lit(TOO_LARGE)).otherwise(reason)
    return reason


def quarantined(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines the job can use, and the others with their ``reason``; both
    read the source on their own.  Where the types rule all reasons but the
    missing period out, the first are the lines as they are: a window drops
    lines without a period anyway, and its filter alone reaches the scan."""
    reason = rejection(lines)
    types = {f.name: f.dataType for f in lines.schema.fields}
    safe = not any(isinstance(types[c], T.StringType) for c in ("deal_id", "deal_line_id")) and (
        isinstance(types["amount"], T.DecimalType) and types["amount"].precision - types["amount"].scale <= 16)
    return lines if safe else lines.where(reason.isNull()), lines.withColumn("reason", reason).where(F.col("reason").isNotNull())


def renamed(df: DataFrame, names: dict[str, str] | None) -> DataFrame:
    """``df`` with source column names mapped to the job's."""
    if missing := [c for c in names or {} if c not in df.columns]:
        raise ValueError(f"columns to rename are missing: {missing}")
    return df.select(*[F.col(f"`{c}`").alias((names or {}).get(c, c)) for c in df.columns])


def table_inputs(spark: SparkSession, ledger: str, roster: str, fmt: str = "parquet",
                 ledger_names: dict[str, str] | None = None, roster_names: dict[str, str] | None = None) -> Inputs:
    """Inputs over stored tables: a catalog name, or a path read with ``fmt``,
    with columns renamed from the source's names.  Storing the ledger
    partitioned by ``ending_period`` makes the window a partition filter.
    Lines that cannot be used are set aside (``rejected``)."""

    def load(name: str) -> DataFrame:
        return spark.read.format(fmt).load(name) if "/" in name else spark.table(name)

    base, rejected = quarantined(checked_ledger(renamed(load(ledger), ledger_names)))
    paths = [name for name in (ledger, roster) if "/" in name]

    def within(w: Window) -> Column:
        return F.col("ending_period").between(F.lit(w[0]), F.lit(w[1]))

    return Inputs(
        ledger=lambda w: base if w is None else base.filter(within(w)),
        roster=renamed(load(roster), roster_names),
        rejected=lambda w: rejected.filter(F.col("ending_period").isNull() | within(w)),
        version=(lambda: files.fingerprint(spark, paths)) if len(paths) == 2 else None,
    )


# --- ledger window (F1) ------------------------------------------------------


def ledger_window(inputs: Inputs, cfg: ReportConfig) -> DataFrame:
    """Ledger lines whose period lies in [begin, end], both inclusive."""
    return inputs.ledger((cfg.begin, cfg.end))


# --- AEP lines (S2: F2, F4) --------------------------------------------------

def aep_lines(inputs: Inputs, cfg: ReportConfig) -> DataFrame:
    """Agent-equity lines booked to commission expense, up to the AEP cut-off.
    No aggregation; duplicates are kept."""
    lines = inputs.ledger((cfg.side_begin, cfg.aep_cutoff)).filter(
        (F.col("item_type_name") == F.lit(cfg.aep_item_type))
        & (F.col("account_number").cast("string") == F.lit(cfg.aep_account))
    )
    return lines.select(
        deal_key(lines).alias("deal_id"),
        "team_id",
        "ending_period",
        to_cents(F.col("amount")).alias("amount"),
        normalized_region(F.col("market_region"), F.col("location_name"), cfg.split_region).alias("market_region"),
        "location_name",
        "side_represented",
        "listing_type",
        "department_name",
    )


# --- flat-fee lines (S3: F3, F4) ---------------------------------------------

def fee_lines(inputs: Inputs, cfg: ReportConfig) -> DataFrame:
    """Flat-fee item lines up to the fee cut-off. No aggregation."""
    lines = inputs.ledger((cfg.side_begin, cfg.fee_cutoff)).filter(F.col("item_id").isin(list(cfg.fee_items)))
    return lines.select(
        deal_key(lines).alias("deal_id"),
        "team_id",
        "ending_period",
        to_cents(F.col("amount")).alias("amount"),
        normalized_region(F.col("market_region"), F.col("location_name"), cfg.split_region).alias("market_region"),
        "location_name",
        "side_represented",
        "listing_type",
        F.col("account_number").cast("string").alias("account_number"),
        "item_id",
        "item_name",
        "department_name",
    )


# --- principal roster (S4: F5, F6, P6) ---------------------------------------

# Roster columns in output order with the type a missing one gets.  Role and
# sales-manager name are two columns.
ROSTER_COLUMNS = {
    "agent_id": "string", "team_id": "string", "account_team_name": "string", "parent_account_name": "string",
    "agent_name": "string", "agent_role": "string", "sales_manager_name": "string", "market": "string",
    "sub_market": "string", "office": "string", "contact_status": "string", "original_start_date": "date",
    "number_of_agents": "int", "contract_start_date": "date", "contract_end_date": "date", "ica_expiration_date": "date",
    "separation_date": "date", "separated_flag": "string", "opportunity_gci": "decimal(18,2)",
    "total_split": "decimal(18,2)", "base_split": "decimal(18,2)", "resource_fee_type": "string",
    "resource_fee_option": "string", "resource_fee_pct": "decimal(18,2)", "resource_fee_cap": "decimal(18,2)",
    "actual_resource_fee": "decimal(18,2)", "policy_resource_fee": "decimal(18,2)", "ama_id": "string",
    "contact_id": "string", "account_id": "string",
}
ROSTER_REQUIRED = ("team_id", "account_team_name", "parent_account_name", "agent_role", "market",
                   "original_start_date", "primary_principal_flag")


def principal_roster(inputs: Inputs, cfg: ReportConfig) -> DataFrame:
    """Primary principals with a start date, outside the excluded parent
    accounts. A NULL parent account is excluded as well (three-valued NOT IN).
    All 30 columns come out; one the source lacks is a typed NULL."""
    roster = inputs.roster
    missing = [c for c in ROSTER_REQUIRED if c not in roster.columns]
    if missing:
        raise ValueError(f"roster lacks columns {missing}")
    kept = roster.filter(
        (F.col("agent_role") == F.lit(cfg.principal_role))
        & (F.col("primary_principal_flag") == F.lit(cfg.primary_flag))
        & F.col("original_start_date").isNotNull()
        & ~F.col("parent_account_name").isin(list(cfg.excluded_parents))
    )
    return kept.select([F.col(c) if c in roster.columns else F.lit(None).cast(t).alias(c) for c, t in ROSTER_COLUMNS.items()])


# --- extract bundle (S5) -----------------------------------------------------


class Extracts:
    """The four extracts (S5), each built on first use."""

    def __init__(self, inputs: Inputs, cfg: ReportConfig):
        self.inputs, self.cfg = inputs, cfg

    @cached_property
    def transactions(self) -> DataFrame:
        """Deal ledger (S1), money in exact long cents."""
        from ..operators.ledger import deal_ledger, deal_measures

        if self.inputs.account_sums is not None:
            return deal_measures(self.inputs.account_sums((self.cfg.begin, self.cfg.end)), self.cfg.chart)
        return deal_ledger(ledger_window(self.inputs, self.cfg), self.cfg)

    @cached_property
    def aep(self) -> DataFrame:
        return aep_lines(self.inputs, self.cfg)

    @cached_property
    def roster(self) -> DataFrame:
        return principal_roster(self.inputs, self.cfg)

    @cached_property
    def fees(self) -> DataFrame:
        return fee_lines(self.inputs, self.cfg)


def get_extracts(inputs: Inputs, cfg: ReportConfig) -> Extracts:
    return Extracts(inputs, cfg)

"""Chart of accounts that drives the per-deal measure columns.

Every account becomes one measure column ``acct_<number>``; four composite
measures sum sets of accounts.  Held as data so the aggregation is generated,
not written out 36 times; another company's chart comes from a table
(``chart_from_table``) or from the job's settings.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

# --- fixed values -----------------------------------------------------------
# Account numbers in the column order of the deal ledger output.
ACCOUNTS = (
    "400001", "400002", "400003", "400004", "400005", "400006", "400007", "400009",
    "401001", "410001", "411001", "430003", "502001", "502006", "503001", "510002",
    "510003", "510004", "510005", "510006", "400090", "400097", "400098", "400099",
    "401002", "401003", "401004", "430001", "430002", "430006", "430009", "430011",
)

# Gross commission income: 18 revenue accounts.
GCI_ACCOUNTS = (
    "400001", "400002", "400003", "400004", "400005", "400006", "400007", "400009",
    "400090", "400097", "400098", "400099", "401001", "401002", "401003", "401004",
    "410001", "411001",
)
REFERRAL_ACCOUNTS = ("510004", "510002", "510005")
COMMISSION_ACCOUNTS = ("502001", "510003", "510006")
AEP_ACCOUNTS = ("502006",)
# Account that carries flat fees in the ledger output.
FLAT_FEE_ACCOUNT = "430011"
# ---------------------------------------------------------------------------

COMPOSITES = (
    ("total_gci", GCI_ACCOUNTS),
    ("total_referral", REFERRAL_ACCOUNTS),
    ("commission_expense", COMMISSION_ACCOUNTS),
    ("aep", AEP_ACCOUNTS),
)


MOST_ACCOUNTS = 300  # each is a column of every deal row
_ACCOUNT = re.compile(r"[0-9][A-Za-z0-9_]*")


def account_column(account: str) -> str:
    return f"acct_{account}"


@dataclass(frozen=True)
class Chart:
    """The accounts with a measure column, in order; per composite measure the
    accounts it sums; the account that carries flat fees."""

    accounts: tuple[str, ...] = ACCOUNTS
    composites: tuple[tuple[str, tuple[str, ...]], ...] = COMPOSITES
    flat_fee_account: str = FLAT_FEE_ACCOUNT

    def __post_init__(self) -> None:
        if not self.accounts or len(self.accounts) > MOST_ACCOUNTS:
            raise ValueError(f"a chart has 1 to {MOST_ACCOUNTS} accounts, this one {len(self.accounts)}")
        if wrong := sorted({a for a in self.accounts if not _ACCOUNT.fullmatch(a)}):
            raise ValueError(f"account numbers of unsupported form: {wrong}")
        if len(set(self.accounts)) != len(self.accounts):
            raise ValueError("an account is in the chart twice")
        if sorted(n for n, _ in self.composites) != sorted(n for n, _ in COMPOSITES):
            raise ValueError(f"composites must be {sorted(n for n, _ in COMPOSITES)}")
        used = {a for _, accounts in self.composites for a in accounts} | {self.flat_fee_account}
        if outside := sorted(used - set(self.accounts)):
            raise ValueError(f"accounts used but not in the chart: {outside}")

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(account_column(a) for a in self.accounts)


DEFAULT_CHART = Chart()


def chart_from_table(table: DataFrame) -> Chart:
    """A chart from a table with one row per account: ``position`` (order of
    the columns), ``account``, ``measures`` (names of the composites that sum
    it) and ``flat_fee`` (true for one account).  At most ``MOST_ACCOUNTS``
    rows are fetched, one more fails."""
    rows = table.select("position", "account", "measures", "flat_fee").orderBy("position", "account").limit(MOST_ACCOUNTS + 1).collect()
    fees = [r["account"] for r in rows if r["flat_fee"]]
    if len(fees) != 1:
        raise ValueError(f"one account must carry flat fees, not {fees}")
    if unknown := sorted({m for r in rows for m in r["measures"] or ()} - {n for n, _ in COMPOSITES}):
        raise ValueError(f"unknown measures {unknown}")
    composites = tuple((n, tuple(r["account"] for r in rows if n in (r["measures"] or ()))) for n, _ in COMPOSITES)
    return Chart(tuple(r["account"] for r in rows), composites, fees[0])


def chart_from_mapping(values: dict) -> Chart:
    """A chart from plain values as JSON has them: ``accounts`` (list),
    ``composites`` (measure -> list of accounts), ``flat_fee_account``."""
    if unknown := sorted(set(values) ^ {"accounts", "composites", "flat_fee_account"}):
        raise ValueError(f"chart settings missing or unknown: {unknown}")
    composites = tuple((n, tuple(values["composites"].get(n, ()))) for n, _ in COMPOSITES)
    if unknown := sorted(set(values["composites"]) - {n for n, _ in COMPOSITES}):
        raise ValueError(f"unknown measures {unknown}")
    return Chart(tuple(values["accounts"]), composites, values["flat_fee_account"])


def column_for_account(account: str, columns: list[str] | tuple[str, ...]) -> str | None:
    """Measure column that an account number adjusts: the first column whose
    name contains the number, or None when the chart has no such column."""
    for name in columns:
        if account in name:
            return name
    return None

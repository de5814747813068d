"""Exact money arithmetic on the fast path: amounts as long cents.

Inputs carry money as ``decimal(18,2)``.  Inside the job every amount is its
unscaled value in cents, a primitive ``bigint`` (the input contract rejects
finer amounts): sums and differences are exact, stay in whole-stage codegen without per-value objects (decimal values
are materialised as objects in Spark's row format, about 30x slower here), and
overflow raises under ANSI mode instead of wrapping.  The written outputs
carry ``decimal(38,2)``; the registered queries carry ``cents / 100.0``, the
same double as casting the exact decimal, and ratios divide those doubles.

Money columns are those of the fixed lists (``MONEY_NAMES``, also with a
``_<year>`` suffix) and the account columns of the chart (``acct_<number>``);
every column of the job comes from such a list, so a source's own columns
cannot be taken for money.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


SOURCE_MONEY = "decimal(18,2)"

# --- fixed values -----------------------------------------------------------
# Names of the money measures that flow through the job (cents inside).
MONEY_NAMES = frozenset({
    "amount", "total_gci", "total_referral", "gci_less_referral", "commission_expense", "company_dollar", "aep",
    "company_dollar_plus_aep", "aep_adjusted", "net_company_dollar", "aep_total", "ncd_and_aep_total",
    "flat_fees_isolated", "market_gci_less_referral", "total_gci_at_position",
})
# ---------------------------------------------------------------------------

_YEAR_SUFFIX = re.compile(r"_\d{4}$")
_ACCOUNT_COLUMN = re.compile(r"acct_\d")


def is_money(name: str) -> bool:
    base = _YEAR_SUFFIX.sub("", name)
    return base in MONEY_NAMES or _ACCOUNT_COLUMN.match(name) is not None


def to_cents(value: Column) -> Column:
    """Exact unscaled cents of an amount with at most two decimals."""
    return (value.cast(SOURCE_MONEY) * F.lit(100)).cast("bigint")


def as_double(value_cents: Column) -> Column:
    """Cents as the double of the exact decimal amount (correctly rounded)."""
    return value_cents / F.lit(100.0)


def money_ratio(numerator_cents: Column, denominator_cents: Column) -> Column:
    """Ratio of two amounts as doubles; NULL on a zero denominator."""
    return F.try_divide(as_double(numerator_cents), as_double(denominator_cents))

"""Typed job configuration.

Everything the job needs to know besides its input tables lives in one frozen
``ReportConfig``: the period window, the AEP / flat-fee cut-offs and reset rule,
the split region, excluded parent accounts, the region -> market crosswalk, the
cohort bands and the report years.  Config-derived frames (crosswalk, bands) are
tiny by construction, which is what makes broadcasting them safe.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import MISSING, dataclass, fields, replace

from .functions.chart import DEFAULT_CHART, Chart, chart_from_mapping

D = dt.date

# Comparison operators allowed in a cohort bound (replaces evaluating config text).
COHORT_OPERATORS = ("<", "<=", ">", ">=", "==", "!=")


@dataclass(frozen=True)
class CohortBand:
    """A named set of principals selected by bounds on their start date.

    ``bounds`` empty means "all principals".  Several bounds are ANDed.
    """

    name: str
    bounds: tuple[tuple[str, dt.date], ...] = ()

    def __post_init__(self) -> None:
        for op, _ in self.bounds:
            if op not in COHORT_OPERATORS:
                raise ValueError(f"unsupported cohort operator {op!r}")


# --- fixed values -----------------------------------------------------------
# Cohort labels and bounds as the reporting convention defines them. The label of
# the all-principals band is what the positional share looks up.
TOTAL_COHORT = "Total Principal Cohorts"
DEFAULT_COHORTS = (
    CohortBand(TOTAL_COHORT),
    CohortBand("2018 and Prior", (("<", D(2019, 1, 1)),)),
    CohortBand("Jan 2019 to Aug 2019", ((">", D(2019, 1, 1)), ("<", D(2019, 9, 1)))),
    CohortBand("Sept 2019 to Aug 2020", ((">", D(2019, 9, 1)), ("<", D(2020, 9, 1)))),
)
# ---------------------------------------------------------------------------


# --- fixed values -----------------------------------------------------------
# Accounts, items and cut-off dates of the reporting convention.
RESET_AFTER, RESET_BEGIN = D(2020, 8, 31), D(2018, 1, 1)
AEP_CUTOFF, FEE_CUTOFF = D(2020, 8, 31), D(2020, 7, 31)
AEP_ITEM_TYPE, AEP_ACCOUNT = "AEP", "502001"
FEE_ITEMS = ("470", "469", "111", "86", "799")
PRINCIPAL_ROLE, PRIMARY_FLAG = "Principal", "Y"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ReportConfig:
    """What differs between companies (split region, excluded parents,
    crosswalk, report years) has no default; the reporting convention has."""

    begin: dt.date
    end: dt.date
    # Region whose ledger lines take their region from the first comma part of
    # the location name.
    split_region: str
    excluded_parents: tuple[str, ...]
    # (market_region, market) pairs that are in scope for the principal summary.
    crosswalk: tuple[tuple[str, str], ...]
    # Years the cohorts are compared over.
    report_years: tuple[int, ...]
    # AEP and flat-fee side extracts: a begin date after `reset_after` is replaced
    # by `reset_begin`; each extract ends at its own cut-off.
    reset_after: dt.date = RESET_AFTER
    reset_begin: dt.date = RESET_BEGIN
    aep_cutoff: dt.date = AEP_CUTOFF
    fee_cutoff: dt.date = FEE_CUTOFF
    aep_item_type: str = AEP_ITEM_TYPE
    aep_account: str = AEP_ACCOUNT
    fee_items: tuple[str, ...] = FEE_ITEMS
    principal_role: str = PRINCIPAL_ROLE
    primary_flag: str = PRIMARY_FLAG
    # Accounts with a measure column and the composites over them.
    chart: Chart = DEFAULT_CHART
    cohorts: tuple[CohortBand, ...] = DEFAULT_COHORTS
    total_cohort: str = TOTAL_COHORT
    # 'positional': share against the total-cohort row at the same position
    # (the established report); 'market_total': share of the market's total.
    share_mode: str = "positional"
    # A stored side (AEP totals, fee sums, roster) is broadcast only if its
    # rows, decoded, hold at most this many bytes; beyond it, shuffle joins.
    broadcast_max_bytes: int = 32 << 20
    # Most bytes of the key bitmap that filters the ledger keys of a shuffled merge.
    filter_max_bytes: int = 32 << 20

    def __post_init__(self) -> None:
        if self.begin > self.end:
            raise ValueError("begin after end")
        if self.share_mode not in ("positional", "market_total"):
            raise ValueError("share_mode must be 'positional' or 'market_total'")
        if not any(not b.bounds for b in self.cohorts if b.name == self.total_cohort):
            raise ValueError("the total cohort must be one of the bands and select all")
        if not self.crosswalk:
            raise ValueError("the crosswalk is empty: no principal would be in scope")
        if not self.report_years or not set(self.report_years) <= set(self.pivot_years):
            raise ValueError(f"report years must lie in the windows' years {self.pivot_years}")

    @property
    def side_begin(self) -> dt.date:
        """Begin date of the AEP and fee extracts (reset rule)."""
        return self.reset_begin if self.begin > self.reset_after else self.begin

    @property
    def whole_window(self) -> tuple[dt.date, dt.date]:
        """From the first to the last period that any extract reads."""
        return min(self.begin, self.side_begin), max(self.end, self.aep_cutoff, self.fee_cutoff)

    @property
    def pivot_years(self) -> tuple[int, ...]:
        """Every year a deal row can have: the ledger window and the AEP window
        (an AEP total without a deal keeps its own period)."""
        first = min(self.begin, self.side_begin).year
        return tuple(range(first, max(self.end, self.aep_cutoff).year + 1))

    def with_window(self, begin: dt.date, end: dt.date) -> "ReportConfig":
        return replace(self, begin=begin, end=end)


def crosswalk_pairs(mapping: dict[str, str | list[str]]) -> tuple[tuple[str, str], ...]:
    """Flatten a region -> market(s) mapping into (region, market) pairs."""
    pairs: list[tuple[str, str]] = []
    for region, markets in mapping.items():
        for market in [markets] if isinstance(markets, str) else markets:
            pairs.append((region, market))
    return tuple(pairs)


def from_mapping(values: dict) -> ReportConfig:
    """Config from plain values as JSON has them: ISO dates, ``crosswalk`` as
    region -> market or markets, ``cohorts`` as name -> list of [operator,
    date], ``chart`` as ``chart_from_mapping`` takes it.  Unknown names fail."""
    known = {f.name: f for f in fields(ReportConfig)}
    if unknown := sorted(set(values) - set(known)):
        raise ValueError(f"unknown settings {unknown}")
    if lacking := sorted(n for n, f in known.items() if f.default is MISSING and n not in values):
        raise ValueError(f"settings {lacking} are required")
    out = dict(values)
    for name in ("begin", "end", "reset_after", "reset_begin", "aep_cutoff", "fee_cutoff"):
        if isinstance(out.get(name), str):
            out[name] = dt.date.fromisoformat(out[name])
    for name in ("excluded_parents", "report_years", "fee_items"):
        if name in out:
            out[name] = tuple(out[name])
    out["crosswalk"] = crosswalk_pairs(out["crosswalk"])
    if "chart" in out:
        out["chart"] = chart_from_mapping(out["chart"])
    if "cohorts" in out:
        out["cohorts"] = tuple(CohortBand(n, tuple((op, dt.date.fromisoformat(d)) for op, d in bounds)) for n, bounds in out["cohorts"].items())
    return ReportConfig(**out)

"""Pipeline parameters: every literal of the reference (year range, history
cut, report filter, thresholds) is an argument here."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


def _d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@dataclass(frozen=True)
class Config:
    # calendar and silver checks
    calendar_start: dt.date = _d("2023-01-01")
    calendar_end: dt.date = _d("2024-12-31")
    ledger_min_date: dt.date = _d("1991-01-01")      # exclusive lower bound of entry dates
    load_date: dt.date = _d("2024-12-31")            # "not in the future" bound of the checks
    budget_min_year: int = 2000
    # gold
    history_cut: dt.date = _d("2024-11-01")          # benchmark uses days strictly before it
    report_cost_centre: str = "Financeiro"
    report_start: dt.date = _d("2024-11-01")
    report_end: dt.date = _d("2024-11-20")
    report_status: str = "Pago"
    # measures
    as_of: dt.date = _d("2024-11-20")
    linear_weight: float = 0.3                       # closing projection: 30 % linear,
    historical_weight: float = 0.7                   # 70 % historical
    risk_amber: float = 0.8                          # risk light: >= 80 % of budget
    pace_tolerance: float = 0.10                     # pace status band (our choice)
    top_k: int = 5
    extras: dict = field(default_factory=dict)

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


# Parameters for the driver's test data (orders 1995-01-01 .. 2001-08-01).
TESTDATA = Config(
    calendar_start=_d("1995-01-01"),
    calendar_end=_d("2001-12-31"),
    load_date=_d("2001-12-31"),
    budget_min_year=1995,
    history_cut=_d("2001-06-01"),
    report_cost_centre="Nation_2",
    report_start=_d("2001-06-01"),
    report_end=_d("2001-06-20"),
    as_of=_d("2001-07-20"),
)

"""Run parameters of the sales-day forecast (operator K19).

Every date and rate the forecast depends on is a field here, so a run is
reproducible and back-testable: nothing reads the wall clock.  The values
are bound into plans as literals, which Catalyst folds.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

FORECAST = "forecast"
BACKTEST = "backtest"
SCOPES = (FORECAST, BACKTEST)


@dataclasses.dataclass(frozen=True)
class ForecastParams:
    # Cut-off: actuals of a month are known from this date on (replaces "today").
    as_of: dt.date

    # Fixed values of the original business rules:
    # actuals of month m are complete on day 16 of month m+1; opening, closing
    # and reinvestment projects are known 12 months ahead; annualised
    # inflation 1.01 (live forecast) or 1.05222 (backtest); long-run
    # inflation 1.025; horizon 120 months; near-term rate from 2025-05-01;
    # glide path anchored at 2026-01-01; price change on 2024-07-01, next
    # increase 5 months later, known 90 days in advance; inflation factors
    # above 10 are suspicious.
    reported_day: int = 16
    opening_vision_months: int = 12
    closing_vision_months: int = 12
    reinvestment_vision_months: int = 12
    annual_inflation_forecast: float = 1.01
    annual_inflation_backtest: float = 1.05222
    long_run_inflation: float = 1.025
    months_predict: int = 120
    near_term_start: dt.date = dt.date(2025, 5, 1)
    glide_anchor: dt.date = dt.date(2026, 1, 1)
    price_change: dt.date | None = dt.date(2024, 7, 1)
    months_before_next_increase: int = 5
    price_change_notice_days: int = 90
    inflation_factor_max: float = 10.0

    # Behaviour switches (defaults follow the original business logic).
    closing_vision: bool = True          # False: any known close limits the horizon
    # Horizon months whose layout no month of the history has: "drop" them, stop with an
    # "error", or "synthesise" them from a month that is as long and has as many Sundays.
    calendar_gap: str = "drop"
    # The calendar is learnt from months known at "as_of", for all forecast dates, or at each
    # "forecast_date", so that a backtest sees no later month.
    calendar_version: str = "as_of"
    leap_weekdays: tuple[str, ...] = ("Wednesday",)  # leap calendars synthesised from donors
    round_factors: bool = False          # True: gocf to 15, reinvestment factor to 2 digits

    # Tables of one row per forecast date, or per reported month and concept, are broadcast up to
    # this many rows (counted in the run, which stops beyond them); 0 joins them by a salted shuffle.
    broadcast_rows: int = 10_000

    def __post_init__(self) -> None:
        for name, known in (("calendar_gap", ("drop", "error", "synthesise")), ("calendar_version", ("as_of", "forecast_date"))):
            if getattr(self, name) not in known:
                raise ValueError(f"{name} must be one of {known}, not {getattr(self, name)!r}")
        if self.reported_day < 1 or self.reported_day > 28:
            raise ValueError("reported_day must be within 1..28")

    def annual_inflation(self, scope: str) -> float:
        if scope not in SCOPES:
            raise ValueError(f"scope must be one of {SCOPES}, not {scope!r}")
        return self.annual_inflation_forecast if scope == FORECAST else self.annual_inflation_backtest

    def replace(self, **changes) -> "ForecastParams":
        return dataclasses.replace(self, **changes)

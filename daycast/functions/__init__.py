"""Column-level building blocks (scalar functions J1-J20)."""

from daycast.functions.dates import (
    CALENDAR_KEYS,
    WEEKDAY_NAMES,
    add_months_floor,
    calendar_key,
    is_leap_year,
    known_actuals,
    lit_date,
    month_floor,
    months_between_exact,
    reported_month,
    sales_days_between,
    sales_days_in_month,
    weekday_name,
    year_floor,
)
from daycast.functions.numeric import AGE_BREAKS, AGE_LABELS, age_group, age_years, clamp, monthly_rate

__all__ = [
    "AGE_BREAKS",
    "AGE_LABELS",
    "CALENDAR_KEYS",
    "WEEKDAY_NAMES",
    "add_months_floor",
    "age_group",
    "age_years",
    "calendar_key",
    "clamp",
    "is_leap_year",
    "known_actuals",
    "lit_date",
    "month_floor",
    "monthly_rate",
    "months_between_exact",
    "reported_month",
    "sales_days_between",
    "sales_days_in_month",
    "weekday_name",
    "year_floor",
]

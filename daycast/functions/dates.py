"""Date expressions (J1-J10, B11).  Column in, Column out; all JVM-side.

Every function here is a plain Catalyst expression, so it stays inside
whole-stage codegen.  In particular the sales-day count is a closed form
instead of building an array of dates per row.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Weekday names in the order of Spark's dayofweek (1 = Sunday).
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

CALENDAR_KEYS = ("jan1_day", "month_num", "leap_year")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _names(*cs: ColumnOrName) -> bool:
    """True when every argument is a plain column name: the expression can then be
    sent as one SQL string (one call to the JVM instead of one per sub-expression)."""
    return all(isinstance(c, str) and _IDENT.match(c) for c in cs)


_WEEKDAYS_SQL = "array(" + ", ".join(f"'{n}'" for n in ("Sunday", "Monday", "Tuesday", "Wednesday",
                                                       "Thursday", "Friday", "Saturday")) + ")"


def lit_date(d: dt.date | str) -> Column:
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def month_floor(c: ColumnOrName) -> Column:
    """First day of the month."""
    return F.trunc(_c(c), "month")


def year_floor(c: ColumnOrName) -> Column:
    """First day of the year."""
    return F.trunc(_c(c), "year")


def weekday_name(c: ColumnOrName) -> Column:
    """Full English weekday name, locale independent."""
    if _names(c):
        return F.expr(f"element_at({_WEEKDAYS_SQL}, dayofweek({c}))")
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), F.dayofweek(_c(c)))


def is_leap_year(c: ColumnOrName) -> Column:
    """Gregorian leap-year test of the year of a date."""
    if _names(c):
        return F.expr(f"(year({c}) % 4 = 0) AND ((year({c}) % 100 <> 0) OR (year({c}) % 400 = 0))")
    y = F.year(_c(c))
    return ((y % 4) == 0) & (((y % 100) != 0) | ((y % 400) == 0))


def months_between_exact(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole calendar months from start to end, days ignored."""
    if _names(start, end):
        return F.expr(f"CAST((year({end}) - year({start})) * 12 + (month({end}) - month({start})) AS INT)")
    s, e = _c(start), _c(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("int")


def sales_days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of non-Sundays in [start, end], both inclusive.

    Closed form: days in the range minus the Sundays in it.  Day 0 of the
    Unix calendar (1970-01-01) is a Thursday, so day u is a Sunday exactly
    when (u + 4) is a multiple of 7; floor division counts them on either
    side of 1970.  Null in, null out.  For start > end the value is
    meaningless; callers check that pairs are ordered (L2).
    """
    if _names(start, end):
        a, b = start, end
        return F.expr(f"CAST(datediff({b}, {a}) + 1 - (FLOOR((unix_date({b}) + 4) / 7) "
                      f"- FLOOR((unix_date({a}) + 3) / 7)) AS INT)")
    s, e = _c(start), _c(end)
    us, ue = F.unix_date(s), F.unix_date(e)
    sundays = F.floor((ue + 4) / 7) - F.floor((us + 3) / 7)
    return (F.datediff(e, s) + 1 - sundays).cast("int")


def sales_days_in_month(month: ColumnOrName) -> Column:
    """Non-Sundays of the month containing `month`."""
    m = month_floor(month)
    return sales_days_between(m, F.last_day(m))


def calendar_key(month: ColumnOrName) -> list[Column]:
    """The (weekday of 1 January, month number, leap year) key of a month.

    Months with equal keys have the same weekday layout, so they share one
    calendar entry.
    """
    if _names(month):
        m = month
        return [
            F.expr(f"element_at({_WEEKDAYS_SQL}, dayofweek(trunc({m}, 'year')))").alias("jan1_day"),
            F.expr(f"month({m})").alias("month_num"),
            is_leap_year(m).alias("leap_year"),
        ]
    m = _c(month)
    return [
        weekday_name(year_floor(m)).alias("jan1_day"),
        F.month(m).alias("month_num"),
        is_leap_year(m).alias("leap_year"),
    ]


def last_day_of(c: ColumnOrName) -> Column:
    """Last day of the month."""
    return F.last_day(_c(c))


def add_months_floor(month: ColumnOrName, n: ColumnOrName | int) -> Column:
    """Month arithmetic; `n` may be a column."""
    k = F.lit(n) if isinstance(n, int) else _c(n)
    return F.add_months(_c(month), k)


def known_actuals(month: ColumnOrName, as_of: dt.date, reported_day: int) -> Column:
    """Actuals of `month` are complete on day `reported_day` of the next month.

    The exact test is `add_months(month, 1) + (reported_day - 1) days <= as_of`;
    the implied bound `month <= as_of` is added so the scan can prune row
    groups (the exact test is a function of the column and cannot be pushed).
    """
    m = _c(month)
    exact = F.date_add(F.add_months(m, 1), reported_day - 1) <= lit_date(as_of)
    return (m <= lit_date(as_of)) & exact


def reported_month(date_forecast: ColumnOrName, reported_day: int) -> Column:
    """Last month whose actuals were known on the forecast date."""
    d = _c(date_forecast)
    return F.add_months(month_floor(F.date_sub(d, reported_day - 1)), -1)

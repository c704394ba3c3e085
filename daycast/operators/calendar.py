"""Calendar of selling days learnt from history (K1, K2).

The calendar maps a month's weekday layout (weekday of 1 January, month
number, leap year) to the typical number of selling days, taken from the
most recent month with that layout.  It has at most 7 x 12 x 2 = 168 rows
whatever the size of the history, which is what makes broadcasting it
safe.

Two further ways to read it: `calendar_gap="synthesise"` lets every month
also offer itself to all layouts that are as long and hold as many Sundays
(the same selling days, whatever the month's name; those that begin on the
same weekday are preferred); and
`calendar_version="forecast_date"` looks a month up among the offers known
at its forecast date (`days_at_forecast_date`), so that a backtest with
several dates never sees a later month.

Plan of the calendar: two aggregates, no join.
1. The exact median of `days` per month over the known history (scan
   pruned to `month`, `days`; the as-of bound is pushed into the scan).
   Spark's median keeps a value->count map as its partial buffer (at most
   31 distinct day counts), so it combines map-side and a month or
   location holding most rows cannot skew it.  Output: one row per month.
2. Per layout, the median of the latest month (E11).  Each month is also
   offered, at lower priority, as the donor of a synthesised leap layout
   (K2), which therefore only fills layouts the history lacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.functions.dates import _WEEKDAYS_SQL, CALENDAR_KEYS, WEEKDAY_NAMES, calendar_key, known_actuals
from daycast.params import ForecastParams

MAX_CALENDAR_ROWS = 7 * 12 * 2


def monthly_medians(monthly_sales: DataFrame, params: ForecastParams) -> DataFrame:
    """F2 per month: exact median of the known day counts, truncated to int."""
    known = monthly_sales.select("month", "days").where(known_actuals("month", params.as_of, params.reported_day))
    return known.groupBy("month").agg(F.median("days").cast("int").alias("days_max"))


def _candidate(jan1: F.Column, leap: F.Column, priority: int, extra: F.Column) -> F.Column:
    return F.struct(jan1.alias("jan1_day"), F.col("month_num"), leap.alias("leap_year"),
                    F.lit(priority).alias("priority"), extra.alias("extra"))


def leap_donor(weekdays: tuple[str, ...]) -> F.Column:
    """K2: for a common-year month that can stand in for a leap layout, that
    candidate; else null.

    A leap year starting on weekday W has the January-February layout of a
    common year starting on W (plus 29 February) and the March-December
    layout of a common year starting on W + 1.  29 February falls on W + 3;
    it adds a selling day unless that is a Sunday.
    """
    idx = {n: i for i, n in enumerate(WEEKDAY_NAMES)}
    jan1, mnum = F.col("jan1_day"), F.col("month_num")
    out = None
    for w in weekdays:
        nxt = WEEKDAY_NAMES[(idx[w] + 1) % 7]
        feb29 = 0 if WEEKDAY_NAMES[(idx[w] + 3) % 7] == "Sunday" else 1
        early = (mnum <= 2) & (jan1 == w)
        late = (mnum > 2) & (jan1 == nxt)
        extra = F.when(mnum == 2, F.lit(feb29)).otherwise(F.lit(0))
        cand = _candidate(F.lit(w), F.lit(True), 1, extra)
        cond = ~F.col("leap_year") & (early | late)
        out = F.when(cond, cand) if out is None else out.when(cond, cand)
    return out


# The length of each month of a common year.
MONTH_LENGTHS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)


def equal_layouts() -> Column:
    """Every layout with the selling days of the row's month, as candidates: as long, and with as many Sundays.

    Of the 168 layouts those that also begin on the same weekday come first:
    with the row's own month number (the other kind of year, priority 2),
    then with another (3); the rest after them (4).
    """
    lengths = "array(" + ", ".join(map(str, MONTH_LENGTHS)) + ")"
    before = "array(" + ", ".join(str(sum(MONTH_LENGTHS[:m])) for m in range(12)) + ")"
    number = "cast(k % 24 div 2 + 1 as int)"
    layouts = f"""transform(sequence(0, {MAX_CALENDAR_ROWS - 1}), k -> named_struct(
        'jan1_day', element_at({_WEEKDAYS_SQL}, cast(k div 24 + 1 as int)), 'month_num', {number}, 'leap_year', k % 2 = 1,
        'first', cast((k div 24 + element_at({before}, {number}) + if(k % 24 >= 4, k % 2, 0)) % 7 + 1 as int),
        'length', cast(element_at({lengths}, {number}) + if(k % 24 div 2 = 1, k % 2, 0) as int)))"""

    def sundays(first: str, length: str) -> str:
        return f"(({length} - 1 - (8 - {first}) % 7) div 7)"      # less one

    same = (f"filter({layouts}, x -> x.length = day(last_day(month)) and "
            f"{sundays('x.first', 'x.length')} = {sundays('dayofweek(month)', 'day(last_day(month))')})")
    return F.expr(f"""transform({same}, x -> named_struct('jan1_day', x.jan1_day, 'month_num', x.month_num, 'leap_year', x.leap_year,
        'priority', case when x.first <> dayofweek(month) then 4 when x.month_num = month(month) then 2 else 3 end, 'extra', 0))""")


def offers(monthly_sales: DataFrame, params: ForecastParams) -> DataFrame:
    """The layouts that each known month can stand for: (jan1_day, month_num, leap_year, priority, extra, year_ref, days_max).

    Lowest priority first: a month's own layout, a leap year's (K2), then
    with `calendar_gap="synthesise"` any that has the same selling days.  At
    most 60 rows per month of the history.
    """
    per_month = monthly_medians(monthly_sales, params).select("month", "days_max", *calendar_key("month"))
    own = _candidate(F.col("jan1_day"), F.col("leap_year"), 0, F.lit(0))
    synthesise = params.calendar_gap == "synthesise"
    weekdays = WEEKDAY_NAMES if synthesise else params.leap_weekdays
    cands = F.array(own, leap_donor(weekdays)) if weekdays else F.array(own)
    if synthesise:
        cands = F.concat(cands, equal_layouts())
    return (per_month.select(F.col("month").alias("year_ref"), "days_max", F.explode(cands).alias("c"))
            .where(F.col("c").isNotNull())
            .select("c.jan1_day", "c.month_num", "c.leap_year", "c.priority", "c.extra", "year_ref", "days_max"))


def _pick() -> Column:
    """Among offers of one layout: the lowest priority (its own first), then the latest month."""
    return F.max_by(F.struct("year_ref", (F.col("days_max") + F.col("extra")).cast("int").alias("days_max")),
                    F.struct((-F.col("priority")).alias("p"), F.col("year_ref").alias("m")))


def day_details(monthly_sales: DataFrame, params: ForecastParams) -> DataFrame:
    """K1: the calendar lookup `(jan1_day, month_num, leap_year, year_ref, days_max)`."""
    return (offers(monthly_sales, params).groupBy(*CALENDAR_KEYS).agg(_pick().alias("v"))
            .select(*CALENDAR_KEYS, "v.year_ref", "v.days_max"))


def known_from(month: Column, params: ForecastParams) -> Column:
    """The day on which a month's actuals are complete."""
    return F.date_add(F.add_months(month, 1), params.reported_day - 1)


def days_at_forecast_date(months: DataFrame, monthly_sales: DataFrame, params: ForecastParams) -> DataFrame:
    """E1 by version: `days_max` of (date_forecast, month) rows from the months known at each forecast date.

    Months whose layout nobody had offered by then are dropped.  The offers
    are broadcast: 60 at most per month of the history.  With rows
    partitioned by forecast date the aggregate needs no exchange.
    """
    keyed = months.select("date_forecast", "month", *calendar_key("month"))
    known = keyed.join(F.broadcast(offers(monthly_sales, params)), list(CALENDAR_KEYS)).where(
        known_from(F.col("year_ref"), params) <= F.col("date_forecast"))
    return known.groupBy("date_forecast", "month").agg(_pick().alias("v")).select("date_forecast", "month", "v.days_max")


def observed_calendar(monthly_sales: DataFrame, params: ForecastParams) -> DataFrame:
    """K1 without synthesised layouts."""
    return day_details(monthly_sales, params.replace(leap_weekdays=(), calendar_gap="drop"))


def synthesised_rows(monthly_sales: DataFrame, params: ForecastParams) -> DataFrame:
    """K2 alone: the calendar rows that come from leap donors."""
    full = day_details(monthly_sales, params)
    return full.join(observed_calendar(monthly_sales, params).select(*CALENDAR_KEYS),
                     list(CALENDAR_KEYS), "left_anti")

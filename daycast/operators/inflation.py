"""Price inflation attached to each forecast month.

Physical plan, chosen for scale:

* The base inflation (E6) is looked up once per location row, before the
  horizon is exploded: a join of the location table with the history on
  (loc_num, reported_month), reusing the history's (loc_num, month)
  partitioning.
* Missing base factors are filled with the mean over the *expanded* rows
  of their (reported_month, concept_code) group (F10).  A location row
  counts once per open month, so the mean is one weighted aggregate of
  location rows with map-side combine; nothing is expanded for it.  The few
  means are counted and broadcast (`joins.join_small`), so no location row moves.
* The growth path (K12) is a function of (date_forecast, month) only.  It
  is computed on the distinct pairs (at most months_predict + 1 per
  forecast date), compounded with a running `product` window per forecast
  date, and folded into the array of the date's covered months (bounded by
  the horizon length), which is joined to the location rows before the explode.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daycast.functions.dates import lit_date, months_between_exact
from daycast.functions.numeric import clamp, monthly_rate
from daycast.operators.horizon import with_places
from daycast.operators.joins import join_small
from daycast.params import ForecastParams

def attach_reported_inflation(locations: DataFrame, monthly_sales: DataFrame) -> DataFrame:
    """K10 + E6: the ending inflation factor of the reported month, per location row."""
    infl = monthly_sales.select("loc_num", F.col("month").alias("reported_month"),
                          F.col("inflation_factor_ending").alias("inflation_factor"))
    return locations.join(infl, ["loc_num", "reported_month"], "left")


def inflation_means(locations: DataFrame) -> DataFrame:
    """mean of the known factors over the *expanded* rows of each
    (reported_month, concept_code), from location rows weighted by the
    number of their open months, `n_open`.  Partial before its shuffle."""
    weight = F.col("n_open")
    known = locations.where(F.col("inflation_factor").isNotNull() & (weight > 0))
    return (known.groupBy("reported_month", "concept_code")
            .agg((F.sum(F.col("inflation_factor") * weight) / F.sum(weight)).alias("inflation_mean")))


def fill_inflation(locations: DataFrame, means: DataFrame, params: ForecastParams) -> DataFrame:
    """A missing base factor becomes its group mean."""
    return (join_small(locations, means, ["reported_month", "concept_code"], params)
            .withColumn("inflation_factor", F.coalesce(F.col("inflation_factor"), F.col("inflation_mean")))
            .drop("inflation_mean"))


def monthly_inflation(params: ForecastParams, scope: str) -> Column:
    """K12 per month: the month's growth factor on the glide path.

    Before `near_term_start` prices are flat (rate 1); from then on the
    annual rate starts at the scope's near-term value and moves linearly,
    by (begin - end) / 12 per month, towards the long-run rate reached at
    `glide_anchor`; the rate is clamped to [begin, end] (if begin > end it
    is end).  The month before the forecast month (months_out = 0) does
    not grow.
    """
    month, df = F.col("month"), F.col("date_forecast")
    months_out = months_between_exact(df, month) + 1
    begin = F.when(month < lit_date(params.near_term_start), F.lit(1.0)) \
        .otherwise(F.lit(params.annual_inflation(scope)))
    end = F.lit(params.long_run_inflation)
    slope = (begin - end) / 12
    anchor = months_between_exact(df, lit_date(params.glide_anchor))
    rate = clamp(begin + slope * (anchor - months_out), begin, end)
    return F.when(months_out == 0, F.lit(1.0)).otherwise(monthly_rate(rate))


def inflation_path(pairs: DataFrame, params: ForecastParams, scope: str) -> DataFrame:
    """K12 + G6: cumulative growth `incremental_time_inflation` per (date_forecast, month).

    `pairs` holds the (date_forecast, month) pairs present in the horizon;
    months missing there (calendar gaps) do not compound, as in the
    original.  The window is partitioned by forecast date and holds at most
    months_predict + 1 rows per partition.
    """
    by_date = (Window.partitionBy("date_forecast").orderBy("month")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (pairs.select("date_forecast", "month").distinct()
            .withColumn("incremental_time_inflation", F.product(monthly_inflation(params, scope)).over(by_date)))


def path_and_months(pairs: DataFrame, params: ForecastParams, scope: str) -> DataFrame:
    """K12 and E1 by forecast date: one row each with `months`, the covered (month, days_max, growth)
    in order, and `shift_n` (K14).

    `pairs` are distinct (date_forecast, month, days_max) rows.  The array
    has at most months_predict + 1 entries; window and aggregate share the
    exchange by forecast date.
    """
    by_date = (Window.partitionBy("date_forecast").orderBy("month")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    grown = pairs.withColumn("growth", F.product(monthly_inflation(params, scope)).over(by_date))
    rows = grown.groupBy("date_forecast").agg(F.sort_array(F.collect_list(F.struct("month", "days_max", "growth"))).alias("months"))
    return with_places(rows.withColumn("shift_n", shift_months(F.element_at("months", 1)["month"], params)))


def shift_months(first_month: Column, params: ForecastParams) -> Column:
    """K14 offset: n = max(0, whole months from the earliest forecast month of
    the run to price_change + months_before_next_increase); 0 when there is no price change.

    `first_month` is the first month of a row per forecast date; the
    earliest one is a window over these few rows.
    """
    if params.price_change is None:
        return F.lit(0)
    target = F.add_months(lit_date(params.price_change), params.months_before_next_increase)
    earliest = F.min(first_month).over(Window.partitionBy())
    return F.greatest(F.lit(0), F.coalesce(months_between_exact(earliest, target), F.lit(0)))


def growth_at(month: Column, i: Column) -> Column:
    """E7 + K14/G8 inside the generator: the growth of the open month `shift_n`
    places earlier (the month's own when 0), or 1 for the first `shift_n` months."""
    return (F.when(i < F.col("shift_n"), F.lit(1.0))
            .otherwise(F.get(F.col("open_months"), i - F.col("shift_n"))["growth"]))


def _py_sales_days(a: dt.date, b: dt.date) -> int:
    days = (b - a).days + 1
    return sum(1 for i in range(days) if (a + dt.timedelta(i)).isoweekday() != 7)


def _month_end(d: dt.date) -> dt.date:
    nxt = dt.date(d.year + (d.month // 12), d.month % 12 + 1, 1)
    return nxt - dt.timedelta(days=1)


def price_change_window(params: ForecastParams) -> tuple[dt.date, dt.date]:
    """Forecast dates [known, realized) for which the overlay applies."""
    change = params.price_change
    change_month = change.replace(day=1)
    known = change - dt.timedelta(days=params.price_change_notice_days)
    nxt = dt.date(change_month.year + (change_month.month // 12), change_month.month % 12 + 1, 1)
    realized = nxt + dt.timedelta(days=params.reported_day - 1)
    return known, realized


def price_change_uplift(params: ForecastParams) -> Column:
    """K15 per row: 1 + the part of the group's price increase `inc` already
    effective in the month, for forecast dates inside the announcement
    window; 1 elsewhere or when the group has no increase.

    Months after the change get the whole increase, the change month the
    share of its selling days from the change day on, earlier months none.
    """
    if params.price_change is None:
        return F.lit(1.0)
    change = params.price_change
    change_month = change.replace(day=1)
    share = _py_sales_days(change, _month_end(change)) / _py_sales_days(change_month, _month_end(change))
    known, realized = price_change_window(params)
    month, df, inc = F.col("month"), F.col("date_forecast"), F.col("inc")
    inc_m = (F.when(inc.isNull(), F.lit(None))
             .when(month > lit_date(change), inc)
             .when(month == lit_date(change_month), inc * F.lit(share))
             .otherwise(F.lit(0.0)))
    inc_m = F.when(df >= lit_date(realized), F.lit(0.0)).otherwise(inc_m)
    in_window = (df >= lit_date(known)) & (df < lit_date(realized))
    return F.when(in_window & inc_m.isNotNull(), F.lit(1.0) + inc_m).otherwise(F.lit(1.0))


def attach_price_increases(locations: DataFrame, increases: DataFrame | None) -> DataFrame:
    """K15 input: the increase of the location's price group (null if none)."""
    if increases is None:
        return locations.withColumn("inc", F.lit(None).cast("double"))
    return locations.join(increases.select("price_group", "inc"), ["price_group"], "left")

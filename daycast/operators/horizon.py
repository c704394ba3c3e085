"""Forecast horizon: one row per location, forecast date and future month
(B6, B7, C2, D1, E1, F4, K3, K18).

Everything that depends only on the location row (start offset, opening
and closing months, reported month, days lost to opening and closing) is
computed *before* the explode, once per location row instead of once per
month.  The explode then generates only the months that pass the
opening/closing filter: the offset range is intersected with the open
interval up front, so no row is generated just to be filtered out.

What depends on the forecast date alone (covered months and their selling
days, growth path) is computed on a table of one row per forecast date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.functions.dates import (
    CALENDAR_KEYS,
    calendar_key,
    month_floor,
    months_between_exact,
    reported_month,
    sales_days_between,
)
from daycast.operators.calendar import days_at_forecast_date
from daycast.operators.joins import join_small
from daycast.params import ForecastParams
from daycast.sources.schemas import FAR_FUTURE


def start_offset(params: ForecastParams) -> Column:
    """A forecast made before the reporting day also covers the previous month."""
    return F.when(F.dayofmonth("date_forecast") < params.reported_day, F.lit(-1)).otherwise(F.lit(0))


def closing_month(params: ForecastParams) -> Column:
    """Month of closing, if the closing limits the horizon; else FAR_FUTURE.

    With `closing_vision` a closing is only known `closing_vision_months`
    ahead of the forecast date; a later one does not limit the horizon.
    A missing close date means the location never closes.
    """
    close = F.coalesce(F.col("close_date"), F.lit(FAR_FUTURE))
    if not params.closing_vision:
        return month_floor(close)
    known = F.add_months(F.col("date_forecast"), params.closing_vision_months) > close
    return F.when(known, month_floor(close)).otherwise(F.lit(FAR_FUTURE))


def prepare_locations(sales_days_future: DataFrame, params: ForecastParams) -> DataFrame:
    """Per-location-row attributes used by every later step (row-local, no shuffle).

    K5 is row-local here: the days of the opening month before the opening
    day, and of the closing month from the closing day on, come from the
    row's own dates; the original table-and-join form fanned out when a
    location had several forecast dates.
    """
    close = F.coalesce(F.col("close_date"), F.lit(FAR_FUTURE))
    mp = F.col("months_predict") if "months_predict" in sales_days_future.columns else F.lit(None)
    base = sales_days_future.select(
        "loc_num",
        "date_forecast",
        "open_date",
        close.alias("close_date"),
        "location_type_code",
        F.col("location_type_code").alias("concept_code"),
        (F.col("price_group") if "price_group" in sales_days_future.columns
         else F.lit(None).cast("string")).alias("price_group"),
        F.coalesce(mp.cast("int"), F.lit(params.months_predict)).alias("months_predict"),
        start_offset(params).alias("month_start"),
        month_floor("open_date").alias("month_open"),
        closing_month(params).alias("month_close"),
        reported_month("date_forecast", params.reported_day).alias("reported_month"),
        F.last_day(close).alias("_close_month_end"),
    )
    # second projection on named columns (collapsed into one by the optimizer)
    return base.select(
        *[c for c in base.columns if c != "_close_month_end"],
        F.coalesce(sales_days_between("month_open", "open_date"), F.lit(0)).alias("days_before_open"),
        F.coalesce(sales_days_between("close_date", "_close_month_end"), F.lit(0)).alias("days_after_close"),
    )


def offset_range() -> tuple[Column, Column, Column]:
    """D1 + C2: first and last month offset within the open months, and whether there is one.

    The offset range `month_start .. months_predict-1` counts down when
    months_predict-1 < month_start, as `sequence` does; as a set it is the
    same interval, which is then intersected with [opening month, closing
    month].
    """
    base = month_floor("date_forecast")
    a, b = F.col("month_start"), F.col("months_predict") - 1
    open_off = months_between_exact(base, "month_open")
    close_off = months_between_exact(base, "month_close")
    lo = F.greatest(F.least(a, b), open_off)
    hi = F.least(F.greatest(a, b), close_off)
    return lo, hi, open_off.isNotNull() & close_off.isNotNull() & (lo <= hi)


def horizon_offsets() -> Column:
    """D1 + C2: the month offsets of the row's open horizon."""
    lo, hi, ok = offset_range()
    return F.when(ok, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def horizon_months(locations: DataFrame) -> DataFrame:
    """the distinct (date_forecast, month) pairs of the horizon, whether the calendar covers them or not.

    The months of a forecast date are a union of offset ranges.  Locations
    are folded to their distinct ranges before the only exchange (by
    forecast date), so it grows with dates and horizon length, not with
    locations.
    """
    lo, hi, ok = offset_range()
    ranges = (locations.where(ok).groupBy("date_forecast")
              .agg(F.collect_set(F.struct(lo.alias("lo"), hi.alias("hi"))).alias("ranges")))
    offsets = F.array_distinct(F.flatten(F.transform("ranges", lambda r: F.sequence(r["lo"], r["hi"]))))
    return (ranges.select("date_forecast", F.explode(offsets).alias("_k"))
            .select("date_forecast", F.add_months(month_floor("date_forecast"), F.col("_k")).alias("month")))


def covered_months(locations: DataFrame, monthly_sales: DataFrame, calendar: DataFrame, params: ForecastParams) -> DataFrame:
    """The horizon's (date_forecast, month) pairs with their selling days `days_max`; uncovered months are dropped."""
    months = horizon_months(locations)
    if params.calendar_version == "forecast_date":
        return days_at_forecast_date(months, monthly_sales, params)
    return attach_calendar(months, calendar).select("date_forecast", "month", "days_max")


def with_open_months(locations: DataFrame, dates: DataFrame, params: ForecastParams) -> DataFrame:
    """C2 + E1 per location row: `open_months`, the covered months of its open
    horizon, in order, as an array of (month, days_max); their number
    `n_open`, and `n_uncovered`, the number of months the calendar lacks
    (dropped, as in the original).

    `dates` has one row per forecast date with its covered `months` (see
    `by_forecast_date`; entries may hold more) and whatever else the rows
    are to carry.  A location row takes a slice of them, so no row looks up
    a calendar.  The array holds at most months_predict + 1 entries.
    """
    rows = join_small(locations, dates, ["date_forecast"], params)
    lo, hi, ok = offset_range()
    ok = ok & F.col("months").isNotNull()
    since = months_between_exact(month_floor("date_forecast"), F.col("_first_month"))

    def before(offset: Column) -> Column:
        """How many covered months come before a month offset."""
        place = F.greatest(F.lit(0), F.least(offset - since, F.size("_before") - 1))
        return F.get(F.col("_before"), place)

    skipped = before(lo)
    rows = rows.withColumns({"_skipped": F.when(ok, skipped), "n_open": F.when(ok, before(hi + 1) - skipped).otherwise(F.lit(0)),
                             "_wanted": F.when(offset_range()[2], hi - lo + 1).otherwise(F.lit(0))})
    own = F.when(F.col("n_open") > 0, F.slice("months", F.col("_skipped") + 1, F.col("n_open")))
    return rows.withColumns({"open_months": F.coalesce(own, F.array().cast(dict(dates.dtypes)["months"])),
                             "n_uncovered": F.col("_wanted") - F.col("n_open")}) \
        .drop("months", "_first_month", "_before", "_skipped", "_wanted")


def with_places(dates: DataFrame) -> DataFrame:
    """`dates` with `_first_month`, the first of its `months`, and `_before`, for each month from there to the one
    after the last the number of covered months before it.

    With these a location row finds its part of `months` by two array reads
    instead of comparing every month.
    """
    first, last = F.element_at("months", 1)["month"], F.element_at("months", -1)["month"]
    places = F.sequence(F.lit(0), months_between_exact(first, last) + 1)
    count = lambda k: F.size(F.filter("months", lambda e: e["month"] < F.add_months(F.col("_first_month"), k)))
    return dates.withColumn("_first_month", first).withColumn("_before", F.transform(places, count))


def by_forecast_date(pairs: DataFrame) -> DataFrame:
    """One row per forecast date with its covered `months`, an array of (month, days_max) in order."""
    months = F.sort_array(F.collect_list(F.struct("month", "days_max")))
    return with_places(pairs.groupBy("date_forecast").agg(months.alias("months")))


def spread_for_explode(locations: DataFrame) -> DataFrame:
    """Hash location rows over `spark.sql.shuffle.partitions` before the explode.

    Adaptive execution sizes partitions from the table it has measured, and
    the location table is ~121 times smaller than what the explode makes of
    it: it would coalesce it to a few partitions and run the whole horizon
    in a few tasks.  An explicit partition count is not coalesced, so the
    explode gets the cluster's configured parallelism.  (loc_num,
    date_forecast) is unique per location row, so no key can skew this.
    """
    n = int(locations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return locations.repartition(n, "loc_num", "date_forecast")


def expand_horizon(locations: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """K3: one row per location row and month of its open horizon.

    `keep` lists the location columns carried to the rows (default: all).
    """
    cols = keep if keep is not None else list(locations.columns)
    return (locations.select(*cols, F.explode(horizon_offsets()).alias("_offset"))
            .withColumn("month", F.add_months(month_floor("date_forecast"), F.col("_offset")))
            .drop("_offset"))


def expand_open_months(locations: DataFrame, keep: list[str],
                       lookups: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """K3 + E1: one row per location row and entry of `open_months`.

    `lookups` maps output names to functions of the month and its position
    (from 0), evaluated *inside* the generator on the location row: wide
    per-location values (growth map, history slots, factors by month) are
    read there and never copied into the exploded rows, and no exploded row
    is joined or shuffled.
    """
    def per_month(e: Column, i: Column) -> Column:
        return F.struct(e["month"].alias("month"), e["days_max"].alias("days_max"),
                        *[fn(e["month"], i).alias(name) for name, fn in lookups.items()])

    return (locations.select(*keep, F.explode(F.transform("open_months", per_month)).alias("_h"))
            .select(*keep, "_h.*"))


def attach_calendar(horizon: DataFrame, calendar: DataFrame, how: str = "inner") -> DataFrame:
    """Selling days of the month from the calendar (broadcast: <=168 rows).

    Months whose layout is missing from the calendar are dropped (inner),
    as in the original; `how="left"` keeps them with null `days_max` for the
    coverage check.
    """
    keyed = horizon.select("*", *calendar_key("month"))
    cal = F.broadcast(calendar.select(*CALENDAR_KEYS, "days_max"))
    return keyed.join(cal, list(CALENDAR_KEYS), how).drop("jan1_day", "leap_year")

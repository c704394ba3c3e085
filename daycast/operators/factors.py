"""Days lost and factors by location and month.

The three tables keyed by (loc_num, month) are folded into one map per
location, `month -> (days_lost, gocf, reinvestment_factor)`, and joined to
the location rows before the explode; the generator reads them there, so
no exploded row is joined.  The map is bounded: keys are unique (duplicate
keys fail the run's checks; until then the largest value counts and no row
is multiplied) and months outside the run's horizon are left out.

In backtest scope a factor of a month at or after date_forecast + vision is
unknown and the last known one is carried forward.  A known factor is never
null (0 where there is none), so the value carried is the one of the last
open month within the vision: one value per location row, not a window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.params import BACKTEST, ForecastParams

VALUES = ("days_lost", "gocf", "reinvestment_factor")


def factors_by_month(days_lost: DataFrame, cannibalization: DataFrame, reinvestment: DataFrame,
                     pairs: DataFrame) -> DataFrame:
    """One row per location with `factors`, its map of months to values.

    `days_lost` may carry `whole_month` (see `days.closed_parts`).  Only
    the different months of `pairs` are kept; they are broadcast (12 per year
    of the horizon).
    """
    types = {"days_lost": "int", "whole_month": "boolean", "gocf": "double", "reinvestment_factor": "double"}

    def part(df: DataFrame, **values: str) -> DataFrame:
        return df.select("loc_num", "month", *[(F.col(values[n]) if values.get(n) in df.columns else F.lit(None)).cast(t).alias(n)
                                               for n, t in types.items()])

    every = (part(days_lost, days_lost="days_lost", whole_month="whole_month")
             .unionByName(part(cannibalization, gocf="gocf"))
             .unionByName(part(reinvestment, reinvestment_factor="factor")))
    by_month = (every.join(F.broadcast(pairs.select("month").distinct()), "month", "left_semi")
                .groupBy("loc_num", "month").agg(*[F.max(n).alias(n) for n in types]))
    entry = F.struct("month", F.struct(*types))
    return by_month.groupBy("loc_num").agg(F.map_from_entries(F.collect_list(entry)).alias("factors"))


def with_last_known_months(locations: DataFrame, params: ForecastParams, scope: str) -> DataFrame:
    """The values of each open month beside it, `found`, so that the map is searched once per month; and
    G7: per vision, its end and the value `_carried` beyond it, that of the last open month before the end
    (null if there is none).

    In forecast scope every factor is known and nothing is carried.
    """
    found = F.transform("open_months", lambda e: e.withField("found", F.try_element_at(F.col("factors"), e["month"])))
    locations = locations.withColumn("open_months", found)
    if scope != BACKTEST:
        return locations
    visions = {"gocf": params.opening_vision_months, "reinvestment_factor": params.reinvestment_vision_months}
    for name, months in visions.items():
        locations = locations.withColumn(f"{name}_end", F.add_months(F.col("date_forecast"), months))
    for name in visions:
        known = F.filter("open_months", lambda e: e["month"] < F.col(f"{name}_end"))     # in order
        locations = locations.withColumn("_last", F.try_element_at(known, F.lit(-1)))
        locations = locations.withColumn(f"{name}_carried", F.when(F.col("_last").isNotNull(), _value(F.col("_last"), name)))
    return locations.drop("_last")


def _value(entry: Column, name: str) -> Column:
    """A value of an open month, 0 where there is none."""
    return F.coalesce(entry["found"][name], F.lit(0) if name == "days_lost" else F.lit(0.0))


def factor_at(name: str, scope: str) -> Callable[[Column, Column], Column]:
    """K7, K16, K17 inside the generator: the value of the month, beyond the vision the carried one."""
    def lookup(month: Column, i: Column) -> Column:
        value = _value(F.get(F.col("open_months"), i), name)
        if scope != BACKTEST or name == "days_lost":
            return value
        return F.when(month < F.col(f"{name}_end"), value).otherwise(F.col(f"{name}_carried"))

    return lookup


def days_lost_at(month: Column, i: Column) -> Column:
    """K7 inside the generator: days lost of the month, its calendar days where a project closes all of it."""
    entry = F.get(F.col("open_months"), i)
    return F.coalesce(F.greatest(entry["found"]["days_lost"], F.when(entry["found"]["whole_month"], entry["days_max"])), F.lit(0))


def round_factors(rows: DataFrame, params: ForecastParams) -> DataFrame:
    """Rounded factors, if the run asks for them."""
    if not params.round_factors:
        return rows
    return rows.withColumns({"gocf": F.round("gocf", 15), "reinvestment_factor": F.round("reinvestment_factor", 2)})

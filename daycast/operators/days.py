"""Selling days lost to openings, closings and refurbishment shutdowns (K5, K6, K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.functions.dates import CALENDAR_KEYS, calendar_key, month_floor, sales_days_between


def valid_projects(projects: DataFrame) -> F.Column:
    """Projects with both dates and reopen >= shutdown (others fail check L2)."""
    return (F.col("shutdown").isNotNull() & F.col("reopen").isNotNull()
            & (F.col("reopen") >= F.col("shutdown")))


def shutdown_months(projects: DataFrame) -> DataFrame:
    """One row per project and month touched by [shutdown, reopen]."""
    first, last = month_floor("shutdown"), month_floor("reopen")
    touched = F.sequence(first, last, F.expr("interval 1 month"))
    return projects.where(valid_projects(projects)).select(
        "loc_num", "shutdown", "reopen", first.alias("month_shutdown"), last.alias("month_reopen"),
        F.explode(touched).alias("month"))


def shutdown_days_lost(projects: DataFrame, calendar: DataFrame) -> DataFrame:
    """K6: selling days lost per (loc_num, month).

    A month that lies wholly between shutdown and reopening loses its
    calendar days; any other touched month the selling days of its part of
    the closed interval, both ends included.
    Overlapping projects count once: the maximum per month.
    Months missing from the calendar are dropped, as in the original.
    The aggregate is partial before its shuffle, so many projects on one
    location are combined map-side.
    """
    keyed = shutdown_months(projects).select("*", *calendar_key("month")).join(
        F.broadcast(calendar.select(*CALENDAR_KEYS, "days_max")), list(CALENDAR_KEYS), "inner")
    whole = (F.col("month") > F.col("month_shutdown")) & (F.col("month") < F.col("month_reopen"))
    closed_part = sales_days_between(F.greatest("shutdown", "month"), F.least(F.col("reopen"), F.last_day("month")))
    lost = F.when(whole, F.col("days_max")).otherwise(closed_part)
    return keyed.groupBy("loc_num", "month").agg(F.max(lost).alias("days_lost"))


def closed_parts(projects: DataFrame) -> DataFrame:
    """K6 without the calendar: per (loc_num, month), `days_lost` of the months closed in part, and
    `whole_month` if some project closes all of it.

    A month closed as a whole loses its calendar days, which the row that
    looks it up has at hand (`factors.days_lost_at`); so the calendar is
    needed neither here nor twice in a plan, and may differ by forecast date.
    """
    whole = (F.col("month") > F.col("month_shutdown")) & (F.col("month") < F.col("month_reopen"))
    part = sales_days_between(F.greatest("shutdown", "month"), F.least(F.col("reopen"), F.last_day("month")))
    return shutdown_months(projects).groupBy("loc_num", "month").agg(
        F.max(F.when(~whole, part)).alias("days_lost"), F.max(whole).alias("whole_month"))


def final_days() -> F.Column:
    """K5 + K7: subtract shutdown days, then opening and closing days, floor at 0.

    In the opening month the days before the opening day are lost, but the
    opening day itself is not (hence `- 1`: if the opening day is a Sunday it
    was never counted, so the month keeps one day too many, as in the
    original).  In the closing month the closing day and those after it
    are lost.
    """
    m = F.col("month")
    lost = (F.col("days_lost")
            + F.when(m == F.col("month_open"), F.col("days_before_open") - 1).otherwise(F.lit(0))
            + F.when(m == F.col("month_close"), F.col("days_after_close")).otherwise(F.lit(0)))
    # greatest() skips nulls; a missing calendar value must stay missing for check L6.
    return (F.when(F.col("days_max").isNull(), F.lit(None))
            .otherwise(F.greatest(F.lit(0), F.col("days_max") - lost)).cast("int"))

"""Named check queries: one per operator group of the inventory.

Each query takes (spark, sf_dir), derives the domain tables from the
benchmark tables (`sources.fixtures`) and runs one operator, or the
pipeline up to one of its stages, over all rows.  Doubles are rounded to
6 digits in the final projection only, so results compare exactly with
the DuckDB oracle (`oracle_queries.py`).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.functions.dates import (
    WEEKDAY_NAMES,
    calendar_key,
    last_day_of,
    months_between_exact,
    sales_days_between,
    weekday_name,
    year_floor,
)
from daycast.operators import calendar as cal_ops
from daycast.operators import checks
from daycast.operators.days import shutdown_days_lost, shutdown_months as shutdown_months_op
from daycast.operators.history import cap_days, hist_array, history_days_by_month_num, last_twelve
from daycast.operators.horizon import closing_month, expand_horizon, prepare_locations, with_open_months
from daycast.params import BACKTEST, FORECAST, ForecastParams
from daycast.plans.pipeline import ForecastRun, forecast_sales_days, plan_forecast
from daycast.session import ensure_checkpoint_dir
from daycast.sources import fixtures, io
from daycast.sources.io import cleanse_sales_days_future
from daycast.sources.schemas import FORECAST_OUTPUT

Query = Callable[[SparkSession, str], DataFrame]
P = fixtures.FIXTURE_PARAMS


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _stages(spark: SparkSession, sf_dir: str, params: ForecastParams = P, scope: str = FORECAST,
            increases: bool = True) -> dict[str, DataFrame]:
    inp = fixtures.inputs(spark, sf_dir, backtest=(scope == BACKTEST))
    return plan_forecast(inp["sales_days_future"], inp["monthly_sales"], inp["reinvestment_projects"],
                         inp["cannibalization_factors"], inp["reinvestment_factors"], params, scope,
                         inp["price_increases"] if increases else None)


def _lineitem_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return li.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("start_date"))


# ---------------------------------------------------------------- sources, scalar functions

def cleanse_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw location table (text keys, 'null' close dates) cleansed."""
    out = cleanse_sales_days_future(fixtures.raw_sales_days_future(spark, sf_dir))
    return out.withColumn("concept_code", F.col("location_type_code"))


def salesdays_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10, D3, J3, J8 on one date pair per line item (spans of 0..399 days)."""
    d = _lineitem_dates(spark, sf_dir)
    span = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 400).cast("int")
    d = d.withColumn("end_date", F.date_add("start_date", span))
    return d.select("l_orderkey", "l_linenumber", "start_date", "end_date",
                    sales_days_between("start_date", "end_date").alias("sales_days"),
                    weekday_name("start_date").alias("start_weekday"),
                    last_day_of("start_date").alias("start_month_end"))


def months_between_exact_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4, J9 on one date pair per line item (both directions)."""
    d = _lineitem_dates(spark, sf_dir)
    shift = ((F.col("l_orderkey") * 11) % 2000 - 1000).cast("int")
    d = d.withColumn("end_date", F.date_add("start_date", shift))
    return d.select("l_orderkey", "l_linenumber", "start_date", "end_date",
                    months_between_exact("start_date", "end_date").alias("months"),
                    F.year("end_date").alias("end_year"), F.month("end_date").alias("end_month"),
                    F.dayofmonth("end_date").alias("end_day"))


def calendar_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar key of every month in the history."""
    ms = fixtures.monthly_sales(spark, sf_dir).select("month").distinct()
    return ms.select("month", year_floor("month").alias("year_start"), *calendar_key("month"))


# ---------------------------------------------------------------- calendar

def day_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, C3, E11, F1, F2, G4 (+K2 rows): the selling-day calendar."""
    return cal_ops.day_details(fixtures.monthly_sales(spark, sf_dir), P)


def leap_wednesday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar rows synthesised for leap years starting on Wednesday."""
    return cal_ops.synthesised_rows(fixtures.monthly_sales(spark, sf_dir), P)


# ---------------------------------------------------------------- horizon

def _locations(spark: SparkSession, sf_dir: str, params: ForecastParams = P) -> DataFrame:
    return prepare_locations(fixtures.sales_days_future(spark, sf_dir), params)


def horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per location and open month of the horizon."""
    locs = _locations(spark, sf_dir)
    h = expand_horizon(locs, keep=["loc_num", "date_forecast", "month_start", "month_open", "month_close"])
    return h.select("loc_num", "date_forecast", "month", "month_start", "month_open", "month_close")


def closing_vision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closing month with the 12-month vision rule, and without it."""
    sdf = fixtures.sales_days_future(spark, sf_dir)
    return sdf.select("loc_num", "date_forecast", "close_date",
                      closing_month(P).alias("month_close"),
                      closing_month(P.replace(closing_vision=False)).alias("month_close_always"))


def horizon_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Horizon rows with the calendar's selling days (months without calendar dropped)."""
    st = _stages(spark, sf_dir)
    return st["horizon"].select("loc_num", "date_forecast", "month", F.col("days_uncapped").alias("days_max"))


# ---------------------------------------------------------------- history and days

def history_last12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last 12 history rows of locations with at least 12."""
    return last_twelve(fixtures.monthly_sales(spark, sf_dir))


def history_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCL locations capped at their historical days."""
    st = _stages(spark, sf_dir)
    return st["horizon"].select("loc_num", "date_forecast", "month", F.col("days_uncapped").alias("days_max"),
                                F.col("days_max").alias("days_capped"))


def open_close_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selling days lost before opening and from closing, per location row."""
    return _locations(spark, sf_dir).select("loc_num", "date_forecast", "open_date", "close_date",
                                            "days_before_open", "days_after_close")


def shutdown_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months touched by each refurbishment project."""
    m = shutdown_months_op(fixtures.reinvestment_projects(spark, sf_dir))
    return m.select("loc_num", "shutdown", "reopen", "month",
                    months_between_exact("month_shutdown", "month").alias("month_index"))


def shutdown_days_lost_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selling days lost to projects per location and month."""
    cal = cal_ops.day_details(fixtures.monthly_sales(spark, sf_dir), P)
    return shutdown_days_lost(fixtures.reinvestment_projects(spark, sf_dir), cal)


def days_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7, E5, J13 (+K5, K8): final selling days per horizon row."""
    st = _stages(spark, sf_dir)
    return st["base"].select("loc_num", "date_forecast", "month", "days", "days_lost", "age")


# ---------------------------------------------------------------- inflation

def reported_inflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported month and its ending inflation factor, per location row."""
    st = _stages(spark, sf_dir)
    return round_doubles(st["locations"].select("loc_num", "date_forecast", "reported_month", "inflation_factor"))


def inflation_mean_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base inflation with gaps filled by the group mean, per horizon row."""
    st = _stages(spark, sf_dir)
    return round_doubles(st["base"].select("loc_num", "date_forecast", "month", "reported_month",
                                           "concept_code", "inflation_factor"))


def growth_rows(dates: DataFrame) -> DataFrame:
    return dates.select("date_forecast", F.explode("months").alias("m")).select(
        "date_forecast", "m.month", F.col("m.growth").alias("incremental_time_inflation"))


def inflation_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative growth per forecast date and month, forecast scope."""
    return round_doubles(growth_rows(_stages(spark, sf_dir)["dates"]))


def inflation_path_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K12 in backtest scope (N11: a begin rate above the end rate gives the end rate)."""
    return round_doubles(growth_rows(_stages(spark, sf_dir, scope=BACKTEST)["dates"]))


def _inflation_rows(st: dict[str, DataFrame]) -> DataFrame:
    return round_doubles(st["output"].select("loc_num", "date_forecast", "month", "inflation_factor"))


def inflation_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base inflation times the growth path."""
    return _inflation_rows(_stages(spark, sf_dir))


def shifted_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth held back by the price-change shift (no increases table)."""
    return _inflation_rows(_stages(spark, sf_dir, fixtures.PRICE_CHANGE_PARAMS, increases=False))


def price_change_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price increases of the announced change on top of the shifted growth."""
    return _inflation_rows(_stages(spark, sf_dir, fixtures.PRICE_CHANGE_PARAMS))


# ---------------------------------------------------------------- factors, bins, checks, final

def _factor(spark: SparkSession, sf_dir: str, scope: str, col: str) -> DataFrame:
    st = _stages(spark, sf_dir, scope=scope)
    return round_doubles(st["output"].select("loc_num", "date_forecast", "month", col))


def cannibalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cannibalisation factor per row, forecast scope."""
    return _factor(spark, sf_dir, FORECAST, "gocf")


def cannibalization_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beyond the opening vision the last known factor is carried forward."""
    return _factor(spark, sf_dir, BACKTEST, "gocf")


def reinvestment_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reinvestment factor per row, forecast scope."""
    return _factor(spark, sf_dir, FORECAST, "reinvestment_factor")


def reinvestment_factor_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beyond the reinvestment vision the last known factor is carried forward."""
    return _factor(spark, sf_dir, BACKTEST, "reinvestment_factor")


def age_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age in months and years, and age bin."""
    st = _stages(spark, sf_dir)
    return st["output"].select("loc_num", "date_forecast", "month", "age", "age_years", "age_group")


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check value as (check_name, value) rows."""
    inp = fixtures.inputs(spark, sf_dir)
    st = _stages(spark, sf_dir)
    locs = prepare_locations(inp["sales_days_future"], P)
    coverage = with_open_months(locs, st["dates"], P)
    rep = checks.quality_report(locs, inp["reinvestment_projects"], st["output"], inp["monthly_sales"], coverage)
    return rep.select(F.col("check").alias("check_name"), F.round("value", 6).alias("value"))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A3: the raw location table written as CSV and read through the registry."""
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    io.write_output(fixtures.raw_sales_days_future(spark, sf_dir), path, fmt="csv", partition_by=None)
    return io.load_inputs(spark, {"sales_days_future": path})["sales_days_future"]


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location rows of a faulty raw table that cannot be forecast."""
    return checks.rejects(cleanse_sales_days_future(fixtures.faulty_sales_days_future(spark, sf_dir)))


def unparsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts per date column of a faulty raw table that are no date."""
    return io.unparsed_dates("sales_days_future", fixtures.faulty_sales_days_future(spark, sf_dir))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 (keys): keys of a factor table, part of which was loaded twice, that occur more than once."""
    factors = fixtures.cannibalization_factors(spark, sf_dir)
    twice = factors.unionByName(factors.where(F.month("month") <= 3))
    return checks.duplicate_keys(twice, ["loc_num", "month"])


def sorted_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, H1, H3: the first five rows of the forecast by location, forecast date and month."""
    output = round_doubles(_stages(spark, sf_dir)["output"])
    return io.preview(output.orderBy("loc_num", "date_forecast", "month"), 5)


def price_change_mid_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change within a month (its share of selling days), announced between the two forecast dates."""
    return _inflation_rows(_stages(spark, sf_dir, fixtures.MID_MONTH_CHANGE_PARAMS))


def forecast_price_change_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K20, K14, K15 in backtest scope: one forecast date within the announcement, one after the change."""
    return round_doubles(_stages(spark, sf_dir, fixtures.BACKTEST_CHANGE_PARAMS, BACKTEST)["output"])


def closing_vision_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K20 with every known closing limiting the horizon."""
    return round_doubles(_stages(spark, sf_dir, P.replace(closing_vision=False))["output"])


def rounded_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K20 with rounded factors."""
    return round_doubles(_stages(spark, sf_dir, P.replace(round_factors=True))["output"])


def leap_all_weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K2: the calendar with leap layouts synthesised for every weekday."""
    return cal_ops.day_details(fixtures.monthly_sales(spark, sf_dir), P.replace(leap_weekdays=WEEKDAY_NAMES))


def forecast_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole forecast, forecast scope."""
    return round_doubles(_stages(spark, sf_dir)["output"])


def forecast_final_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K20 in backtest scope (two forecast dates per location)."""
    return round_doubles(_stages(spark, sf_dir, scope=BACKTEST)["output"])


# ---------------------------------------------------------------- runs that write, calendars, rejected rows

def _run(spark: SparkSession, sf_dir: str, params: ForecastParams = P, scope: str = FORECAST, date: dt.date | None = None,
         history: DataFrame | None = None) -> ForecastRun:
    """The forecast of the derived tables; `history` stands for the monthly history if that is stored already."""
    inp = fixtures.inputs(spark, sf_dir, backtest=(scope == BACKTEST))
    if history is not None:
        inp["monthly_sales"] = history
    locations = inp["sales_days_future"]
    if date is not None:
        locations = locations.where(F.col("date_forecast") == F.lit(date))
    return forecast_sales_days(locations, inp["monthly_sales"], inp["reinvestment_projects"], inp["cannibalization_factors"],
                               inp["reinvestment_factors"], params, scope, inp["price_increases"])


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly history, aggregated once and stored: a run that writes reads it five times."""
    path = _folder(spark, "history")
    fixtures.monthly_sales(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def observed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of every check as it rode on the write of the forecast."""
    run = _run(spark, sf_dir, history=_stored_history(spark, sf_dir))
    run.write(_folder(spark, "forecast"))
    return spark.createDataFrame([(k, None if v is None else round(float(v), 6)) for k, v in run.metrics().items()],
                                 "check_name string, value double")


def sorted_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: the forecast written in one order; each row's place by file name and row number as read back."""
    path = _folder(spark, "sorted")
    _run(spark, sf_dir, scope=BACKTEST, history=_stored_history(spark, sf_dir)).write(path, sort=True)
    return io.with_file_positions(spark.read.parquet(path)).select("loc_num", "month", "date_forecast", "position")


def single_file_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, H5: the forecast written as one CSV file and read back, with the number of files."""
    path = _folder(spark, "single")
    _run(spark, sf_dir, history=_stored_history(spark, sf_dir)).write(path, fmt="csv", single_file=True)
    back = spark.read.schema(FORECAST_OUTPUT).option("header", True).csv(path)
    n_files = back.agg(F.count_distinct(F.col("_metadata.file_path"))).scalar()
    return round_doubles(back.withColumn("n_files", n_files))


def rewritten_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: two forecast dates written, then one of them again with other parameters."""
    path, history = _folder(spark, "dates"), _stored_history(spark, sf_dir)
    _run(spark, sf_dir, scope=BACKTEST, history=history).write(path)
    _run(spark, sf_dir, P.replace(closing_vision=False), BACKTEST, fixtures.BACKTEST_DATES[1], history).write(path, replace="dates")
    return round_doubles(spark.read.parquet(path))


def calendar_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month layouts that the calendar lacks, with the months and location-months left out."""
    return _run(spark, sf_dir, scope=BACKTEST).uncovered


def synthesised_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K2: the calendar with every layout that looks like a month of the history."""
    return cal_ops.day_details(fixtures.monthly_sales(spark, sf_dir), P.replace(calendar_gap="synthesise"))


def forecast_synthesised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K20 without calendar gaps."""
    return round_doubles(_stages(spark, sf_dir, P.replace(calendar_gap="synthesise"))["output"])


def forecast_versioned_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K20 in backtest scope, each forecast date with the calendar known on it."""
    return round_doubles(_stages(spark, sf_dir, P.replace(calendar_version="forecast_date"), BACKTEST)["output"])


def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines that are no rows of the location table, with the reason, and the number of those that are."""
    path = _folder(spark, "lines")
    fixtures.broken_lines(spark, sf_dir).write.text(path)
    good, rejects = io.read_checked(spark, "sales_days_future", path, fixtures.RAW_COLUMNS)
    read = good.agg(F.lit("read").alias("reason"), F.lit(None).cast("string").alias("line"), F.count(F.lit(1)).alias("n"))
    return read.unionByName(rejects.groupBy("reason", "line").agg(F.count(F.lit(1)).alias("n")))


def cleanse_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and dates of a table outside the registry."""
    return io.cleanse_columns(fixtures.raw_orders(spark, sf_dir), ["o_orderkey", "o_custkey"], ["o_orderdate"], width=8)


QUERIES: dict[str, Query] = {
    "cleanse_locations": cleanse_locations,
    "salesdays_between": salesdays_between,
    "months_between_exact": months_between_exact_q,
    "calendar_keys": calendar_keys,
    "day_details": day_details,
    "leap_wednesday": leap_wednesday,
    "horizon": horizon,
    "closing_vision": closing_vision,
    "horizon_calendar": horizon_calendar,
    "history_last12": history_last12,
    "history_cap": history_cap,
    "open_close_days": open_close_days,
    "shutdown_months": shutdown_months,
    "shutdown_days_lost": shutdown_days_lost_q,
    "days_final": days_final,
    "reported_inflation": reported_inflation,
    "inflation_mean_fill": inflation_mean_fill,
    "inflation_path": inflation_path,
    "inflation_path_backtest": inflation_path_backtest,
    "inflation_applied": inflation_applied,
    "shifted_increase": shifted_increase,
    "price_change_overlay": price_change_overlay,
    "cannibalization": cannibalization,
    "cannibalization_backtest": cannibalization_backtest,
    "reinvestment_factor": reinvestment_factor,
    "reinvestment_factor_backtest": reinvestment_factor_backtest,
    "age_groups": age_groups,
    "quality_report": quality_report,
    "csv_round_trip": csv_round_trip,
    "rejects": rejects,
    "unparsed_dates": unparsed_dates,
    "duplicate_keys": duplicate_keys,
    "sorted_preview": sorted_preview,
    "price_change_mid_month": price_change_mid_month,
    "forecast_price_change_backtest": forecast_price_change_backtest,
    "closing_vision_off": closing_vision_off,
    "rounded_factors": rounded_factors,
    "leap_all_weekdays": leap_all_weekdays,
    "forecast_final": forecast_final,
    "forecast_final_backtest": forecast_final_backtest,
    "observed_checks": observed_checks,
    "sorted_sink": sorted_sink,
    "single_file_sink": single_file_sink,
    "rewritten_date": rewritten_date,
    "calendar_coverage": calendar_coverage,
    "synthesised_calendar": synthesised_calendar,
    "forecast_synthesised": forecast_synthesised,
    "forecast_versioned_calendar": forecast_versioned_calendar,
    "malformed_rows": malformed_rows,
    "cleanse_orders": cleanse_orders,
}

"""Data-quality checks.

The original job stopped the process on bad input.  Here the checks on rows
are metrics that ride on the run's one action (`ForecastRun`), and unique
keys one small job over the inputs; a failed one raises `DataQualityError`.
The same values are available as rows (`quality_report`) for auditing, and
rows that cannot be forecast can be split off with `rejects`.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daycast.functions.dates import CALENDAR_KEYS, calendar_key, month_floor
from daycast.operators.horizon import offset_range
from daycast.params import ForecastParams


class DataQualityError(RuntimeError):
    """A run's inputs or output failed a data-quality check."""


def required_missing() -> Column:
    """A location row without key or forecast date cannot be forecast."""
    return F.col("loc_num").isNull() | F.col("date_forecast").isNull()


def unusable_location() -> Column:
    """A location row without key, forecast date or open date."""
    return required_missing() | F.col("open_date").isNull()


def rejects(sales_days_future: DataFrame) -> DataFrame:
    """The location rows the forecast cannot use, for a rejects table."""
    return sales_days_future.where(unusable_location())


def invalid_project() -> Column:
    """L2: a project with missing or reversed dates."""
    return F.col("shutdown").isNull() | F.col("reopen").isNull() | (F.col("reopen") < F.col("shutdown"))


def input_metrics() -> list[Column]:
    """C1, L1, L3 on location rows."""
    return [
        F.count_if(required_missing()).alias("required_missing"),
        F.count_if(F.col("open_date").isNull()).alias("open_date_missing"),
        F.count_if(F.col("location_type_code").isNull() | F.col("concept_code").isNull())
        .alias("type_code_missing"),
    ]


def project_metrics() -> list[Column]:
    """L2 on reinvestment projects: missing or reversed dates."""
    return [F.count_if(invalid_project()).alias("project_dates_invalid")]


def output_metrics() -> list[Column]:
    """L4, L5, L6 on output rows."""
    infl = F.col("inflation_factor")
    return [
        F.count_if(infl.isNull() | F.isnan(infl)).alias("inflation_missing"),
        F.max(infl).alias("inflation_max"),
        F.count_if(F.col("days").isNull()).alias("days_missing"),
    ]


def calendar_metrics() -> list[Column]:
    """L7 (coverage) on location rows with open months: horizon months whose layout the calendar lacks."""
    return [F.coalesce(F.sum("n_uncovered"), F.lit(0)).alias("calendar_missing")]      # 0 without rows


def failures(metrics: dict, params: ForecastParams) -> list[str]:
    """Human-readable list of failed checks for collected metric values."""
    out = []
    if metrics.get("required_missing"):
        out.append(f"{metrics['required_missing']} location rows miss the key or forecast date (C1)")
    if metrics.get("open_date_missing"):
        out.append(f"{metrics['open_date_missing']} location rows miss an open date (L1)")
    if metrics.get("project_dates_invalid"):
        out.append(f"{metrics['project_dates_invalid']} projects have missing or reversed dates (L2)")
    if metrics.get("type_code_missing"):
        out.append(f"{metrics['type_code_missing']} location rows miss a type or concept code (L3)")
    if metrics.get("inflation_missing"):
        out.append(f"{metrics['inflation_missing']} output rows miss an inflation factor (L4)")
    mx = metrics.get("inflation_max")
    if mx is not None and mx > params.inflation_factor_max:
        out.append(f"largest inflation factor {mx} exceeds {params.inflation_factor_max} (L5)")
    if metrics.get("days_missing"):
        out.append(f"{metrics['days_missing']} output rows miss a day count (L6)")
    if metrics.get("calendar_missing") and params.calendar_gap == "error":
        out.append(f"{metrics['calendar_missing']} horizon months have no calendar entry (L7)")
    for name, n in metrics.items():
        if name.endswith("_duplicate_keys") and n:
            out.append(f"{n} keys of the {name.removesuffix('_duplicate_keys')} table occur more than once (L7)")
    return out


def raise_failures(metrics: dict, params: ForecastParams) -> None:
    failed = failures(metrics, params)
    if failed:
        raise DataQualityError("; ".join(failed))


class Observed:
    """Metrics of `df` that ride on the action over `rows`."""

    def __init__(self, df: DataFrame, metrics: list[Column]):
        self.observation = Observation()
        self.rows = df.observe(self.observation, *metrics)
        self.alone = df.agg(*metrics)

    def values(self) -> dict:
        """The metrics' values, after the action.

        Spark leaves a branch out of the plan, and its metrics with it, when
        it turns out while running that nothing of it is left for the
        result (say, none of the projects is valid).  They are then computed
        by themselves, so that such a run can't pass its checks unseen.
        """
        try:
            return self.observation.get
        except Py4JJavaError as e:
            if "AssertionError" not in str(e.java_exception):
                raise
        return self.alone.first().asDict()


def observed_values(seen: list[Observed]) -> dict:
    return {k: v for observed in seen for k, v in observed.values().items()}


def uncovered_layouts(locations: DataFrame, pairs: DataFrame) -> DataFrame:
    """L7 (coverage): the month layouts that the calendar lacks and what that costs.

    One row per (jan1_day, month_num, leap_year) with the number of
    different `months` left out, the first and the last of them, and the
    `location_months` dropped.  `pairs` are the covered (date_forecast,
    month) rows.  Locations are counted by offset range before months are
    generated, so nothing of the horizon's size is shuffled.
    """
    lo, hi, ok = offset_range()
    ranges = locations.where(ok).groupBy("date_forecast", lo.alias("lo"), hi.alias("hi")).agg(F.count(F.lit(1)).alias("n"))
    wanted = (ranges.select("date_forecast", "n", F.explode(F.sequence("lo", "hi")).alias("_k"))
              .select("date_forecast", "n", F.add_months(month_floor("date_forecast"), F.col("_k")).alias("month")))
    lost = wanted.join(pairs.select("date_forecast", "month"), ["date_forecast", "month"], "left_anti")
    by_month = lost.groupBy("month").agg(F.sum("n").alias("n"))
    return (by_month.select("month", "n", *calendar_key("month")).groupBy(*CALENDAR_KEYS)
            .agg(F.count(F.lit(1)).alias("months"), F.min("month").alias("first_month"), F.max("month").alias("last_month"),
                 F.sum("n").alias("location_months")))


def all_duplicate_keys(keyed: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """L7 (keys) of several tables in one job: (table, duplicate_keys) rows."""
    parts = [duplicate_keys(df, keys).select(F.lit(name).alias("table"), "duplicate_keys") for name, (df, keys) in keyed.items()]
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """L7 (keys): number of key values that occur more than once."""
    return (df.groupBy(*keys).count().where(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("duplicate_keys")))


def _long(one_row: DataFrame) -> DataFrame:
    """A one-row frame of metrics as (check, value) rows."""
    pairs = [F.struct(F.lit(c).alias("check"), F.col(c).cast("double").alias("value")) for c in one_row.columns]
    return one_row.select(F.explode(F.array(*pairs)).alias("m")).select("m.check", "m.value")


def quality_report(locations: DataFrame, projects: DataFrame, output: DataFrame,
                   monthly_sales: DataFrame, coverage: DataFrame | None = None) -> DataFrame:
    """All check values as (check, value) rows, for auditing: ordinary aggregates, no observe.

    `locations` must carry `concept_code` (see `prepare_locations`);
    `coverage` holds location rows with `n_uncovered` (see `with_open_months`).
    """
    parts = [
        locations.agg(*input_metrics()),
        projects.agg(*project_metrics()),
        output.agg(*output_metrics()),
        duplicate_keys(monthly_sales, ["loc_num", "month"]).select(
            F.col("duplicate_keys").alias("history_duplicate_keys")),
    ]
    if coverage is not None:
        parts.append(coverage.agg(*calendar_metrics()))
    out = _long(parts[0])
    for p in parts[1:]:
        out = out.unionByName(_long(p))
    return out

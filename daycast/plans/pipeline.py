"""The whole forecast (K20) as one lazy plan.

Order of the business steps (as in the original): calendar (K1, K2);
horizon with closing vision (K3, K18) and calendar join (E1); OCL cap
(K4); check L3; days lost to shutdowns (K6, K7), openings and closings
(K5); age (K8); reported month and base inflation (K10, K11); growth path
(K12), price shift and overlay (K14, K15), applied (K13); check L4/L5;
factors (K16, K17); age bins (K9); check L6; final projection (B10).

Physical shape (what the plan does at scale):

* The horizon is expanded once.  Location-row work (start offset, opening
  and closing months and days, open months with their calendar days,
  reported month, base inflation, group means, growth path, history cap,
  days lost and factors by month, price group) happens before the explode,
  on a table `months_predict + 1` times smaller than the output.
* The calendar meets one table of (forecast date, month) rows; what comes of
  it, with the growth path, is one row per forecast date.  That table and
  the means per reported month and concept are counted in the run and
  broadcast up to `broadcast_rows` rows, else joined on a salted key
  (`joins.join_small`): location rows don't move for them.
* Tables per location (12 historical day counts, pivoted; factors by month)
  carry no broadcast hint: adaptive execution broadcasts them when their
  materialised size is under `spark.sql.adaptive.autoBroadcastJoinThreshold`
  and otherwise keeps a sort-merge join with skew splitting.
* Rows of the horizon are never shuffled: the generator reads everything
  they need from its location row, price shift and back-test fill included.
* No action runs inside; checks are small explicit aggregates (see ForecastRun).
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.functions.numeric import age_group, age_years
from daycast.functions.dates import months_between_exact
from daycast.operators import checks
from daycast.operators.calendar import day_details
from daycast.operators.days import closed_parts, final_days
from daycast.operators.factors import days_lost_at, factor_at, factors_by_month, round_factors, with_last_known_months
from daycast.operators.history import cap_days, hist_array, history_days_by_month_num
from daycast.operators.horizon import (
    covered_months,
    expand_open_months,
    horizon_months,
    prepare_locations,
    spread_for_explode,
    with_open_months,
)
from daycast.operators.inflation import (
    attach_price_increases,
    attach_reported_inflation,
    fill_inflation,
    growth_at,
    inflation_means,
    path_and_months,
    price_change_uplift,
)
from daycast.params import SCOPES, ForecastParams
from daycast.sources import io
from daycast.sources.schemas import FINAL_COLUMNS

DATE = "date_forecast"


@dataclasses.dataclass
class ForecastRun:
    """A lazily planned forecast and its data-quality checks.

    `output` is the plain lazy result.  The checks on rows (L1-L6, calendar
    coverage) are metrics that ride on one action over the same plan
    (`Observation`): on the write, or, if there is none, on one run whose
    rows go nowhere.  Nothing is computed a second time for them.  Unique
    keys (L7) can't be seen row by row; they are one small job over the
    inputs, before anything is written.

    A task that runs again after a lost executor may report its rows twice.
    Checks fail on counts above 0 and on a maximum, so that changes no
    verdict, only possibly the number in a message.
    """

    output: DataFrame
    params: ForecastParams
    observed: Callable[[], tuple[DataFrame, list[checks.Observed]]]
    key_checks: DataFrame | None = None
    uncovered: DataFrame | None = None
    dates: DataFrame | None = None
    rejects: dict[str, DataFrame] = dataclasses.field(default_factory=dict)
    _keys: dict | None = None
    _rows: dict | None = None

    def key_metrics(self) -> dict:
        if self._keys is None:
            found = self.key_checks.collect() if self.key_checks is not None else []
            self._keys = {f"{r['table']}_duplicate_keys": r["duplicate_keys"] for r in found}
        return self._keys

    def metrics(self) -> dict:
        """The value of every check, from the run's one action if there was one."""
        if self._rows is None:
            output, seen = self.observed()
            if seen:
                output.write.format("noop").mode("overwrite").save()
            self._rows = checks.observed_values(seen)
        return self._rows | self.key_metrics()

    def check(self) -> None:
        """Raise DataQualityError if any check failed."""
        checks.raise_failures(self.metrics(), self.params)

    def write(self, path: str, fmt: str = "parquet", replace: str = "all", sort: bool = False, files: int | None = None,
              **options) -> None:
        """Write to `path + '.staging'`, check, then move the result to `path`.

        `replace="all"` puts the result in the place of all of `path`;
        `replace="dates"` only in that of its input's forecast dates, others
        stay (a date for which nothing is forecast any more goes).  `sort=True` writes files that form one order by location,
        month and forecast date (H1; see `io.write_sorted`), which holds for
        the result as a whole, so it goes with `replace="all"` only.

        Rejected input rows, if the run sets them aside, go the same way
        to one table per input under `path + '.rejects'`.  A failing check
        raises and leaves the staging copies for inspection; what was
        published before stays as it was.
        """
        if replace not in ("all", "dates"):
            raise ValueError(f"replace must be 'all' or 'dates', not {replace!r}")
        if replace == "dates" and (sort or options.get("single_file") or options.get("partition_by", DATE) != DATE):
            raise ValueError("single dates can be replaced only in output partitioned by forecast date")
        checks.raise_failures(self.key_metrics(), self.params)
        spark, root = self.output.sparkSession, path.rstrip("/")
        output, seen = self.observed()
        staging = f"{root}.staging"
        if sort:
            # The forecast runs once; its order is cut from the rows as written.
            io.write_output(output, f"{staging}.unsorted", partition_by=None)
            io.write_sorted(spark.read.parquet(f"{staging}.unsorted"), staging, fmt, files)
        else:
            io.write_output(output, staging, fmt=fmt, **options)
        self._rows = checks.observed_values(seen)
        for name, df in self.rejects.items():
            io.write_output(df, f"{root}.rejects.staging/{name}", fmt=fmt, partition_by=DATE if DATE in df.columns else None)
        self.check()
        dates = [io.partition_name(DATE, r[0]) for r in self.dates.collect()] if replace == "dates" else None
        for name, df in self.rejects.items():
            there = f"{root}.rejects.staging/{name}", f"{root}.rejects/{name}"
            if dates is not None and DATE in df.columns:
                # Rows without a forecast date belong to no date; those of the last run stand for them.
                io.publish_partitions(spark, *there, [*dates, io.partition_name(DATE, None)])
            else:
                io.publish(spark, *there)
        if self.rejects:
            io.remove(spark, f"{root}.rejects.staging")
        if dates is None:
            io.publish(spark, staging, path)
        else:
            io.publish_partitions(spark, staging, path, dates)
        io.remove(spark, f"{staging}.unsorted")


def plan_forecast(sales_days_future: DataFrame, monthly_sales: DataFrame,
                  reinvestment_projects: DataFrame, cannibalization_factors: DataFrame,
                  reinvestment_factors: DataFrame, params: ForecastParams,
                  scope: str = "forecast", price_increases: DataFrame | None = None,
                  observe=None) -> dict[str, DataFrame]:
    """K20 as named lazy stages; `forecast_sales_days` returns the last one.

    Stages: calendar, pairs (forecast date, month, selling days), dates (one
    row per forecast date: covered months, growth path), locations (prepared,
    with base inflation), means, horizon (expanded rows with calendar and OCL
    cap), base (days, age and filled base inflation per row), output.

    `observe(df, metrics)` may attach the checks' metrics to the
    places they are about; every row passes each place exactly once.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}, not {scope!r}")
    observe = observe or (lambda df, metrics: df)
    st: dict[str, DataFrame] = {}

    calendar = st["calendar"] = day_details(monthly_sales, params)
    prepared = prepare_locations(sales_days_future, params)
    pairs = st["pairs"] = covered_months(prepared, monthly_sales, calendar, params)
    dates = st["dates"] = path_and_months(pairs, params, scope)
    locs = st["locations"] = attach_reported_inflation(prepared, monthly_sales)
    means = st["means"] = inflation_means(with_open_months(locs, dates, params))
    projects = observe(reinvestment_projects, checks.project_metrics())

    locs = fill_inflation(locs, means, params)
    # Built before the rows are spread: inside the generator it would be built once a month.
    history = history_days_by_month_num(monthly_sales).select("loc_num", hist_array().alias("hist"))
    locs = locs.join(history, ["loc_num"], "left")
    locs = locs.join(factors_by_month(closed_parts(projects), cannibalization_factors,
                                      reinvestment_factors, horizon_months(prepared)), ["loc_num"], "left")
    if params.price_change is not None:
        locs = attach_price_increases(locs, price_increases)
    locs = with_open_months(spread_for_explode(locs), dates, params)
    locs = observe(locs, checks.input_metrics() + checks.calendar_metrics())
    locs = with_last_known_months(locs, params, scope)

    keep = [c for c in prepared.columns if c not in ("month_start", "months_predict")] + ["inflation_factor"]
    if params.price_change is not None:
        keep.append("inc")
    rows = expand_open_months(locs, keep, {
        "growth": growth_at,
        "hist_days": lambda m, i: F.element_at(F.col("hist"), F.month(m)),
        "days_lost": days_lost_at,
        **{name: factor_at(name, scope) for name in ("gocf", "reinvestment_factor")},
    })
    rows = st["horizon"] = rows.withColumns({"days_uncapped": F.col("days_max"), "days_max": cap_days()})
    rows = st["base"] = rows.withColumns({
        "days": final_days(),
        "age": months_between_exact("month_open", "month"),
    })
    rows = rows.withColumn("inflation_factor", F.col("inflation_factor") * F.col("growth") * price_change_uplift(params))
    rows = round_factors(rows, params)
    rows = rows.withColumn("age_years", age_years("age")).withColumn("age_group", age_group("age_years"))
    st["output"] = observe(rows.select(*FINAL_COLUMNS), checks.output_metrics())
    return st


def forecast_sales_days(sales_days_future: DataFrame, monthly_sales: DataFrame,
                        reinvestment_projects: DataFrame, cannibalization_factors: DataFrame,
                        reinvestment_factors: DataFrame, params: ForecastParams,
                        scope: str = "forecast", price_increases: DataFrame | None = None,
                        with_checks: bool = True, on_invalid: str = "stop") -> ForecastRun:
    """Sales days, inflation and factors per location, forecast date and month.

    Returns the lazy output and its checks L1-L7, which
    `ForecastRun.write()` runs.  Horizon months without a calendar entry are
    always counted (`ForecastRun.uncovered` lists their layouts) and fail
    with `calendar_gap="error"`; a key that occurs twice in a keyed table fails.

    Location rows without key, forecast date or open date and projects with
    missing or reversed dates fail the checks (`on_invalid="stop"`), or are
    set aside as the run's `rejects` and not forecast (`"reject"`).
    """
    if on_invalid not in ("stop", "reject"):
        raise ValueError(f"on_invalid must be 'stop' or 'reject', not {on_invalid!r}")
    rejects: dict[str, DataFrame] = {}
    all_locations = sales_days_future
    if on_invalid == "reject":
        bad_project = checks.invalid_project()
        rejects = {"sales_days_future": checks.rejects(sales_days_future),
                   "reinvestment_projects": reinvestment_projects.where(bad_project)}
        sales_days_future = sales_days_future.where(~checks.unusable_location())
        reinvestment_projects = reinvestment_projects.where(~bad_project)
    inputs = (sales_days_future, monthly_sales, reinvestment_projects, cannibalization_factors, reinvestment_factors)
    st = plan_forecast(*inputs, params, scope, price_increases)
    dates = all_locations.where(F.col(DATE).isNotNull()).select(DATE).distinct()

    def observed() -> tuple[DataFrame, list[checks.Observed]]:
        seen: list[checks.Observed] = []

        def observe(df: DataFrame, metrics: list) -> DataFrame:
            seen.append(checks.Observed(df, metrics))
            return seen[-1].rows

        if not with_checks:
            return st["output"], seen
        return plan_forecast(*inputs, params, scope, price_increases, observe)["output"], seen

    keyed = {"locations": (sales_days_future, ["loc_num", "date_forecast"]), "history": (monthly_sales, ["loc_num", "month"]),
             "cannibalization": (cannibalization_factors, ["loc_num", "month"]),
             "reinvestment": (reinvestment_factors, ["loc_num", "month"]), "price": (price_increases, ["price_group"])}
    key_checks = checks.all_duplicate_keys({k: v for k, v in keyed.items() if v[0] is not None}) if with_checks else None
    uncovered = checks.uncovered_layouts(prepare_locations(sales_days_future, params), st["pairs"])
    return ForecastRun(st["output"], params, observed, key_checks, uncovered, dates, rejects)

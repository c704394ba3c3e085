"""Physical-plan properties: built-in expressions only, no cartesian joins,
bounded broadcasts, no actions while planning, pruned and pushed-down scans."""

import datetime as dt

import pytest

from daycast import forecast_sales_days
from daycast.sources import fixtures

SF = "/root/testdata/sf0.001"
P = fixtures.FIXTURE_PARAMS


@pytest.fixture(scope="module")
def stored_inputs(spark, tmp_path_factory):
    """The fixture tables written once as parquet, read back like production inputs."""
    base = tmp_path_factory.mktemp("inputs")
    out = {}
    for name, df in fixtures.inputs(spark, SF).items():
        df.write.mode("overwrite").parquet(str(base / name))
        out[name] = spark.read.parquet(str(base / name))
    return out


def _run(stored, scope="forecast", params=P):
    i = stored
    return forecast_sales_days(i["sales_days_future"], i["monthly_sales"], i["reinvestment_projects"],
                               i["cannibalization_factors"], i["reinvestment_factors"], params, scope,
                               i["price_increases"])


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_and_no_cartesian(stored_inputs):
    for scope in ("forecast", "backtest"):
        plan = _plan(_run(stored_inputs, scope).output)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (scope, bad)


def test_calendar_is_broadcast(stored_inputs):
    plan = _plan(_run(stored_inputs).output)
    assert "BroadcastExchange" in plan and "BroadcastHashJoin" in plan


def test_building_the_plan_runs_no_job(spark, stored_inputs):
    sc = spark.sparkContext
    sc.setJobGroup("daycast-plan-only", "planning")
    try:
        run = _run(stored_inputs, "backtest", P.replace(price_change=dt.date(2001, 6, 1)))
        run.output.schema  # analysis only
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert list(sc.statusTracker().getJobIdsForGroup("daycast-plan-only")) == []


def _executed(df) -> str:
    """The final adaptive plan, after the query has run."""
    df._jdf.queryExecution().toRdd().count()
    plan = _plan(df)
    assert "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("scope,params", [("forecast", P.replace(price_change=None)), ("backtest", P),
                                          ("forecast", fixtures.PRICE_CHANGE_PARAMS)])
def test_horizon_is_expanded_once_and_never_shuffled(stored_inputs, scope, params):
    plan = _executed(_run(stored_inputs, scope, params).output)
    lines = plan.split("\n")
    generators = [i for i, line in enumerate(lines) if "Generate explode" in line and "_h#" in line]
    assert len(generators) == 1, plan
    # the plan is printed from the output down: nothing is exchanged, joined or windowed above the explode
    above = "\n".join(lines[:generators[0]])
    assert not any(node in above for node in ("Exchange", "Join", "Window")), above
    assert "PARTITION BY loc_num" not in plan and "Window [last(" not in plan


def test_history_scans_are_pruned_and_pushed(stored_inputs):
    plan = _plan(_run(stored_inputs).output)
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and "monthly_sales" in line]
    assert scans
    for s in scans:
        assert "sales:" not in s.split("ReadSchema")[1], s   # the sales amount is never read
    assert any("LessThanOrEqual(month,2001-12-31)" in s for s in scans)  # as-of bound reaches the scan


def test_checks_pass_on_fixture(stored_inputs):
    run = _run(stored_inputs)
    n = run.output.count()
    assert n > 0
    run.check()
    m = run.metrics()
    assert m["days_missing"] == 0 and m["inflation_missing"] == 0 and m["inflation_max"] < 10


def test_last_twelve_limits_rows_before_the_shuffle(stored_inputs):
    from daycast.operators.history import history_days_by_month_num
    plan = _plan(history_days_by_month_num(stored_inputs["monthly_sales"]))
    lines = plan.split("\n")
    partial = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line]
    assert partial, plan
    # the partial top-12 sits below (i.e. before) the first shuffle on loc_num
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(loc_num" in line]
    assert exchanges and min(exchanges) < partial[0]


def test_calendar_gap_error_reports_coverage(stored_inputs):
    from daycast.operators.checks import DataQualityError
    run = _run(stored_inputs, params=P.replace(calendar_gap="error"))
    ok = _run(stored_inputs)
    assert run.output.count() == ok.output.count()   # same rows; the gaps are reported, not kept
    with pytest.raises(DataQualityError, match="L7"):
        run.check()


def test_staged_write_publishes_after_checks(spark, stored_inputs, tmp_path):
    run = _run(stored_inputs)
    target = str(tmp_path / "forecast")
    run.write(target)
    assert spark.read.parquet(target).count() == run.output.count()
    assert not (tmp_path / "forecast.staging").exists()


def test_results_do_not_depend_on_session_time_zone(spark):
    from daycast.plans.queries import forecast_final
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = forecast_final(spark, SF)
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
        far = forecast_final(spark, SF)
        assert utc.count() == far.count() and utc.exceptAll(far).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)

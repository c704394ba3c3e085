"""One test per hand-made case of FIXTURES.md section 5, plus operator edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daycast import ForecastParams, forecast_sales_days
from daycast.functions.dates import sales_days_between
from daycast.functions.numeric import age_group, age_years
from daycast.operators import calendar as cal_ops
from daycast.operators.checks import DataQualityError
from daycast.operators.days import final_days, shutdown_days_lost
from daycast.operators.factors import VALUES, factor_at, factors_by_month, round_factors, with_last_known_months
from daycast.operators.horizon import expand_horizon, expand_open_months, prepare_locations
from daycast.operators.inflation import growth_at, inflation_path, price_change_uplift
from daycast.sources.io import pad_key, read_input

D = dt.date
P = ForecastParams(as_of=D(2017, 1, 31))
SDF = ("loc_num string, date_forecast date, open_date date, close_date date, location_type_code string, "
       "price_group string, months_predict int")
MS = "loc_num string, month date, open_date date, sales double, days int, inflation_factor_ending double"
PROJ = "loc_num string, shutdown date, reopen date"
FACT = "loc_num string, month date, gocf double"
RFACT = "loc_num string, month date, factor double"


def brute(a, b):
    return sum(1 for i in range((b - a).days + 1) if (a + dt.timedelta(i)).isoweekday() != 7)


def month_seq(first, n):
    out, y, m = [], first.year, first.month
    for _ in range(n):
        out.append(D(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def history(spark, locs=("A", "B"), first=D(2013, 1, 1), n=48):
    rows = []
    for loc in locs:
        for m in month_seq(first, n):
            end = month_seq(m, 2)[1] - dt.timedelta(1)
            rows.append((loc, m, D(2010, 1, 1), 100.0, brute(m, end) - 1, 1.1))
    return spark.createDataFrame(rows, MS)


def one_calendar(spark, rows):
    return spark.createDataFrame(rows, "jan1_day string, month_num int, leap_year boolean, year_ref date, days_max int")


def _days_for(spark, open_date, close_date, month, days_max=25, days_lost=0):
    locs = prepare_locations(spark.createDataFrame(
        [("00001", D(2001, 3, 20), open_date, close_date, "STD", None, 120)], SDF), P)
    row = (locs.withColumn("month", F.lit(month)).withColumn("days_max", F.lit(days_max))
           .withColumn("days_lost", F.lit(days_lost)).select(final_days().alias("d"), "days_before_open",
                                                             "days_after_close").first())
    return row


def test_open_on_sunday_first_gains_a_day(spark):
    assert D(2001, 4, 1).isoweekday() == 7
    r = _days_for(spark, D(2001, 4, 1), None, D(2001, 4, 1))
    assert r.days_before_open == 0 and r.d == 26


def test_open_on_sunday_mid_month_keeps_one_day_too_many(spark):
    r = _days_for(spark, D(2001, 4, 15), None, D(2001, 4, 1))
    open_days = brute(D(2001, 4, 15), D(2001, 4, 30))
    assert r.days_before_open == 12 and r.d == open_days + 1


def test_close_on_last_day_loses_that_day(spark):
    r = _days_for(spark, D(1990, 1, 1), D(2001, 6, 30), D(2001, 6, 1), days_max=26)
    assert r.days_after_close == 1 and r.d == 25
    r = _days_for(spark, D(1990, 1, 1), D(2001, 9, 30), D(2001, 9, 1), days_max=25)
    assert r.days_after_close == 0 and r.d == 25


def test_days_floor_at_zero_and_null_stays_null(spark):
    assert _days_for(spark, D(1990, 1, 1), None, D(2001, 6, 1), days_max=3, days_lost=10).d == 0
    assert _days_for(spark, D(1990, 1, 1), None, D(2001, 6, 1), days_max=None).d is None


CAL_2001 = [("Monday", m, False, D(2001, m, 1), brute(D(2001, m, 1), month_seq(D(2001, m, 1), 2)[1] - dt.timedelta(1)))
            for m in range(1, 13)]


def test_shutdown_within_one_month(spark):
    proj = spark.createDataFrame([("A", D(2001, 5, 3), D(2001, 5, 10))], PROJ)
    out = shutdown_days_lost(proj, one_calendar(spark, CAL_2001)).collect()
    assert [(r.month, r.days_lost) for r in out] == [(D(2001, 5, 1), brute(D(2001, 5, 3), D(2001, 5, 10)))]


def test_shutdown_over_three_months(spark):
    proj = spark.createDataFrame([("A", D(2001, 5, 20), D(2001, 7, 5))], PROJ)
    out = {r.month: r.days_lost for r in shutdown_days_lost(proj, one_calendar(spark, CAL_2001)).collect()}
    assert out == {D(2001, 5, 1): brute(D(2001, 5, 20), D(2001, 5, 31)),
                   D(2001, 6, 1): CAL_2001[5][4],
                   D(2001, 7, 1): brute(D(2001, 7, 1), D(2001, 7, 5))}


def test_overlapping_projects_take_the_maximum(spark):
    proj = spark.createDataFrame([("A", D(2001, 5, 3), D(2001, 5, 10)), ("A", D(2001, 5, 8), D(2001, 5, 20))], PROJ)
    out = shutdown_days_lost(proj, one_calendar(spark, CAL_2001)).collect()
    assert [r.days_lost for r in out] == [max(brute(D(2001, 5, 3), D(2001, 5, 10)),
                                              brute(D(2001, 5, 8), D(2001, 5, 20)))]


def test_even_median_is_truncated(spark):
    ms = spark.createDataFrame([("A", D(2000, 1, 1), None, 1.0, 24, 1.0), ("B", D(2000, 1, 1), None, 1.0, 27, 1.0)], MS)
    cal = cal_ops.day_details(ms, ForecastParams(as_of=D(2001, 1, 1))).collect()
    assert [(r.jan1_day, r.month_num, r.leap_year, r.days_max) for r in cal] == [("Saturday", 1, True, 25)]


def test_latest_month_per_layout_wins(spark):
    # 1990 and 2001 both start on a Monday (common years): 2001 is used
    ms = spark.createDataFrame([("A", D(1990, 3, 1), None, 1.0, 20, 1.0), ("A", D(2001, 3, 1), None, 1.0, 23, 1.0)], MS)
    cal = cal_ops.day_details(ms, ForecastParams(as_of=D(2002, 1, 1))).collect()
    assert [(r.year_ref, r.days_max) for r in cal] == [(D(2001, 3, 1), 23)]


def test_leap_wednesday_synthesised_from_donors(spark):
    assert D(2014, 1, 1).strftime("%A") == "Wednesday" and D(2015, 1, 1).strftime("%A") == "Thursday"
    ms = history(spark, locs=("A",), first=D(2014, 1, 1), n=24)
    cal = {(r.jan1_day, r.month_num, r.leap_year): r for r in cal_ops.day_details(ms, P).collect()}
    feb = cal[("Wednesday", 2, True)]
    assert feb.days_max == cal[("Wednesday", 2, False)].days_max + 1 and feb.year_ref == D(2014, 2, 1)
    mar = cal[("Wednesday", 3, True)]
    assert mar.days_max == cal[("Thursday", 3, False)].days_max and mar.year_ref == D(2015, 3, 1)
    assert len(cal) == 24 + 12
    synth = cal_ops.synthesised_rows(ms, P).count()
    assert synth == 12


def test_age_rounding_and_bins(spark):
    df = spark.createDataFrame([(3,), (9,), (1200,), (None,), (599,), (-1,)], "age int")
    out = df.select(age_years("age").alias("y")).select("y", age_group("y").alias("g")).collect()
    assert [(r.y, r.g) for r in out] == [(0.2, "<1"), (0.8, "<1"), (100.0, None), (None, None),
                                         (49.9, "30-50"), (-0.1, None)]


def test_backtest_rate_clamps_to_end_rate(spark):
    p = ForecastParams(as_of=D(2001, 12, 31), near_term_start=D(2001, 1, 1), glide_anchor=D(2002, 1, 1))
    pairs = spark.createDataFrame([(D(2001, 4, 20), m) for m in month_seq(D(2001, 3, 1), 6)],
                                  "date_forecast date, month date")
    path = sorted(inflation_path(pairs, p, "backtest").collect(), key=lambda r: r.month)
    monthly = 1.025 ** (1 / 12)
    assert path[0].incremental_time_inflation == 1.0
    for i, r in enumerate(path[1:], start=1):
        assert r.incremental_time_inflation == pytest.approx(monthly ** i, rel=1e-12)


def attach_factors(h, cann, reinv, params, scope):
    """Factors of (loc_num, date_forecast, month) rows by way of location rows and the generator."""
    none = h.sparkSession.createDataFrame([], "loc_num string, month date, days_lost int")
    locs = h.groupBy("loc_num", "date_forecast").agg(
        F.array_sort(F.collect_list(F.struct("month", F.lit(26).alias("days_max")))).alias("open_months"))
    locs = locs.join(factors_by_month(none, cann, reinv, h), ["loc_num"], "left")
    rows = expand_open_months(with_last_known_months(locs, params, scope), ["loc_num", "date_forecast"],
                              {name: factor_at(name, scope) for name in VALUES})
    return round_factors(rows, params)


def test_duplicate_factor_keys_do_not_multiply_rows(spark):
    h = spark.createDataFrame([("A", D(2001, 1, 10), D(2001, 2, 1)), ("B", D(2001, 1, 10), D(2001, 2, 1))],
                              "loc_num string, date_forecast date, month date")
    cann = spark.createDataFrame([("A", D(2001, 2, 1), 0.1), ("A", D(2001, 2, 1), 0.4)], FACT)
    got = sorted((r.loc_num, r.days_lost, r.gocf) for r in
                 attach_factors(h, cann, spark.createDataFrame([], RFACT), P, "forecast").collect())
    assert got == [("A", 0, 0.4), ("B", 0, 0.0)]


def test_factors_unknown_when_no_month_is_within_the_vision(spark):
    h = spark.createDataFrame([("A", D(2001, 1, 10), D(2003, 2, 1))], "loc_num string, date_forecast date, month date")
    cann = spark.createDataFrame([("A", D(2003, 2, 1), 0.4)], FACT)
    r = attach_factors(h, cann, spark.createDataFrame([], RFACT), P, "backtest").first()
    assert (r.gocf, r.reinvestment_factor) == (None, None)


def test_backtest_factor_carried_forward(spark):
    months = month_seq(D(2001, 11, 1), 5)  # 2001-11 .. 2002-03; vision ends 2002-01-10
    h = spark.createDataFrame([("A", D(2001, 1, 10), m) for m in months], "loc_num string, date_forecast date, month date")
    cann = spark.createDataFrame([("A", D(2002, 1, 1), 0.5), ("A", D(2002, 2, 1), 0.9)], FACT)
    reinv = spark.createDataFrame([("A", D(2001, 12, 1), 0.3)], RFACT)
    bt = {r.month: (r.gocf, r.reinvestment_factor) for r in attach_factors(h, cann, reinv, P, "backtest").collect()}
    assert bt[D(2002, 2, 1)] == (0.5, 0.0) and bt[D(2002, 3, 1)] == (0.5, 0.0) and bt[D(2001, 12, 1)] == (0.0, 0.3)
    fc = {r.month: r.gocf for r in attach_factors(h, cann, reinv, P, "forecast").collect()}
    assert fc[D(2002, 2, 1)] == 0.9 and fc[D(2002, 3, 1)] == 0.0


def test_null_increase_keeps_lagged_path(spark):
    p = P.replace(price_change=D(2001, 6, 1))
    df = spark.createDataFrame([(D(2001, 4, 1), D(2001, 7, 1), None), (D(2001, 4, 1), D(2001, 7, 1), 0.02),
                                (D(2001, 4, 1), D(2001, 6, 1), 0.02), (D(2001, 4, 1), D(2001, 5, 1), 0.02),
                                (D(2000, 4, 1), D(2001, 7, 1), 0.02)],
                               "date_forecast date, month date, inc double")
    got = [r[0] for r in df.select(price_change_uplift(p)).collect()]
    assert got == [1.0, 1.02, 1.02, 1.0, 1.0]


def test_shift_by_rows_defaults_to_one(spark):
    months = month_seq(D(2001, 3, 1), 5)
    path = {m: 1.0 + i / 10 for i, m in enumerate(months)}
    df = spark.createDataFrame([("A", [(m, 26, path[m]) for m in months], 2)],
                               "loc_num string, open_months array<struct<month: date, days_max: int, growth: double>>, "
                               "shift_n int")
    got = sorted(expand_open_months(df, ["loc_num"], {"s": growth_at}).select("month", "s").collect())
    assert [r.s for r in got] == [1.0, 1.0, 1.0, 1.1, 1.2]
    got = sorted(expand_open_months(df.withColumn("shift_n", F.lit(0)), ["loc_num"], {"s": growth_at})
                 .select("month", "s").collect())
    assert [r.s for r in got] == [1.0, 1.1, 1.2, 1.3, 1.4]


def test_long_location_numbers_unchanged(spark):
    df = spark.createDataFrame([("123456",), ("42",), (" 7 ",)], "k string")
    assert [r[0] for r in df.select(pad_key("k")).collect()] == ["123456", "00042", "00007"]


def test_csv_with_and_without_null_sentinel(spark, tmp_path):
    for i, close in enumerate(["2002-01-31", "null"]):
        p = tmp_path / f"sdf{i}.csv"
        p.write_text("loc_num,date_forecast,open_date,close_date,location_type_code,price_group\n"
                     f"7,2001-04-20,1999-02-03,{close},OCL,1\n")
        r = read_input(spark, "sales_days_future", str(p), "csv").first()
        assert r.loc_num == "00007" and r.open_date == D(1999, 2, 3) and r.months_predict == 120
        assert r.close_date == (D(2002, 1, 31) if close != "null" else D(2200, 1, 1))


def _pipeline_inputs(spark, dates=(D(2016, 6, 20),), projects=()):
    sdf = spark.createDataFrame([("A", d, D(2010, 1, 1), None, "OCL", 1, 120) for d in dates], SDF)
    return dict(
        sales_days_future=sdf, monthly_sales=history(spark),
        reinvestment_projects=spark.createDataFrame(list(projects), PROJ),
        cannibalization_factors=spark.createDataFrame([], FACT),
        reinvestment_factors=spark.createDataFrame([], RFACT))


def test_reversed_project_raises(spark):
    inp = _pipeline_inputs(spark, projects=[("A", D(2016, 9, 10), D(2016, 9, 1))])
    run = forecast_sales_days(**inp, params=P)
    run.output.write.format("noop").mode("overwrite").save()
    with pytest.raises(DataQualityError, match="L2"):
        run.check()


def test_two_forecast_dates_do_not_fan_out(spark):
    one = forecast_sales_days(**_pipeline_inputs(spark, dates=(D(2016, 6, 20),)), params=P).output.count()
    two = forecast_sales_days(**_pipeline_inputs(spark, dates=(D(2016, 7, 20),)), params=P).output.count()
    run = forecast_sales_days(**_pipeline_inputs(spark, dates=(D(2016, 6, 20), D(2016, 7, 20))), params=P)
    assert run.output.count() == one + two
    run.check()


def test_horizon_counts_down_like_sequence(spark):
    sdf = spark.createDataFrame([("A", D(2001, 4, 10), D(1990, 1, 1), None, "STD", None, 0)], SDF)
    months = sorted(r.month for r in expand_horizon(prepare_locations(sdf, P)).collect())
    # sequence(-1, -1) = [-1]: only the previous month
    assert months == [D(2001, 3, 1)]


def test_rows_without_key_or_date_are_rejected(spark):
    from daycast.operators.checks import rejects
    sdf = spark.createDataFrame([(None, D(2016, 6, 20), D(2010, 1, 1), None, "STD", None, 120),
                                 ("A", None, D(2010, 1, 1), None, "STD", None, 120),
                                 ("B", D(2016, 6, 20), None, None, "STD", None, 120),
                                 ("C", D(2016, 6, 20), D(2010, 1, 1), None, "STD", None, 120)], SDF)
    assert sorted(str(r.loc_num) for r in rejects(sdf).collect()) == ["A", "B", "None"]
    inp = _pipeline_inputs(spark)
    inp["sales_days_future"] = sdf
    run = forecast_sales_days(**inp, params=P)
    with pytest.raises(DataQualityError, match="C1"):
        run.check()


def test_round_factors_option_and_top_age_bin(spark):
    h = spark.createDataFrame([("A", D(2001, 1, 10), D(2001, 2, 1))], "loc_num string, date_forecast date, month date")
    cann = spark.createDataFrame([("A", D(2001, 2, 1), 0.1234567890123456789)], FACT)
    reinv = spark.createDataFrame([("A", D(2001, 2, 1), 0.026)], RFACT)
    r = attach_factors(h, cann, reinv, P.replace(round_factors=True), "forecast").first()
    assert r.reinvestment_factor == 0.03 and r.gocf == round(0.1234567890123456789, 15)
    r = attach_factors(h, cann, reinv, P, "forecast").first()
    assert r.reinvestment_factor == 0.026
    y = spark.createDataFrame([(600,), (1199,)], "age int").select(age_years("age").alias("y"))
    assert [r[0] for r in y.select(age_group("y")).collect()] == ["50+", "50+"]  # 99.9 years is in [50, 100)

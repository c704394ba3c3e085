"""Checks that ride on the write, sorted and per-date sinks, calendars without gaps and by forecast date, rejected rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from daycast.functions.dates import CALENDAR_KEYS
from daycast.operators import calendar as cal_ops
from daycast.operators.checks import DataQualityError
from daycast.operators.joins import join_few, join_small
from daycast.params import BACKTEST
from daycast.plans.pipeline import forecast_sales_days, plan_forecast
from daycast.sources import fixtures, io

SF = "/root/testdata/sf0.001"
P = fixtures.FIXTURE_PARAMS
D1, D2 = fixtures.BACKTEST_DATES


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("inputs")
    out = {}
    for name, df in fixtures.inputs(spark, SF, backtest=True).items():
        df.write.parquet(str(base / name))
        out[name] = spark.read.parquet(str(base / name))
    return out


def run_of(stored, params=P, scope=BACKTEST, **changes):
    on_invalid = changes.pop("on_invalid", "stop")
    with_checks = changes.pop("with_checks", True)
    i = {**stored, **changes}
    return forecast_sales_days(i["sales_days_future"], i["monthly_sales"], i["reinvestment_projects"], i["cannibalization_factors"],
                               i["reinvestment_factors"], params, scope, i["price_increases"], with_checks, on_invalid)


def jobs(spark, name, action):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(name))


def rows_of(df):
    return sorted(tuple(r) for r in df.select("loc_num", "date_forecast", "month", "days", F.round("inflation_factor", 9)).collect())


# --- checks on the one action

def test_checks_ride_on_the_write(spark, stored, tmp_path):
    run, plain = run_of(stored), run_of(stored, with_checks=False)
    keys = jobs(spark, "keys", run.key_metrics)
    observed = jobs(spark, "observed", lambda: run.write(str(tmp_path / "a")))
    unobserved = jobs(spark, "unobserved", lambda: plain.write(str(tmp_path / "b")))
    assert keys > 0 and observed == unobserved      # the checks add no job to the write
    assert jobs(spark, "after", run.check) == 0     # nor afterwards
    out = spark.read.parquet(str(tmp_path / "a"))
    m = run.metrics()
    assert m["inflation_max"] == out.agg(F.max("inflation_factor")).first()[0]
    assert m["calendar_missing"] == run.uncovered.agg(F.sum("location_months")).first()[0] > 0
    assert plain.metrics() == {}


def test_checks_without_a_write_run_the_forecast_once(spark, stored):
    run = run_of(stored)
    assert jobs(spark, "first", run.check) > 0
    assert jobs(spark, "second", run.metrics) == 0


def test_observed_values_are_those_of_plain_aggregates(spark, stored):
    from daycast.operators import checks
    bad = stored["sales_days_future"].unionByName(
        stored["sales_days_future"].limit(1).withColumns({"loc_num": F.lit("x"), "location_type_code": F.lit(None).cast("string"),
                                                          "open_date": F.lit(None).cast("date")}))
    gap = stored["reinvestment_projects"].withColumn("reopen", F.when(F.col("loc_num") > "00002", F.col("reopen")))
    run = run_of(stored, sales_days_future=bad, reinvestment_projects=gap)
    m = run.metrics()
    assert (m["type_code_missing"], m["open_date_missing"], m["required_missing"]) == (1, 1, 0)
    assert m["project_dates_invalid"] == gap.agg(*checks.project_metrics()).first()[0] > 0
    with pytest.raises(DataQualityError, match="L1.*L2.*L3"):
        run.check()


def test_metrics_of_branches_left_out_are_not_lost(stored):
    none_valid = stored["reinvestment_projects"].withColumn("reopen", F.lit(None).cast("date"))
    with pytest.raises(DataQualityError, match="L2"):
        run_of(stored, reinvestment_projects=none_valid).check()
    none_open = stored["sales_days_future"].withColumn("open_date", F.lit(None).cast("date"))
    with pytest.raises(DataQualityError, match=f"{none_open.count()} location rows miss an open date"):
        run_of(stored, sales_days_future=none_open).check()


def test_empty_inputs_pass_their_checks(stored):
    nothing = {k: stored[k].limit(0) for k in ("reinvestment_projects", "cannibalization_factors", "reinvestment_factors")}
    run_of(stored, **nothing).check()
    empty = run_of(stored, sales_days_future=stored["sales_days_future"].limit(0))
    empty.check()
    assert empty.output.count() == 0


# --- sinks

def test_one_date_is_rewritten_and_a_failed_check_changes_nothing(spark, stored, tmp_path):
    path = str(tmp_path / "out")
    sdf = stored["sales_days_future"]
    no_open = sdf.limit(1).withColumns({"loc_num": F.lit("x"), "open_date": F.lit(None).cast("date"), "date_forecast": F.lit(D1)})
    run_of(stored, sales_days_future=sdf.unionByName(no_open), on_invalid="reject").write(path)
    before = rows_of(spark.read.parquet(path))
    files = {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "out" / f"date_forecast={D1}").iterdir()}
    one = stored["sales_days_future"].where(F.col("date_forecast") == F.lit(D2))

    with pytest.raises(DataQualityError, match="L5"):
        run_of(stored, P.replace(inflation_factor_max=0.5), sales_days_future=one).write(path, replace="dates")
    assert rows_of(spark.read.parquet(path)) == before

    late = one.where("loc_num = '00001'").withColumn("open_date", F.lit(None).cast("date")).withColumn("loc_num", F.lit("y"))
    run_of(stored, P.replace(long_run_inflation=1.03), sales_days_future=one.unionByName(late), on_invalid="reject").write(path, replace="dates")
    after = rows_of(spark.read.parquet(path))
    expected = [r for r in before if r[1] == D1] + rows_of(run_of(stored, P.replace(long_run_inflation=1.03), sales_days_future=one).output)
    assert after == sorted(expected) and after != before
    # The other date's files and rejects are those of the first run.
    assert files == {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "out" / f"date_forecast={D1}").iterdir()}
    rejects = spark.read.parquet(f"{path}.rejects/sales_days_future")
    assert sorted((r.loc_num, r.date_forecast) for r in rejects.collect()) == [("x", D1), ("y", D2)]
    # A run of that date without rejects takes them away again.
    run_of(stored, sales_days_future=one, on_invalid="reject").write(path, replace="dates")
    assert [r.loc_num for r in spark.read.parquet(f"{path}.rejects/sales_days_future").collect()] == ["x"]
    assert rows_of(spark.read.parquet(path)) == before
    # A date for which nothing is forecast any more goes.
    never = one.withColumn("open_date", F.lit(dt.date(2100, 1, 1)))
    run_of(stored, sales_days_future=never, on_invalid="reject").write(path, replace="dates")
    assert rows_of(spark.read.parquet(path)) == [r for r in before if r[1] == D1]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith("out")) == []
    assert not [p for p in tmp_path.iterdir() if p.name.endswith((".old", ".unsorted")) or ".rejects." in p.name]


class FailingMoves:
    """A file system whose moves fail from the n-th on, until it is told otherwise."""

    def __init__(self, fs, n):
        self.fs, self.left = fs, n

    def rename(self, a, b):
        self.left -= 1
        return False if self.left == 0 else self.fs.rename(a, b)

    def __getattr__(self, name):
        return getattr(self.fs, name)


@pytest.mark.parametrize("fails", [1, 2, 3, 4])
def test_partitions_are_moved_back_when_a_move_fails(spark, tmp_path, monkeypatch, fails):
    there, staging = tmp_path / "t", tmp_path / "s"
    for folder, name, text in ((there, "d=1", "old1"), (there, "d=2", "old2"), (staging, "d=1", "new1"), (staging, "d=2", "new2")):
        (folder / name).mkdir(parents=True)
        (folder / name / "part").write_text(text)
    read = lambda: [(there / d / "part").read_text() for d in ("d=1", "d=2")]
    files = io._files
    monkeypatch.setattr(io, "_files", lambda spark, path: (FailingMoves(files(spark, path)[0], fails), files(spark, path)[1]))
    with pytest.raises(OSError, match="could not move"):
        io.publish_partitions(spark, str(staging), str(there))
    assert read() == ["old1", "old2"] and (staging / "d=1" / "part").read_text() == "new1"
    monkeypatch.undo()
    io.publish_partitions(spark, str(staging), str(there), ["d=1"])
    assert read() == ["new1", "old2"] and not staging.exists()


def test_files_form_one_order_and_a_hot_location_is_split(spark, stored, tmp_path):
    sdf = stored["sales_days_future"]
    hot = sdf.where("loc_num = '00001'").limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(60))).alias("d")) \
        .withColumn("date_forecast", F.date_add(F.lit(D2), F.col("d").cast("int"))).drop("d")
    run = run_of(stored, sales_days_future=sdf.unionByName(hot))
    path = str(tmp_path / "sorted")
    run.write(path, sort=True, files=8)
    back = spark.read.parquet(path)
    got = io.with_file_positions(back).orderBy("position").select("loc_num", "month", "date_forecast", "position").collect()
    assert [tuple(r)[:3] for r in got] == sorted(tuple(r)[:3] for r in got) and [r.position for r in got] == list(range(1, len(got) + 1))
    sizes = [r.n for r in back.groupBy(F.col("_metadata.file_name")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < len(got) / 3
    assert sum(r.loc_num == "00001" for r in got) > len(got) / 3
    with pytest.raises(ValueError):
        run.write(path, sort=True, replace="dates")


# --- calendars

def sales_days(first, length):
    return sum((first + dt.timedelta(k)).isoweekday() != 7 for k in range(length))


def test_stand_ins_have_the_same_selling_days(spark):
    months = [dt.date(y, m, 1) for y in range(1999, 2013) for m in range(1, 13)]
    rows = spark.createDataFrame([(m,) for m in months], "month date").select("month", F.explode(cal_ops.equal_layouts()).alias("l"))
    length = {m: ((m.replace(day=28) + dt.timedelta(4)).replace(day=1) - m).days for m in months}
    layout = {((m.replace(month=1)).strftime("%A"), m.month, length[dt.date(m.year, 2, 1)] == 29): m for m in months}
    seen = set()
    for r in rows.collect():
        target = layout.get((r.l.jan1_day, r.l.month_num, r.l.leap_year))
        if target is not None:
            assert length[target] == length[r.month] and sales_days(target, length[target]) == sales_days(r.month, length[r.month])
            assert (r.l.priority == 4) == (target.weekday() != r.month.weekday())
            seen.add((r.l.jan1_day, r.l.month_num, r.l.leap_year))
    assert seen == set(layout)


def test_synthesised_calendar_leaves_no_gap(spark, stored):
    p = P.replace(calendar_gap="synthesise")
    full = cal_ops.day_details(stored["monthly_sales"], p)
    assert full.count() == cal_ops.MAX_CALENDAR_ROWS
    # What the history or a leap donor has stays as it was.
    own = cal_ops.day_details(stored["monthly_sales"], P)
    assert own.join(full, [*CALENDAR_KEYS, "year_ref", "days_max"], "left_anti").count() == 0
    run = run_of(stored, p)
    assert run.uncovered.count() == 0 and run.metrics()["calendar_missing"] == 0
    months = {r.month for r in run.output.where(F.col("date_forecast") == F.lit(D2)).select("month").distinct().collect()}
    assert months == {dt.date(2001 + (3 + k) // 12, (3 + k) % 12 + 1, 1) for k in range(120)}


def test_a_forecast_date_sees_no_later_month(spark, stored):
    p = P.replace(calendar_version="forecast_date")
    ms = stored["monthly_sales"]
    # Known from 16 February 2001: after the first forecast date, before the second.
    odd = ms.limit(1).select(F.lit("zz").alias("loc_num"), F.lit(dt.date(2001, 1, 1)).alias("month"), "open_date", "sales",
                             F.lit(3).alias("days"), "inflation_factor_ending")
    late = ms.where(F.col("month") < F.lit(dt.date(2000, 12, 1))).unionByName(odd)
    early = ms.where(F.col("month") < F.lit(dt.date(2000, 12, 1)))
    a, b = (rows_of(run_of(stored, p, monthly_sales=x).output) for x in (early, late))
    assert [r for r in a if r[1] == D1] == [r for r in b if r[1] == D1] and [r for r in a if r[1] == D2] != [r for r in b if r[1] == D2]
    # As a run of its own per date.
    for d in (D1, D2):
        alone = run_of(stored, P.replace(as_of=d), monthly_sales=late, sales_days_future=stored["sales_days_future"].where(F.col("date_forecast") == F.lit(d)))
        assert rows_of(alone.output) == [r for r in b if r[1] == d]


# --- rejected rows and cleansing

def test_malformed_lines_are_set_aside(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("loc_num,shutdown,reopen\n1,2001-01-02,2001-02-03\n2,2001-01-02\n3,2001-01-02,2001-02-03,9\n,2001-01-02,null\n")
    (folder / "b.csv").write_text('loc_num,shutdown,reopen\n4,soon,2001-02-03\n" 5 ",null,\n6,2001-01-02,"31/12,01"\n')
    good, bad = io.read_checked(spark, "reinvestment_projects", str(folder))
    assert sorted((r.loc_num, str(r.shutdown), str(r.reopen)) for r in good.collect()) == \
        [("00001", "2001-01-02", "2001-02-03"), ("00005", "None", "None")]
    assert sorted((r.reason, r.line) for r in bad.collect()) == [
        ("fields", "2,2001-01-02"), ("fields", "3,2001-01-02,2001-02-03,9"), ("loc_num: missing", ",2001-01-02,null"),
        ("reopen: no date", "6,2001-01-02,31/12,01"), ("shutdown: no date", "4,soon,2001-02-03")]
    assert good.count() == 2 and good.select("loc_num").count() == 2 and bad.count() == 5      # whatever columns are read
    with pytest.raises(ValueError, match="month"):
        io.read_checked(spark, "cannibalization_factors", str(folder))


def test_columns_of_any_table_are_cleansed(spark):
    raw = spark.createDataFrame([("7", "2001-01-02", "x"), (" 123456", "null", None), (None, "n/a", "")], "k string, d string, other string")
    got = io.cleanse_columns(raw, ["k"], ["d"], width=4).collect()
    assert [tuple(r) for r in got] == [("0007", dt.date(2001, 1, 2), "x"), ("123456", None, None), (None, None, "")]
    with pytest.raises(Exception, match="not a date: n/a"):
        io.cleanse_columns(raw, ["k"], ["d"], bad_dates="raise").collect()
    with pytest.raises(ValueError, match="dd"):
        io.cleanse_columns(raw, ["k"], ["dd"])
    with pytest.raises(ValueError, match="both"):
        io.cleanse_columns(raw, ["k"], ["k"])


# --- plans

def test_small_tables_are_counted_before_they_are_broadcast(spark, stored):
    locs = spark.createDataFrame([(f"l{k}", D1, k % 7) for k in range(50)], "loc_num string, date_forecast date, key int")
    few = spark.createDataFrame([(k, k * 10) for k in range(6)], "key int, v int")
    expected = sorted((f"l{k}", (k % 7) * 10 if k % 7 < 6 else None) for k in range(50))
    for df in (join_small(locs, few, ["key"], P), join_small(locs, few, ["key"], P.replace(broadcast_rows=0)), join_few(locs, few, ["key"]),
               join_small(locs, few, ["key"], P.replace(broadcast_rows=6))):
        assert sorted((r.loc_num, r.v) for r in df.collect()) == expected
    with pytest.raises(Exception, match="more than 5 rows"):
        join_small(locs, few, ["key"], P.replace(broadcast_rows=5)).collect()
    assert rows_of(run_of(stored).output) == rows_of(run_of(stored, P.replace(broadcast_rows=0)).output)


@pytest.mark.parametrize("params", [P, P.replace(price_change=dt.date(2000, 12, 10)), P.replace(calendar_version="forecast_date")])
def test_one_calendar_and_few_subqueries(stored, params):
    i = stored
    df = plan_forecast(i["sales_days_future"], i["monthly_sales"], i["reinvestment_projects"], i["cannibalization_factors"],
                       i["reinvestment_factors"], params, BACKTEST, i["price_increases"])["output"]
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Subquery", plan)) <= 10, plan
    final = plan.split("== Initial Plan ==")[0]
    medians = re.findall(r"functions=\[median\(", final)
    assert len(medians) <= 2, final      # partial and final aggregate of the one calendar


def test_rewritten_date_aggregates_its_history_once(spark, tmp_path, monkeypatch):
    """Neither of the two runs reads `lineitem`; the history made of it is stored before them."""
    from daycast.plans import queries

    spark.range(1, 21).select(F.col("id").alias("s_suppkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    spark.range(3).select(F.col("id").alias("r_regionkey")).write.parquet(str(tmp_path / "region.parquet"))
    month = F.add_months(F.lit(dt.date(1995, 1, 10)), (F.col("id") % 84).cast("int"))
    spark.range(20 * 84).select((F.floor(F.col("id") / 84) + 1).alias("l_suppkey"), month.alias("l_shipdate"),
                                F.lit(10.0).alias("l_extendedprice"), F.lit(0.1).alias("l_discount")).write.parquet(str(tmp_path / "lineitem.parquet"))
    read, write = [], io.write_output
    monkeypatch.setattr(io, "write_output", lambda df, *args, **kw: (read.append(df.inputFiles()), write(df, *args, **kw)))
    got = queries.rewritten_date(spark, str(tmp_path))
    assert len(read) == 2 and not [f for files in read for f in files if "/lineitem.parquet/" in f]
    first, last = (queries._run(spark, str(tmp_path), P.replace(closing_vision=v), BACKTEST, d).output for v, d in ((True, D1), (False, D2)))
    assert rows_of(got.select(first.columns)) == sorted(rows_of(queries.round_doubles(first)) + rows_of(queries.round_doubles(last)))

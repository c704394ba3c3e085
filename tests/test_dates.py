"""Scalar date functions (J1-J10, B11) against plain-Python definitions."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daycast.functions import dates as fd

EPOCH_RANGE = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2200, 12, 31))


def brute_sales_days(a, b):
    return sum(1 for i in range((b - a).days + 1) if (a + dt.timedelta(i)).isoweekday() != 7)


def months_exact(a, b):
    return (b.year - a.year) * 12 + b.month - a.month


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(EPOCH_RANGE, st.integers(0, 800)), min_size=300, max_size=300))
def test_sales_days_closed_form_matches_enumeration(spark, pairs):
    rows = [(a, a + dt.timedelta(n)) for a, n in pairs]
    df = spark.createDataFrame(rows, "a date, b date")
    got = [r[0] for r in df.select(fd.sales_days_between("a", "b")).collect()]
    assert got == [brute_sales_days(a, b) for a, b in rows]


def test_sales_days_additive_and_null(spark):
    df = spark.createDataFrame([(dt.date(1969, 12, 20), dt.date(1970, 1, 10), dt.date(1970, 2, 3))],
                               "a date, m date, b date")
    r = df.select(
        fd.sales_days_between("a", "b").alias("whole"),
        (fd.sales_days_between("a", "m") + fd.sales_days_between(F.date_add("m", 1), "b")).alias("parts"),
        fd.sales_days_between(F.lit(None).cast("date"), "b").alias("null"),
    ).first()
    assert r.whole == r.parts == brute_sales_days(dt.date(1969, 12, 20), dt.date(1970, 2, 3))
    assert r.null is None


def test_month_functions(spark):
    rows = [(dt.date(2000, 2, 29), dt.date(1999, 11, 3)), (dt.date(1900, 3, 1), dt.date(2100, 12, 31)),
            (dt.date(2024, 1, 31), dt.date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "a date, b date")
    out = df.select(fd.months_between_exact("a", "b").alias("m"), fd.weekday_name("a").alias("w"),
                    fd.is_leap_year("a").alias("leap"), fd.month_floor("a").alias("mf"),
                    fd.year_floor("a").alias("yf"), *fd.calendar_key("a")).collect()
    for (a, b), r in zip(rows, out):
        assert r.m == months_exact(a, b)
        assert r.w == a.strftime("%A")
        assert r.leap == ((a.year % 4 == 0) and (a.year % 100 != 0 or a.year % 400 == 0))
        assert r.mf == a.replace(day=1) and r.yf == dt.date(a.year, 1, 1)
        assert r.jan1_day == dt.date(a.year, 1, 1).strftime("%A") and r.month_num == a.month


def test_reported_month_and_known_actuals(spark):
    df = spark.createDataFrame([(dt.date(2001, 4, 15),), (dt.date(2001, 4, 16),), (dt.date(2001, 1, 10),)], "d date")
    got = [r[0] for r in df.select(fd.reported_month("d", 16)).collect()]
    assert got == [dt.date(2001, 2, 1), dt.date(2001, 3, 1), dt.date(2000, 11, 1)]
    ms = spark.createDataFrame([(dt.date(2001, 11, 1),), (dt.date(2001, 12, 1),)], "m date")
    kept = [r[0] for r in ms.where(fd.known_actuals("m", dt.date(2001, 12, 16), 16)).collect()]
    assert kept == [dt.date(2001, 11, 1)]

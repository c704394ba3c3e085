"""Deterministic input tables derived from the benchmark data (FIXTURES.md 2).

The five domain tables do not exist in the benchmark data set, so they are
derived from `supplier` (one location per supplier) and `lineitem` (one
month of history per supplier and ship month).  All work here is ordinary
Spark: scans with pruned columns, an aggregate for the monthly history and
small generators for the factor tables, so every query built on top of it
grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.functions.dates import month_floor, sales_days_between
from daycast.params import ForecastParams
from daycast.sources.io import pad_key

# Fixed values of the fixture derivation (FIXTURES.md 2 and 3).
OPEN_BASE = dt.date(1985, 1, 1)
FORECAST_DATE_EVEN = dt.date(2001, 4, 10)
FORECAST_DATE_ODD = dt.date(2001, 4, 20)
BACKTEST_DATES = (dt.date(2000, 10, 5), dt.date(2001, 4, 20))
FIXTURE_PARAMS = ForecastParams(
    as_of=dt.date(2001, 12, 31),
    near_term_start=dt.date(2001, 7, 1),
    glide_anchor=dt.date(2002, 3, 1),
    price_change=None,
)
PRICE_CHANGE_PARAMS = FIXTURE_PARAMS.replace(price_change=dt.date(2001, 6, 1))
# Known from 2001-04-15 on: between the two forecast dates.
MID_MONTH_CHANGE_PARAMS = FIXTURE_PARAMS.replace(price_change=dt.date(2001, 7, 14))
# Known from 2000-09-11 on and realized on 2001-01-16: around the first back-test date.
BACKTEST_CHANGE_PARAMS = FIXTURE_PARAMS.replace(price_change=dt.date(2000, 12, 10))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _plus_days(base: dt.date, days: Column) -> Column:
    return F.date_add(F.lit(base), days.cast("int"))


def _open_date(key: Column) -> Column:
    return _plus_days(OPEN_BASE, (key * 97) % 7000)


def raw_sales_days_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location table in its raw text form: unpadded keys, 'null' close dates."""
    sdf = sales_days_future(spark, sf_dir, raw=True)
    return sdf.select(
        F.col("s_suppkey").cast("string").alias("loc_num"),
        F.col("date_forecast").cast("string").alias("date_forecast"),
        F.col("open_date").cast("string").alias("open_date"),
        F.coalesce(F.col("close_date").cast("string"), F.lit("null")).alias("close_date"),
        "location_type_code",
        F.col("price_group").cast("string").alias("price_group"),
    )


def faulty_sales_days_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw location table with faults for the checks to find: open dates
    in another format, empty forecast dates, close dates that are no date."""
    k = F.col("loc_num").cast("long")
    return (raw_sales_days_future(spark, sf_dir)
            .withColumn("open_date", F.when(k % 3 == 1, "31/12/1990").otherwise(F.col("open_date")))
            .withColumn("date_forecast", F.when(k % 5 == 4, "").otherwise(F.col("date_forecast")))
            .withColumn("close_date", F.when(k % 4 == 2, "never").otherwise(F.col("close_date"))))


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw location table as CSV lines, some cut short, some with a field too many, a text for a date or no key."""
    k = F.col("loc_num").cast("long")
    raw = raw_sales_days_future(spark, sf_dir).withColumn("k", k)
    short = F.concat_ws(",", "loc_num", "date_forecast", "open_date")
    whole = F.concat_ws(",", F.when(F.col("k") % 17 == 4, "").otherwise(F.col("loc_num")), "date_forecast",
                        F.when(F.col("k") % 13 == 5, "31/12/1990").otherwise(F.col("open_date")),
                        "close_date", "location_type_code", "price_group")
    line = F.when(F.col("k") % 11 == 3, short).when(F.col("k") % 7 == 2, F.concat(whole, F.lit(",extra"))).otherwise(whole)
    return raw.select(line.alias("value"))


RAW_COLUMNS = ("loc_num", "date_forecast", "open_date", "close_date", "location_type_code", "price_group")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw text: unpadded keys, empty, 'null' and unreadable dates."""
    k = F.col("o_orderkey")
    date = F.col("o_orderdate").cast("date").cast("string")
    return _read(spark, sf_dir, "orders").select(
        F.concat(F.lit(" "), k.cast("string")).alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"),
        F.when(k % 5 == 0, "null").when(k % 7 == 0, "").when(k % 9 == 0, F.lit("n/a")).otherwise(date).alias("o_orderdate"),
        "o_orderstatus")


def sales_days_future(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    k = F.col("s_suppkey")
    out = _read(spark, sf_dir, "supplier").select(
        k,
        pad_key(k).alias("loc_num"),
        F.when(k % 2 == 0, F.lit(FORECAST_DATE_EVEN)).otherwise(F.lit(FORECAST_DATE_ODD)).alias("date_forecast"),
        _open_date(k).alias("open_date"),
        F.when(k % 10 == 3, _plus_days(dt.date(2001, 9, 15), (k * 31) % 400)).alias("close_date"),
        F.when(k % 3 == 0, "OCL").when(k % 3 == 1, "STD").otherwise("MALL").alias("location_type_code"),
        (k % 4).cast("string").alias("price_group"),
        F.lit(120).alias("months_predict"),
    )
    return out if raw else out.drop("s_suppkey")


def backtest_sales_days_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location table once per back-test forecast date (a union, no cross join)."""
    base = sales_days_future(spark, sf_dir)
    parts = [base.withColumn("date_forecast", F.lit(d)) for d in BACKTEST_DATES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    k = F.col("l_suppkey")
    per_month = (li.select(k, month_floor(F.col("l_shipdate").cast("date")).alias("month"),
                           (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
                 .groupBy("l_suppkey", "month").agg(F.sum("rev").alias("sales")))
    m = F.col("month")
    index = (F.year(m) - 1995) * 12 + F.month(m) - 1
    return (per_month
            .where(m >= month_floor(_open_date(k)))
            .where(~((k % 7 == 0) & (F.year(m) == 2001) & F.month(m).isin(2, 3)))
            .select(
                pad_key(k).alias("loc_num"),
                m,
                _open_date(k).alias("open_date"),
                "sales",
                (sales_days_between(m, F.last_day(m)) - ((k * 7 + F.month(m)) % 3).cast("int"))
                .cast("int").alias("days"),
                F.round(F.lit(1.0) + F.lit(0.002) * index + F.lit(0.001) * (k % 5), 6)
                .alias("inflation_factor_ending"),
            ))


def reinvestment_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = _read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    first = sup.where(k % 4 == 1).select(
        pad_key(k).alias("loc_num"),
        _plus_days(dt.date(2001, 8, 1), (k * 13) % 200).alias("shutdown"),
        (5 + (k * 29) % 120).alias("len"))
    second = sup.where(k % 8 == 1).select(
        pad_key(k).alias("loc_num"),
        _plus_days(dt.date(2001, 8, 10), (k * 13) % 200).alias("shutdown"),
        (3 + (k * 11) % 40).alias("len"))
    both = first.unionByName(second)
    return both.select("loc_num", "shutdown", F.date_add("shutdown", F.col("len").cast("int")).alias("reopen"))


def _monthly_factor(spark: SparkSession, sf_dir: str, where_mod: int, where_rem: int,
                    first_month: dt.date, n_months: int, value: Column, name: str) -> DataFrame:
    sup = _read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return (sup.where(k % where_mod == where_rem)
            .select(k, F.explode(F.sequence(F.lit(0), F.lit(n_months - 1))).alias("k"))
            .select(pad_key(k).alias("loc_num"),
                    F.add_months(F.lit(first_month), F.col("k")).alias("month"),
                    value.alias(name)))


def cannibalization_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.round(F.lit(0.0) - F.lit(0.01) * ((F.col("s_suppkey") + F.col("k")) % 9), 4)
    return _monthly_factor(spark, sf_dir, 5, 2, dt.date(2001, 4, 1), 24, v, "gocf")


def reinvestment_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.round(F.lit(0.005) * ((F.col("s_suppkey") + 2 * F.col("k")) % 7), 4)
    return _monthly_factor(spark, sf_dir, 4, 1, dt.date(2001, 9, 1), 18, v, "factor")


def price_increases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price increase per price group, derived from `region`: groups 0, 1 and 2
    get 0.02, 0.03 and 0.0; group 3 has no row on purpose."""
    r = F.col("r_regionkey")
    return (_read(spark, sf_dir, "region").where(r < 3)
            .select(r.cast("string").alias("price_group"),
                    F.when(r == 0, 0.02).when(r == 1, 0.03).otherwise(0.0).alias("inc")))


def inputs(spark: SparkSession, sf_dir: str, backtest: bool = False) -> dict[str, DataFrame]:
    """All five inputs (plus price increases) as lazy DataFrames."""
    return {
        "sales_days_future": (backtest_sales_days_future(spark, sf_dir) if backtest
                              else sales_days_future(spark, sf_dir)),
        "monthly_sales": monthly_sales(spark, sf_dir),
        "reinvestment_projects": reinvestment_projects(spark, sf_dir),
        "cannibalization_factors": cannibalization_factors(spark, sf_dir),
        "reinvestment_factors": reinvestment_factors(spark, sf_dir),
        "price_increases": price_increases(spark, sf_dir),
    }

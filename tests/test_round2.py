"""Key checks, CSV output, publishing and raw dates."""

import pytest
from pyspark.sql import functions as F

from daycast.operators.checks import DataQualityError
from daycast.plans.pipeline import forecast_sales_days
from daycast.plans.queries import P
from daycast.sources import fixtures
from daycast.sources.io import read_input, unparsed_dates

SF = "/root/testdata/sf0.001"


def tables(spark):
    return [getattr(fixtures, n)(spark, SF) for n in
            ("sales_days_future", "monthly_sales", "reinvestment_projects", "cannibalization_factors", "reinvestment_factors")]


def test_doubled_factor_table_fails(spark):
    t = tables(spark)
    t[3] = t[3].unionByName(t[3])
    with pytest.raises(DataQualityError, match="cannibalization"):
        forecast_sales_days(*t, P).check()


def test_csv_write_is_checked_and_replaces(spark, tmp_path):
    run = forecast_sales_days(*tables(spark), P)
    for _ in range(2):      # the second write replaces the first
        run.write(str(tmp_path / "out"), fmt="csv")
    n = spark.read.option("header", True).csv(str(tmp_path / "out")).count()
    assert n == run.output.count() > 0
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]


def test_invalid_rows_stop_or_are_set_aside(spark, tmp_path):
    t = tables(spark)
    t[0] = t[0].unionByName(t[0].limit(1).withColumn("loc_num", F.lit("x")).withColumn("open_date", F.lit(None).cast("date")))
    t[2] = t[2].unionByName(t[2].limit(1).withColumns({"shutdown": F.col("reopen"), "reopen": F.col("shutdown")}))
    with pytest.raises(DataQualityError, match="L1.*L2"):
        forecast_sales_days(*t, P).check()
    run = forecast_sales_days(*t, P, on_invalid="reject")
    run.write(str(tmp_path / "out"))
    assert [r.loc_num for r in spark.read.parquet(str(tmp_path / "out.rejects/sales_days_future")).collect()] == ["x"]
    assert spark.read.parquet(str(tmp_path / "out.rejects/reinvestment_projects")).count() == 1
    whole = forecast_sales_days(*tables(spark), P)
    assert spark.read.parquet(str(tmp_path / "out")).count() == whole.output.count()


def test_text_that_is_no_date_stops_the_read(spark, tmp_path):
    path = str(tmp_path / "projects")
    spark.createDataFrame([("1", "2020-01-01", "null"), ("2", "31/12/2001", "")], "loc_num string, shutdown string, reopen string") \
        .write.option("header", True).csv(path)
    with pytest.raises(Exception, match="not a date: 31/12/2001"):
        read_input(spark, "reinvestment_projects", path).collect()
    lenient = read_input(spark, "reinvestment_projects", path, bad_dates="null").collect()
    assert sorted((r.loc_num, r.shutdown is None, r.reopen) for r in lenient) == [("00001", False, None), ("00002", True, None)]


def test_unparsed_dates_are_counted(spark):
    raw = spark.createDataFrame([("1", "2020-01-01", "null"), ("2", "31/12/2001", "31/12/2001"), ("3", "", None)],
                                "loc_num string, open_date string, close_date string")
    assert unparsed_dates("sales_days_future", raw).first().asDict() == {"open_date": 1, "close_date": 1}

"""CSV/Parquet sources and sinks (A1-A4) and the named registry."""

from pyspark.sql import functions as F

from daycast.sources import fixtures
from daycast.sources.io import load_inputs, preview, write_output

SF = "/root/testdata/sf0.001"


def test_csv_registry_round_trip(spark, tmp_path):
    inp = fixtures.inputs(spark, SF)
    raw = fixtures.raw_sales_days_future(spark, SF)
    raw.write.option("header", True).csv(str(tmp_path / "sdf"))
    paths = {"sales_days_future": str(tmp_path / "sdf")}
    for name in ("monthly_sales", "reinvestment_projects"):
        inp[name].write.option("header", True).csv(str(tmp_path / name))
        paths[name] = str(tmp_path / name)
    frames = load_inputs(spark, paths, "csv")
    assert sorted(frames) == sorted(paths)
    got = {r.loc_num: r for r in frames["sales_days_future"].collect()}
    want = {r.loc_num: r for r in inp["sales_days_future"].collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert got[k].open_date == r.open_date and got[k].date_forecast == r.date_forecast
    ms = frames["monthly_sales"]
    assert dict(ms.dtypes)["days"] == "int" and dict(ms.dtypes)["month"] == "date"
    assert ms.count() == inp["monthly_sales"].count()
    assert spark.table("monthly_sales").count() == ms.count()


def test_sinks(spark, tmp_path):
    from daycast.plans.queries import forecast_final
    out = forecast_final(spark, SF)
    write_output(out, str(tmp_path / "pq"), sort=True)
    back = spark.read.parquet(str(tmp_path / "pq"))
    assert back.count() == out.count() and "date_forecast" in back.columns
    write_output(out, str(tmp_path / "csv"), fmt="csv", single_file=True)
    files = [p for p in (tmp_path / "csv").iterdir() if p.name.startswith("part-")]
    assert len(files) == 1
    assert preview(out).count() == 5


def test_single_file_is_written_by_one_task_that_does_nothing_else(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 4).withColumn("computed_in", F.spark_partition_id())
    write_output(rows, str(tmp_path / "one"), fmt="csv", single_file=True)
    assert len([p for p in (tmp_path / "one").iterdir() if p.name.startswith("part-")]) == 1
    back = spark.read.option("header", True).csv(str(tmp_path / "one")).collect()
    assert sorted(int(r.id) for r in back) == list(range(1000))
    assert {r.computed_in for r in back} == {"0", "1", "2", "3"}

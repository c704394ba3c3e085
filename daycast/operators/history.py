"""Monthly history: last twelve months and the OCL cap.

`monthly_sales` is keyed by (loc_num, month); duplicates are counted as
rows, as in the original (check L7 reports them).  The last-12 window is a
`row_number() <= 12` filter, which Spark turns into a per-partition
top-12 limit *before* the window's shuffle: a location holding a third of
all rows still ships at most 12 rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HIST_MONTHS = 12


def last_twelve(history: DataFrame) -> DataFrame:
    """C4: for locations with at least 12 history rows, their last 12 rows by month.

    A location has >= 12 rows exactly when 12 rows survive the top-12
    filter, so no separate count over the full history is needed.  Ties
    on month (duplicate rows) are broken by days, for determinism.
    """
    by_loc_desc = Window.partitionBy("loc_num").orderBy(F.col("month").desc(), F.col("days").desc())
    ranked = (history.select("loc_num", "month", "days")
              .withColumn("rn", F.row_number().over(by_loc_desc))
              .where(F.col("rn") <= HIST_MONTHS))
    return (ranked.withColumn("n_hist", F.count(F.lit(1)).over(Window.partitionBy("loc_num")))
            .where(F.col("n_hist") == HIST_MONTHS)
            .select("loc_num", "month", F.month("month").alias("month_num"), "days", "rn"))


def history_days_by_month_num(history: DataFrame) -> DataFrame:
    """E2 side: one row per location with the historical days of each month
    number (`hist_1` .. `hist_12`).

    If a month number appears twice among the last 12 rows (gaps in the
    history), the later month wins (of equal months, the
    larger day count).  The pivot values are fixed, so this is
    a single aggregate with twelve bounded slots per location.
    """
    last = last_twelve(history)
    wide = last.groupBy("loc_num").pivot("month_num", list(range(1, 13))).agg(F.max_by("days", F.struct("month", "days")))
    return wide.select("loc_num", *[F.col(str(k)).alias(f"hist_{k}") for k in range(1, 13)])


def hist_array() -> F.Column:
    """The twelve historical day counts of a location, indexed by month number."""
    return F.array(*[F.col(f"hist_{k}") for k in range(1, 13)])


def cap_days(days_max: str = "days_max", hist_days: str = "hist_days", ocl_code: str = "OCL") -> F.Column:
    """K4: for OCL locations, never more selling days than history shows."""
    # least() skips a null, so a location without history keeps the calendar's days.
    return F.when(F.col("location_type_code") == ocl_code, F.least(hist_days, days_max)).otherwise(F.col(days_max))

"""Fixed schemas of the five input tables and the output.

Reading with a declared schema avoids the inference hazards of the
original job (a close-date column without any 'null' sentinel is
inferred as a date and then breaks a string comparison).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# Fixed value: close date standing for "never closes".
FAR_FUTURE = dt.date(2200, 1, 1)
# Fixed value: width of the zero-padded location number.
LOC_WIDTH = 5

S, D, I, DB = T.StringType(), T.DateType(), T.IntegerType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SALES_DAYS_FUTURE = _struct(
    ("loc_num", S, False),
    ("date_forecast", D, False),
    ("open_date", D, True),
    ("close_date", D, True),
    ("location_type_code", S, True),
    ("price_group", S, True),
    ("months_predict", I, True),
)

MONTHLY_SALES = _struct(
    ("loc_num", S, False),
    ("month", D, False),
    ("open_date", D, True),
    ("sales", DB, True),
    ("days", I, True),
    ("inflation_factor_ending", DB, True),
)

REINVESTMENT_PROJECTS = _struct(("loc_num", S, False), ("shutdown", D, True), ("reopen", D, True))

CANNIBALIZATION_FACTORS = _struct(("loc_num", S, False), ("month", D, False), ("gocf", DB, True))

REINVESTMENT_FACTORS = _struct(("loc_num", S, False), ("month", D, False), ("factor", DB, True))

PRICE_INCREASES = _struct(("price_group", S, False), ("inc", DB, True))

INPUTS = {
    "sales_days_future": SALES_DAYS_FUTURE,
    "monthly_sales": MONTHLY_SALES,
    "reinvestment_projects": REINVESTMENT_PROJECTS,
    "cannibalization_factors": CANNIBALIZATION_FACTORS,
    "reinvestment_factors": REINVESTMENT_FACTORS,
    "price_increases": PRICE_INCREASES,
}

# Date columns per input table (parsed from text by the CSV reader).
DATE_COLUMNS = {
    name: [f.name for f in schema.fields if isinstance(f.dataType, T.DateType)]
    for name, schema in INPUTS.items()
}

FORECAST_OUTPUT = _struct(
    ("loc_num", S, False),
    ("month", D, False),
    ("date_forecast", D, False),
    ("days", I, True),
    ("inflation_factor", DB, True),
    ("age", I, True),
    ("concept_code", S, True),
    ("location_type_code", S, True),
    ("gocf", DB, True),
    ("reinvestment_factor", DB, True),
    ("age_years", DB, True),
    ("age_group", S, True),
)

FINAL_COLUMNS = [f.name for f in FORECAST_OUTPUT.fields]

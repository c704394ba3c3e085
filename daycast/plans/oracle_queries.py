"""DuckDB SQL of every registered query (building blocks in `oracle.py`).

Scalar-function queries use brute force where it is cheap (sales days by
enumerating the days), so the closed forms used by the engine are checked
against an independent method.
"""

from __future__ import annotations

from daycast.plans import oracle as O
from daycast.sources import fixtures

P = fixtures.FIXTURE_PARAMS
PC = fixtures.PRICE_CHANGE_PARAMS


def _pipe(body: str, p=P, scope: str = "forecast") -> str:
    return O.with_(O.pipeline_ctes(p, scope), body)


def _fix(body: str, extra: list[str] | None = None, p=P) -> str:
    return O.with_(O.fixture_ctes() + (extra or []), body)


LI_DATES = "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS start_date FROM lineitem"

CLEANSE = f"""SELECT {O.PAD('s_suppkey')} AS loc_num,
  CASE WHEN s_suppkey % 2 = 0 THEN DATE '2001-04-10' ELSE DATE '2001-04-20' END AS date_forecast,
  {O.OPEN('s_suppkey')} AS open_date,
  coalesce(CASE WHEN s_suppkey % 10 = 3 THEN DATE '2001-09-15' + CAST((s_suppkey * 31) % 400 AS INTEGER) END,
           DATE '2200-01-01') AS close_date,
  CASE s_suppkey % 3 WHEN 0 THEN 'OCL' WHEN 1 THEN 'STD' ELSE 'MALL' END AS location_type_code,
  CAST(s_suppkey % 4 AS VARCHAR) AS price_group, 120 AS months_predict,
  CASE s_suppkey % 3 WHEN 0 THEN 'OCL' WHEN 1 THEN 'STD' ELSE 'MALL' END AS concept_code
FROM supplier"""

SALESDAYS = f"""SELECT l_orderkey, l_linenumber, start_date, end_date,
  CAST(len(list_filter(generate_series(start_date, end_date, INTERVAL 1 DAY), lambda d: dayofweek(d) <> 0))
       AS INTEGER) AS sales_days,
  strftime(start_date, '%A') AS start_weekday,
  last_day(start_date) AS start_month_end
FROM (SELECT *, start_date + CAST((l_orderkey * 7 + l_linenumber * 13) % 400 AS INTEGER) AS end_date
      FROM ({LI_DATES}) a) t"""

MONTHS = f"""SELECT l_orderkey, l_linenumber, start_date, end_date,
  CAST(datediff('month', date_trunc('month', start_date), date_trunc('month', end_date)) AS INTEGER) AS months,
  CAST(year(end_date) AS INTEGER) AS end_year, CAST(month(end_date) AS INTEGER) AS end_month,
  CAST(day(end_date) AS INTEGER) AS end_day
FROM (SELECT *, start_date + CAST((l_orderkey * 11) % 2000 - 1000 AS INTEGER) AS end_date
      FROM ({LI_DATES}) a) t"""

CAL_KEYS = f"""SELECT month, CAST(date_trunc('year', month) AS DATE) AS year_start, {O.JAN1('month')} AS jan1_day,
  CAST(month(month) AS INTEGER) AS month_num, {O.LEAP('month')} AS leap_year
FROM (SELECT DISTINCT month FROM monthly_sales) m"""

# Faults of the raw location table, by supplier number (text that is no date is null, or "never closes").
FAULTY = """SELECT loc_num, CASE WHEN k % 5 <> 4 THEN date_forecast END AS date_forecast,
  CASE WHEN k % 3 <> 1 THEN open_date END AS open_date,
  coalesce(CASE WHEN k % 4 <> 2 THEN close_date END, DATE '2200-01-01') AS close_date,
  location_type_code, price_group, months_predict
FROM (SELECT *, CAST(loc_num AS BIGINT) AS k FROM sdf) s"""

# Leap layouts by enumeration: a month of a leap year and of a common year have the same
# layout if they begin on the same weekday; 28 years hold every kind of year.
LEAP_ALL = """SELECT jan1_day, month_num, leap_year, year_ref, days_max FROM cal_obs
UNION ALL
SELECT d.jan1_day, d.month_num, TRUE, o.year_ref, CAST(o.days_max + d.extra AS INTEGER)
FROM (
  SELECT DISTINCT strftime(make_date(l.y, 1, 1), '%A') AS jan1_day, CAST(m.m AS INTEGER) AS month_num,
    strftime(make_date(c.y, 1, 1), '%A') AS donor,
    CASE WHEN m.m = 2 AND dayofweek(make_date(l.y, 2, 29)) <> 0 THEN 1 ELSE 0 END AS extra
  FROM generate_series(2000, 2027) l(y), generate_series(2000, 2027) c(y), generate_series(1, 12) m(m)
  WHERE l.y % 4 = 0 AND c.y % 4 <> 0 AND dayofweek(make_date(l.y, m.m, 1)) = dayofweek(make_date(c.y, m.m, 1))) d
JOIN cal_obs o ON o.jan1_day = d.donor AND o.month_num = d.month_num AND NOT o.leap_year
WHERE NOT EXISTS (
  SELECT 1 FROM cal_obs x WHERE x.jan1_day = d.jan1_day AND x.month_num = d.month_num AND x.leap_year)"""

def _dates_of(date, p, scope: str = "backtest") -> str:
    return f"SELECT * FROM ({O.final_sql(p, scope)}) f WHERE date_forecast = {O._d(date)}"


def _duplicates(table: str, keys: str) -> str:
    return f"SELECT CAST(count(*) AS DOUBLE) FROM (SELECT {keys} FROM {table} GROUP BY ALL HAVING count(*) > 1) d"


OBSERVED = _pipe(f"""
SELECT 'required_missing' AS check_name, CAST(count(*) FILTER (
  WHERE loc_num IS NULL OR date_forecast IS NULL) AS DOUBLE) AS value FROM locs
UNION ALL SELECT 'open_date_missing', CAST(count(*) FILTER (WHERE open_date IS NULL) AS DOUBLE) FROM locs
UNION ALL SELECT 'type_code_missing', CAST(count(*) FILTER (WHERE location_type_code IS NULL) AS DOUBLE) FROM locs
UNION ALL SELECT 'project_dates_invalid', CAST(count(*) FILTER (
  WHERE shutdown IS NULL OR reopen IS NULL OR reopen < shutdown) AS DOUBLE) FROM reinvestment_projects
UNION ALL SELECT 'inflation_missing', CAST(count(*) FILTER (
  WHERE inflation_factor IS NULL OR isnan(inflation_factor)) AS DOUBLE) FROM hz_factors
UNION ALL SELECT 'inflation_max', round(max(inflation_factor), 6) FROM hz_factors
UNION ALL SELECT 'days_missing', CAST(count(*) FILTER (WHERE days IS NULL) AS DOUBLE) FROM hz_factors
UNION ALL SELECT 'calendar_missing', CAST((SELECT count(*) FROM horizon) - (SELECT count(*) FROM hz) AS DOUBLE)
UNION ALL SELECT 'locations_duplicate_keys', ({_duplicates('sdf', 'loc_num, date_forecast')})
UNION ALL SELECT 'history_duplicate_keys', ({_duplicates('monthly_sales', 'loc_num, month')})
UNION ALL SELECT 'cannibalization_duplicate_keys', ({_duplicates('cannibalization_factors', 'loc_num, month')})
UNION ALL SELECT 'reinvestment_duplicate_keys', ({_duplicates('reinvestment_factors', 'loc_num, month')})
UNION ALL SELECT 'price_duplicate_keys', ({_duplicates('price_increases', 'price_group')})""")

COVERAGE = _pipe(f"""SELECT {O.JAN1('month')} AS jan1_day, CAST(month(month) AS INTEGER) AS month_num, {O.LEAP('month')} AS leap_year,
  count(DISTINCT month) AS months, min(month) AS first_month, max(month) AS last_month, count(*) AS location_months
FROM horizon h WHERE NOT EXISTS (SELECT 1 FROM hz WHERE hz.month = h.month AND hz.date_forecast = h.date_forecast) GROUP BY ALL""",
                 scope="backtest")

# The lines of the raw location table and their faults, by supplier number.
MALFORMED = f"""SELECT reason, CASE WHEN reason <> 'read' THEN line END AS line, count(*) AS n FROM (
  SELECT CASE WHEN k % 11 = 3 OR k % 7 = 2 THEN 'fields' WHEN k % 17 = 4 THEN 'loc_num: missing'
      WHEN k % 13 = 5 THEN 'open_date: no date' ELSE 'read' END AS reason,
    CASE WHEN k % 11 = 3 THEN k || ',' || date_forecast || ',' || open_date ELSE
      CASE WHEN k % 17 = 4 THEN '' ELSE CAST(k AS VARCHAR) END || ',' || date_forecast || ',' ||
      CASE WHEN k % 13 = 5 THEN '31/12/1990' ELSE CAST(open_date AS VARCHAR) END || ',' ||
      coalesce(CAST(close_date AS VARCHAR), 'null') || ',' || location_type_code || ',' || price_group ||
      CASE WHEN k % 7 = 2 THEN ',extra' ELSE '' END END AS line
  FROM (SELECT *, CAST(loc_num AS BIGINT) AS k FROM sdf) s) t
GROUP BY ALL"""

ORDERS = """SELECT lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS o_orderkey,
  lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(8, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS o_custkey,
  CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
  o_orderstatus
FROM orders"""

ORACLE_SQL: dict[str, str] = {
    "cleanse_locations": CLEANSE,
    "salesdays_between": SALESDAYS,
    "months_between_exact": MONTHS,
    "calendar_keys": _fix(CAL_KEYS),
    "day_details": _fix("SELECT * FROM calendar", O.calendar_ctes(P)),
    "leap_wednesday": _fix("""SELECT * FROM calendar c WHERE NOT EXISTS (
  SELECT 1 FROM cal_obs o WHERE o.jan1_day = c.jan1_day AND o.month_num = c.month_num AND o.leap_year = c.leap_year)""",
                           O.calendar_ctes(P)),
    "horizon": _fix("SELECT loc_num, date_forecast, month, month_start, month_open, month_close FROM horizon",
                    [O.locs_cte(P)] + O.horizon_ctes()[:1]),
    "closing_vision": _fix(f"""SELECT l.loc_num, l.date_forecast, s.close_date, l.month_close,
  {O.MF("coalesce(s.close_date, DATE '2200-01-01')")} AS month_close_always
FROM locs l JOIN sdf s ON s.loc_num = l.loc_num AND s.date_forecast = l.date_forecast""", [O.locs_cte(P)]),
    "horizon_calendar": _pipe("SELECT loc_num, date_forecast, month, days_max FROM hz"),
    "history_last12": _pipe("SELECT loc_num, month, month_num, days, rn FROM hist_last12"),
    "history_cap": _pipe("SELECT loc_num, date_forecast, month, days_max, days_capped FROM hz_cap"),
    "open_close_days": _fix("""SELECT loc_num, date_forecast, open_date, close_date, days_before_open, days_after_close
FROM locs""", [O.locs_cte(P)]),
    "shutdown_months": _pipe(f"""SELECT loc_num, shutdown, reopen, month,
  {O.MBE('month_shutdown', 'month')} AS month_index FROM proj_months"""),
    "shutdown_days_lost": _pipe("SELECT loc_num, month, days_lost FROM days_lost"),
    "days_final": _pipe("SELECT loc_num, date_forecast, month, days, days_lost, age FROM hz_days"),
    "reported_inflation": _pipe("""SELECT l.loc_num, l.date_forecast, l.reported_month,
  round(h.inflation_factor_ending, 6) AS inflation_factor
FROM locs l LEFT JOIN hist h ON h.loc_num = l.loc_num AND h.month = l.reported_month"""),
    "inflation_mean_fill": _pipe("""SELECT loc_num, date_forecast, month, reported_month, concept_code,
  round(filled_inflation, 6) AS inflation_factor FROM hz_filled"""),
    "inflation_path": _pipe("SELECT date_forecast, month, round(incremental_time_inflation, 6) AS "
                            "incremental_time_inflation FROM path"),
    "inflation_path_backtest": _pipe("SELECT date_forecast, month, round(incremental_time_inflation, 6) AS "
                                     "incremental_time_inflation FROM path", scope="backtest"),
    "inflation_applied": _pipe("SELECT loc_num, date_forecast, month, round(inflation_factor, 6) AS inflation_factor "
                               "FROM hz_applied"),
    "shifted_increase": O.with_(O.pipeline_ctes(PC, "forecast", increases=False),
                                "SELECT loc_num, date_forecast, month, round(inflation_factor, 6) AS inflation_factor "
                                "FROM hz_applied"),
    "price_change_overlay": _pipe("SELECT loc_num, date_forecast, month, round(inflation_factor, 6) AS "
                                  "inflation_factor FROM hz_applied", p=PC),
    "cannibalization": _pipe("SELECT loc_num, date_forecast, month, round(gocf, 6) AS gocf FROM hz_factors"),
    "cannibalization_backtest": _pipe("SELECT loc_num, date_forecast, month, round(gocf, 6) AS gocf FROM hz_factors",
                                      scope="backtest"),
    "reinvestment_factor": _pipe("SELECT loc_num, date_forecast, month, round(reinvestment_factor, 6) AS "
                                 "reinvestment_factor FROM hz_factors"),
    "reinvestment_factor_backtest": _pipe("SELECT loc_num, date_forecast, month, round(reinvestment_factor, 6) AS "
                                          "reinvestment_factor FROM hz_factors", scope="backtest"),
    "age_groups": _pipe(f"""SELECT loc_num, date_forecast, month, age, age_years, {O.age_group_sql('age_years')} AS age_group
FROM (SELECT *, round_even(CAST(age AS DOUBLE) / 12, 1) AS age_years FROM hz_factors) f"""),
    "quality_report": _pipe(f"""
SELECT 'required_missing' AS check_name, CAST(count(*) FILTER (
  WHERE loc_num IS NULL OR date_forecast IS NULL) AS DOUBLE) AS value FROM locs
UNION ALL SELECT 'open_date_missing', CAST(count(*) FILTER (WHERE open_date IS NULL) AS DOUBLE) FROM locs
UNION ALL SELECT 'type_code_missing', CAST(count(*) FILTER (WHERE location_type_code IS NULL) AS DOUBLE) FROM locs
UNION ALL SELECT 'project_dates_invalid', CAST(count(*) FILTER (
  WHERE shutdown IS NULL OR reopen IS NULL OR reopen < shutdown) AS DOUBLE) FROM reinvestment_projects
UNION ALL SELECT 'inflation_missing', CAST(count(*) FILTER (
  WHERE inflation_factor IS NULL OR isnan(inflation_factor)) AS DOUBLE) FROM hz_factors
UNION ALL SELECT 'inflation_max', round(max(inflation_factor), 6) FROM hz_factors
UNION ALL SELECT 'days_missing', CAST(count(*) FILTER (WHERE days IS NULL) AS DOUBLE) FROM hz_factors
UNION ALL SELECT 'history_duplicate_keys', CAST(count(*) AS DOUBLE) FROM (
  SELECT loc_num, month FROM monthly_sales GROUP BY ALL HAVING count(*) > 1) d
UNION ALL SELECT 'calendar_missing', CAST(count(*) AS DOUBLE) FROM horizon h WHERE NOT EXISTS (
  SELECT 1 FROM calendar c WHERE c.jan1_day = {O.JAN1('h.month')} AND c.month_num = month(h.month)
    AND c.leap_year = {O.LEAP('h.month')})"""),
    "csv_round_trip": f"SELECT * EXCLUDE (concept_code) FROM ({CLEANSE}) c",
    "rejects": _fix(f"SELECT * FROM ({FAULTY}) f WHERE date_forecast IS NULL OR open_date IS NULL"),
    "unparsed_dates": _fix("""SELECT CAST(0 AS BIGINT) AS date_forecast,
  count(*) FILTER (WHERE CAST(loc_num AS BIGINT) % 3 = 1) AS open_date,
  count(*) FILTER (WHERE CAST(loc_num AS BIGINT) % 4 = 2) AS close_date FROM sdf"""),
    "duplicate_keys": _fix("""SELECT count(*) AS duplicate_keys FROM (
  SELECT loc_num, month FROM (
    SELECT * FROM cannibalization_factors
    UNION ALL SELECT * FROM cannibalization_factors WHERE month(month) <= 3) t
  GROUP BY ALL HAVING count(*) > 1) d"""),
    "sorted_preview": f"SELECT * FROM ({O.final_sql(P)}) f ORDER BY loc_num, date_forecast, month LIMIT 5",
    "price_change_mid_month": _pipe("SELECT loc_num, date_forecast, month, round(inflation_factor, 6) AS "
                                    "inflation_factor FROM hz_applied", p=fixtures.MID_MONTH_CHANGE_PARAMS),
    "forecast_price_change_backtest": O.final_sql(fixtures.BACKTEST_CHANGE_PARAMS, "backtest"),
    "closing_vision_off": O.final_sql(P.replace(closing_vision=False)),
    "rounded_factors": f"""SELECT * REPLACE (round(gocf, 15) AS gocf, round(reinvestment_factor, 2) AS reinvestment_factor)
FROM ({O.final_sql(P)}) f""",
    "leap_all_weekdays": _fix(LEAP_ALL, O.calendar_ctes(P)),
    "forecast_final": O.final_sql(P, "forecast"),
    "forecast_final_backtest": O.final_sql(P, "backtest"),
    "observed_checks": OBSERVED,
    "sorted_sink": f"""SELECT loc_num, month, date_forecast, row_number() OVER (ORDER BY loc_num, month, date_forecast) AS position
FROM ({O.final_sql(P, 'backtest')}) f""",
    "single_file_sink": f"SELECT *, CAST(1 AS BIGINT) AS n_files FROM ({O.final_sql(P)}) f",
    "rewritten_date": _dates_of(fixtures.BACKTEST_DATES[0], P) + " UNION ALL "
                      + _dates_of(fixtures.BACKTEST_DATES[1], P.replace(closing_vision=False)),
    "calendar_coverage": COVERAGE,
    "synthesised_calendar": _fix("SELECT * FROM calendar", O.calendar_ctes(P.replace(calendar_gap="synthesise"))),
    "forecast_synthesised": O.final_sql(P.replace(calendar_gap="synthesise")),
    # One run per forecast date, which knows nothing later.
    "forecast_versioned_calendar": " UNION ALL ".join(_dates_of(d, P.replace(as_of=d)) for d in fixtures.BACKTEST_DATES),
    "malformed_rows": _fix(MALFORMED),
    "cleanse_orders": ORDERS,
}

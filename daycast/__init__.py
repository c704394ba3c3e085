"""daycast: a Spark-native engine forecasting selling days, inflation and
store factors per location and future month."""

from daycast.params import BACKTEST, FORECAST, ForecastParams
from daycast.plans.pipeline import ForecastRun, forecast_sales_days

__all__ = ["BACKTEST", "FORECAST", "ForecastParams", "ForecastRun", "forecast_sales_days"]

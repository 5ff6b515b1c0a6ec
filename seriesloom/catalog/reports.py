"""The forecast report the metric and reshape queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.catalog.base import SUPPLIER_MONTHLY, over, sql_before, supplier_panel
from seriesloom.functions.columns import before, guarded, rounded
from seriesloom.operators import metrics as mt

MODELS = ("last_value", "seasonal_naive", "sma_3")
TEST_START = "1999-01-01"
KEYS = ["series", "model_type", "window"]


def forecast_report(spark: SparkSession, sf: str) -> DataFrame:
    """Three simple forecasts of every supplier's monthly quantity, by quarter windows."""
    p = supplier_panel(spark, sf).frames(
        lambda w: {
            "last_value": F.lag("y", 1).over(w),
            "seasonal_naive": F.lag("y", 12).over(w),
            "sma_3": guarded(F.avg, "y", before(w, 3), 3),
        },
        back=12,
    )
    long = p.df.select("series", "date", F.col("y").alias("actual"), *MODELS).unpivot(
        ["series", "date", "actual"], list(MODELS), "model_type", "forecast"
    )
    return long.filter(F.col("forecast").isNotNull()).withColumn("window", F.year("date") * 10 + F.quarter("date"))


def validation_report(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows with their window's metrics and the model's training metrics."""
    r = forecast_report(spark, sf)
    training = (
        r.filter(F.col("date") < TEST_START)
        .groupBy("series", "model_type")
        .agg(
            rounded(mt.mape("actual", "forecast"), 4).alias("TRAINING_MAPE"),
            rounded(mt.rmse("actual", "forecast"), 2).alias("TRAINING_RMSE"),
        )
    )
    test = r.filter(F.col("date") >= TEST_START)
    return mt.with_report_metrics(test, KEYS, "date").join(training, ["series", "model_type"], "left")


FORECAST_REPORT = f"""{SUPPLIER_MONTHLY},
models AS (
  SELECT series, date, y AS actual, lag(y, 1) {over()} AS last_value, lag(y, 12) {over()} AS seasonal_naive,
         {sql_before('avg', 'y', 3)} AS sma_3 FROM supplier_monthly),
report AS (
  SELECT series, date, actual, model_type, forecast, CAST(year(date) * 10 + quarter(date) AS INTEGER) AS "window" FROM (
    SELECT series, date, actual, 'last_value' AS model_type, last_value AS forecast FROM models
    UNION ALL SELECT series, date, actual, 'seasonal_naive', seasonal_naive FROM models
    UNION ALL SELECT series, date, actual, 'sma_3', sma_3 FROM models)
  WHERE forecast IS NOT NULL)"""

METRICS = """round(avg(abs((actual - forecast) / actual)), 4) AS "MAPE", round(sqrt(avg((actual - forecast) * (actual - forecast))), 2) AS "RMSE",
  round(avg(abs(actual - forecast)), 2) AS "MAE",
  round(1 - sum((actual - forecast) * (actual - forecast)) / nullif(var_pop(actual) * count(*), 0), 4) AS "R2",
  round(sum(abs(actual - forecast)) / sum(actual), 2) AS "WAPE",
  round(arg_max(abs((actual - forecast) / actual), date), 4) AS "MAPE_6W", round(arg_max(abs(actual - forecast), date), 2) AS "RMSE_6W" """

VALIDATION_REPORT = f"""{FORECAST_REPORT},
training AS (
  SELECT series, model_type, round(avg(abs((actual - forecast) / actual)), 4) AS "TRAINING_MAPE",
         round(sqrt(avg((actual - forecast) * (actual - forecast))), 2) AS "TRAINING_RMSE"
  FROM report WHERE date < DATE '{TEST_START}' GROUP BY 1, 2),
test_metrics AS (SELECT series, model_type, "window", {METRICS} FROM report WHERE date >= DATE '{TEST_START}' GROUP BY 1, 2, 3),
validation AS (
  SELECT r.series, r.model_type, r."window", r.date, r.actual, r.forecast,
         round((forecast - actual) / nullif(forecast + actual, 0), 3) AS "Bias", m.* EXCLUDE (series, model_type, "window"),
         t."TRAINING_MAPE", t."TRAINING_RMSE"
  FROM report r JOIN test_metrics m ON r.series = m.series AND r.model_type = m.model_type AND r."window" = m."window"
  LEFT JOIN training t ON r.series = t.series AND r.model_type = t.model_type
  WHERE r.date >= DATE '{TEST_START}')"""

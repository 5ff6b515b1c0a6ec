"""Metric reports and reshaping: A and K rows of the inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.catalog.base import round_half_up, round_to, NATION_MONTHLY, ORDERS_WEEKLY, nation_monthly_df, orders_weekly_df, query, supplier_monthly_df, table, with_
from seriesloom.catalog.base import SUPPLIER_MONTHLY
from seriesloom.catalog.reports import FORECAST_REPORT, KEYS, METRICS, MODELS, VALIDATION_REPORT, forecast_report, validation_report
from seriesloom.operators import cleaning as cl
from seriesloom.operators import metrics as mt
from seriesloom.operators import reshape as rs

R, V = with_(FORECAST_REPORT), with_(VALIDATION_REPORT)
E = "(actual - forecast)"
PCT = f"abs({E} / actual)"


query("a01_report_metrics", f'{R}SELECT series, model_type, "window", {METRICS} FROM report GROUP BY 1, 2, 3')(
    lambda spark, sf: mt.report_metrics(forecast_report(spark, sf), KEYS, "date")
)
query("a01_report_metrics_on_rows", f"{V}SELECT * FROM validation")(validation_report)
query(
    "a02_short_metrics",
    f"""{R}, m AS (SELECT series, model_type, "window", round(avg({PCT}), 4) AS "MAPE", round(sqrt(avg({E} * {E})), 2) AS "RMSE"
  FROM report GROUP BY 1, 2, 3)
SELECT r.*, round((forecast - actual) / nullif(forecast + actual, 0), 3) AS "Bias", m."MAPE", m."RMSE"
FROM report r JOIN m USING (series, model_type, "window")""",
)(lambda spark, sf: mt.short_metrics(forecast_report(spark, sf), KEYS))


def _daily(spark, sf):
    r = forecast_report(spark, sf).withColumn("run_date", F.trunc("date", "MM").cast("date"))
    return mt.point_performance(r, "actual", "forecast", "date", "run_date", "model_type", "series")


query(
    "a03_point_performance",
    f"""{R}SELECT date AS eval_date, CAST(date_trunc('month', date) AS DATE) AS run_date, model_type AS model_name, series,
  round(abs({E}), 3) AS mae, round(sqrt({E} * {E}), 3) AS rmse, round({PCT}, 3) AS mape,
  round((forecast - actual) / nullif(forecast + actual, 0), 3) AS bias, round(forecast, 3) AS forecast, round(actual, 3) AS actual
FROM report""",
)(_daily)

query("a04_weighted_percent_error", f"{R}SELECT series, model_type, round(sum(abs({E})) / sum(abs(actual)), 5) AS wape FROM report GROUP BY 1, 2")(
    lambda spark, sf: forecast_report(spark, sf).groupBy("series", "model_type").agg(mt.absolute_wape("actual", "forecast").alias("wape"))
)
query("a05_signed_percent_error", f"{R}SELECT series, model_type, round(sum{E} / sum(actual), 7) AS mpe FROM report GROUP BY 1, 2")(
    lambda spark, sf: forecast_report(spark, sf)
    .groupBy("series", "model_type")
    .agg(mt.mean_percent_error("actual", "forecast").alias("mpe"))
)
_PACK = f"""round(avg({PCT}), 6) AS mape, round(sqrt(avg({E} * {E})), 4) AS rmse, round(avg(abs({E})), 4) AS mae,
  round(1 - sum({E} * {E}) / (var_pop(actual) * count(*)), 6) AS r2, round(sum(forecast) / sum(actual) - 1, 6) AS forecast_bias,
  round(sum{E} / sum(actual), 7) AS mpe, round(sum(abs({E})) / sum(abs(actual)), 5) AS wape"""
_PACK_DIGITS = {"mape": 6, "rmse": 4, "mae": 4, "r2": 6, "forecast_bias": 6}
query("a06_metric_pack", f"{R}SELECT model_type, {_PACK} FROM report GROUP BY 1")(
    lambda spark, sf: round_to(mt.metric_pack(forecast_report(spark, sf), ["model_type"]), **_PACK_DIGITS)
)
query("a07_metric_pack_by_series", f"{R}SELECT series, model_type, {_PACK} FROM report GROUP BY 1, 2")(
    lambda spark, sf: round_to(
        mt.metric_pack(forecast_report(spark, sf), ["series", "model_type"]), **_PACK_DIGITS
    )
)
query("a08_mean_by_model", f'{V}SELECT model_type, round(avg("MAPE"), 5) AS "MAPE", round(avg("RMSE"), 4) AS "RMSE" FROM validation GROUP BY 1')(
    lambda spark, sf: round_to(mt.mean_by(validation_report(spark, sf), ["model_type"], ["MAPE", "RMSE"]), MAPE=5, RMSE=4)
)


def _summary_sql(keys: str) -> str:
    cols = ", ".join(
        f'round(avg("{c}"), 5) AS "{c}_mean", round(stddev_samp("{c}"), 5) AS "{c}_std", round(quantile_cont("{c}", 0.5), 5) AS "{c}_median"'
        for c in ("MAPE", "RMSE")
    )
    return f"{V}SELECT {keys}, {cols} FROM validation GROUP BY ALL"


_SUMMARY = {f"{c}_{k}": 5 for c in ("MAPE", "RMSE") for k in ("mean", "std", "median")}
for _name, _keys, _kw in (
    ("a09_summary_by_model", ["model_type"], {"rows_per_task": 2_000}),
    ("a09_summary_by_model_window", ["model_type", "window"], {}),
    ("a09_summary_by_series_model", ["series", "model_type"], {}),
):
    query(_name, _summary_sql(", ".join(f'"{k}"' for k in _keys)), _keys=_keys, _kw=_kw)(
        lambda spark, sf, _keys, _kw: round_to(mt.summary_by(validation_report(spark, sf), _keys, ["MAPE", "RMSE"], **_kw), **_SUMMARY)
    )
query(
    "a10_window_error_summary",
    f"""{R}, w AS (SELECT model_type, "window", avg({PCT}) AS mape FROM report GROUP BY 1, 2)
SELECT model_type, round(avg(mape), 5) AS mape_mean, round(stddev_samp(mape), 5) AS mape_std, round(quantile_cont(mape, 0.5), 5) AS mape_median
FROM w GROUP BY 1""",
)(
    lambda spark, sf: round_to(
        mt.window_mape_summary(forecast_report(spark, sf), ["model_type"], "window"), mape_mean=5, mape_std=5, mape_median=5
    )
)
query("a11_point_error", f'{R}SELECT series, date, model_type, round({PCT}, 5) AS point_mape FROM report')(
    lambda spark, sf: forecast_report(spark, sf).select("series", "date", "model_type", round_half_up(mt.point_mape(), 5).alias("point_mape"))
)
query(
    "a12_overfit_gaps",
    f"""{V}SELECT series, date, model_type, round("MAPE" / nullif("TRAINING_MAPE", 0), 2) AS "MAPE_gap",
  round("RMSE" / nullif("TRAINING_RMSE", 0), 2) AS "RMSE_gap", round({E}, 4) AS residual FROM validation""",
)(
    lambda spark, sf: mt.overfit_gaps(validation_report(spark, sf)).select(
        "series", "date", "model_type", "MAPE_gap", "RMSE_gap", round_half_up(F.col("actual") - F.col("forecast"), 4).alias("residual")
    )
)
_PER = f"per AS (SELECT series, model_type, avg(\"MAPE\") AS m FROM validation GROUP BY 1, 2)"
query("a13_best_average", f'{V}, {_PER}, b AS (SELECT series, min(m) AS b FROM per GROUP BY 1) SELECT round(avg(b), 5) AS "best_MAPE" FROM b')(
    lambda spark, sf: round_to(mt.best_average(validation_report(spark, sf), ["series"], "model_type", "MAPE"), best_MAPE=5)
)
query(
    "a13_ensemble_ratio",
    f"""{V}, {_PER} SELECT series, round(max(CASE WHEN model_type = 'sma_3' THEN m END) / nullif(min(CASE WHEN model_type <> 'sma_3' THEN m END), 0), 5) AS ratio
FROM per GROUP BY 1""",
)(lambda spark, sf: round_to(mt.ensemble_ratio(validation_report(spark, sf), ["series"], "model_type", "MAPE", "sma_3"), ratio=5))
query(
    "a14_baseline_metrics",
    f"""{R}SELECT series, round(avg({PCT}), 6) AS mape, round(sqrt(avg({PCT})), 6) AS root_mape, round(sqrt(avg({E} * {E})), 4) AS rmse,
  round(avg(abs({E})), 4) AS mae, round(100 * (sum(forecast) / sum(actual) - 1), 5) AS bias_pct
FROM report WHERE model_type = 'seasonal_naive' GROUP BY 1""",
)(
    lambda spark, sf: round_to(
        (lambda r: mt.baseline_metrics(r, ["series"]).join(
            mt.baseline_metrics(r, ["series"], root=True).select("series", F.col("mape").alias("root_mape")), "series"
        ))(forecast_report(spark, sf).filter("model_type = 'seasonal_naive'")),
        mape=6, root_mape=6, rmse=4, mae=4, bias_pct=5,
    )
)
query("a15_asymmetric_loss", f"{R}SELECT model_type, round(avg(CASE WHEN {E} > 0 THEN 2 * {E} * {E} ELSE {E} * {E} END), 3) AS loss FROM report GROUP BY 1")(
    lambda spark, sf: forecast_report(spark, sf).groupBy("model_type").agg(round_half_up(mt.asymmetric_loss("actual", "forecast"), 3).alias("loss"))
)
query("a16_distinct_series", "SELECT l_returnflag, count(DISTINCT l_suppkey) AS l_suppkey_count FROM lineitem GROUP BY 1")(
    lambda spark, sf: mt.distinct_count(table(spark, sf, "lineitem"), ["l_returnflag"], "l_suppkey")
)
query(
    "a17_histogram",
    """SELECT l_returnflag, CAST(CASE WHEN l_extendedprice >= 100000 THEN 21 WHEN l_extendedprice < 0 THEN 0
  ELSE floor(l_extendedprice / 5000) + 1 END AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)(lambda spark, sf: mt.histogram(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", 0.0, 100000.0, 20))
_FIVE = ", ".join(
    f"round(quantile_cont(l_extendedprice, {q}), 3) AS {n}"
    for n, q in (("minimum", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("maximum", 1.0))
)
for _part, _spark_part, _sql_part in (
    ("weekday", F.weekday, "CAST(isodow(l_shipdate) - 1 AS INTEGER)"),
    ("month", F.month, "CAST(month(l_shipdate) AS INTEGER)"),
    ("quarter", F.quarter, "CAST(quarter(l_shipdate) AS INTEGER)"),
    ("day", F.dayofmonth, "CAST(day(l_shipdate) AS INTEGER)"),
):
    query(f"a17_five_numbers_by_{_part}", f"SELECT {_sql_part} AS part, {_FIVE} FROM lineitem GROUP BY 1", _f=_spark_part)(
        lambda spark, sf, _f: round_to(
            mt.five_numbers(
                table(spark, sf, "lineitem").select(_f("l_shipdate").alias("part"), "l_extendedprice"),
                ["part"], "l_extendedprice", rows_per_task=5_000,
            ),
            minimum=3, q1=3, median=3, q3=3, maximum=3,
        )
    )
query(
    "a18_tuning_summary",
    f"""{V}, cv AS (SELECT CAST("window" // 10 AS VARCHAR) AS param_year, model_type AS param_model, "MAPE" AS score FROM validation)
SELECT param, value, round(avg(score), 5) AS mean_score FROM (
  SELECT 'param_year' AS param, param_year AS value, score FROM cv UNION ALL SELECT 'param_model', param_model, score FROM cv)
GROUP BY 1, 2""",
)(
    lambda spark, sf: round_to(
        mt.tuning_summary(
            validation_report(spark, sf).select(
                F.floor(F.col("window") / 10).alias("param_year"), F.col("model_type").alias("param_model"), F.col("MAPE").alias("score")
            ),
            ["param_year", "param_model"], "score",
        ),
        mean_score=5,
    )
)
query(
    "io10_run_metrics",
    f"""{V}SELECT model_type, {', '.join(f'round(avg("{c}"), 4) AS "{c}"' for c in mt.RUN_METRICS)} FROM validation GROUP BY ROLLUP(model_type)""",
)(lambda spark, sf: mt.run_metrics(validation_report(spark, sf)))

# -- reshape ---------------------------------------------------------------------------------
query(
    "k01_pivot_forecasts",
    f"{R}SELECT series, date, actual, "
    + ", ".join(f"round(avg(CASE WHEN model_type = '{m}' THEN forecast END), 4) AS {m}" for m in MODELS)
    + " FROM report GROUP BY 1, 2, 3",
)(
    lambda spark, sf: round_to(
        rs.pivot_mean(forecast_report(spark, sf), ["series", "date", "actual"], "model_type", "forecast", MODELS), **{m: 4 for m in MODELS}
    )
)
_NATIONS = [f"NATION_{i}" for i in range(25)]
query(
    "k02_wide_panel",
    f"{with_(NATION_MONTHLY)}SELECT date, " + ", ".join(f"avg(CASE WHEN series = '{n}' THEN y END) AS \"{n}\"" for n in _NATIONS)
    + " FROM nation_monthly GROUP BY 1",
)(lambda spark, sf: rs.pivot_mean(nation_monthly_df(spark, sf), ["date"], "series", "y", _NATIONS))
query(
    "k03_melt",
    f"""{R}SELECT series, date, model_type, 'actual' AS kind, actual AS value FROM report
UNION ALL SELECT series, date, model_type, 'forecast', round(forecast, 4) FROM report""",
)(
    lambda spark, sf: round_to(rs.melt(forecast_report(spark, sf), ["series", "date", "model_type"], ["actual", "forecast"]), value=4)
)
query("k04_ensemble_mean", f"{R}SELECT series, date, round(avg(forecast), 4) AS ensemble FROM report GROUP BY 1, 2")(
    lambda spark, sf: round_to(rs.ensemble_mean(forecast_report(spark, sf), ["series", "date"], "forecast"), ensemble=4)
)
_MM = f'{V}, mm AS (SELECT series, model_type, round(avg("MAPE"), 5) AS "MAPE" FROM validation GROUP BY 1, 2)'


def _mean_metric(spark, sf):
    return round_to(mt.mean_by(validation_report(spark, sf), ["series", "model_type"], ["MAPE"]), MAPE=5)


query("k05_best_model", f'{_MM} SELECT series, arg_min(model_type, ("MAPE", model_type)) AS best_model, min("MAPE") AS best_metric FROM mm GROUP BY 1')(
    lambda spark, sf: rs.best_model(_mean_metric(spark, sf), ["series"], "model_type", "MAPE")
)
query(
    "k06_win_counts",
    f"""{V}, w AS (SELECT DISTINCT series, "window", model_type, "MAPE" FROM validation),
b AS (SELECT series, "window", arg_min(model_type, ("MAPE", model_type)) AS model_type FROM w GROUP BY 1, 2)
SELECT model_type, count(*) AS wins FROM b GROUP BY 1""",
)(lambda spark, sf: rs.win_counts(validation_report(spark, sf), ["series", "window"], "model_type", "MAPE"))
query(
    "k07_last_per_window",
    f"""{R}SELECT series, model_type, "window", date, actual, round(forecast, 4) AS forecast FROM report
QUALIFY row_number() OVER (PARTITION BY series, model_type, "window" ORDER BY date DESC) = 1""",
)(lambda spark, sf: round_to(rs.last_per_group(forecast_report(spark, sf), KEYS, ["date"]), forecast=4))
query("k08_top_rows", f'{_MM} SELECT * FROM mm ORDER BY "MAPE" DESC, series, model_type LIMIT 20')(
    lambda spark, sf: rs.first_rows_by(_mean_metric(spark, sf), "MAPE", 20, ["series", "model_type"])
)
query(
    "k08_last_rows_per_series",
    f"{with_(SUPPLIER_MONTHLY)}SELECT series, date, y, CAST(row_number() OVER (PARTITION BY series ORDER BY date DESC) AS INTEGER) AS from_end FROM supplier_monthly QUALIFY from_end <= 24",
)(lambda spark, sf: cl.last_rows(supplier_monthly_df(spark, sf).select("series", "date", "y"), ["series"], ["date"], 24))
query(
    "k09_sorted_importances",
    f"""{with_(SUPPLIER_MONTHLY)}SELECT feature, round(importance, 5) AS importance FROM (
  SELECT 'rev' AS feature, abs(corr(y, rev)) AS importance FROM supplier_monthly
  UNION ALL SELECT 'disc', abs(corr(y, disc)) FROM supplier_monthly) ORDER BY 2 DESC""",
)(
    lambda spark, sf: round_to(
        supplier_monthly_df(spark, sf)
        .agg(F.abs(F.corr("y", "rev")).alias("rev"), F.abs(F.corr("y", "disc")).alias("disc"))
        .unpivot([], ["rev", "disc"], "feature", "importance"),
        importance=5,
    ).orderBy(F.col("importance").desc())
)
query(
    "k10_union_missing_columns",
    f"""{with_(SUPPLIER_MONTHLY, ORDERS_WEEKLY)}SELECT CAST(series AS VARCHAR) AS series, date, y, rev, disc, NULL::BIGINT AS n FROM supplier_monthly
UNION ALL SELECT series, date, y, NULL, NULL, n FROM orders_weekly""",
)(
    lambda spark, sf: rs.stack(
        [supplier_monthly_df(spark, sf).withColumn("series", F.col("series").cast("string")), orders_weekly_df(spark, sf)]
    )
)
query(
    "k11_champion_challenger",
    f"""{V}, m AS (SELECT model_type, round(avg("MAPE"), 5) AS m FROM validation GROUP BY 1),
a AS (SELECT model_type AS champion, m AS champion_metric FROM m WHERE model_type = 'last_value'),
b AS (SELECT model_type AS challenger, m AS challenger_metric FROM m WHERE model_type = 'sma_3')
SELECT *, CASE WHEN challenger_metric < champion_metric THEN challenger ELSE champion END AS chosen,
  challenger_metric < champion_metric AS swapped FROM a, b""",
)(
    lambda spark, sf: (
        lambda m: rs.champion_or_challenger(m.filter("model_type = 'last_value'"), m.filter("model_type = 'sma_3'"), "MAPE", "model_type")
    )(round_to(mt.mean_by(validation_report(spark, sf), ["model_type"], ["MAPE"]), MAPE=5))
)

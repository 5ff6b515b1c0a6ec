"""Fitted models, jobs and explanations: the remaining B, F and E rows of the inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.catalog.base import (
    supplier_panel, using,
    FLAG_MONTHLY, ORDER_ROWS, SUPPLIER_MONTHLY, flag_monthly_df, order_rows, order_rows_df, over, query, round_half_up, round_to, supplier_monthly, supplier_monthly_df, with_,
)
from seriesloom.catalog.reports import FORECAST_REPORT, forecast_report
from seriesloom.operators import calendar as cal
from seriesloom.operators import explain as ex
from seriesloom.operators import folds as fd
from seriesloom.operators import forecast as fc
from seriesloom.operators import metrics as mt
from seriesloom.operators import reshape as rs
from seriesloom.operators import simulated, smoothing
from seriesloom.operators import statistics as st
from seriesloom.operators.cleaning import last_rows
from seriesloom.operators.features import attach
from seriesloom.plans import config, jobs
from seriesloom.plans import models as md
from seriesloom.sources import sinks

SM = with_(SUPPLIER_MONTHLY)
SMALL = config.FeatureSet(target="y", lags=(1, 2), averages=(3,), exog_lags={"rev": (6,)})
TREES = md.ModelSpec("forest", {"numTrees": 5, "maxDepth": 4})
RIDGE = md.ModelSpec("ridge")
LINEAR = md.ModelSpec("linear")
HORIZON = 6


ONE_LAG = config.FeatureSet(target="y", lags=(1,))
_AR1 = f"""r AS (SELECT series, y, lag(y) {over()} AS x, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
f AS (SELECT series, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, CAST(regr_count(y, x) AS DOUBLE) AS n,
  regr_syy(y, x) * (1 - regr_r2(y, x)) AS rss, max(y) FILTER (back = 1) AS y0 FROM r GROUP BY 1),
s AS (SELECT series, 1 AS step, a + b * y0 AS p, 1.0::DOUBLE AS w, a, b, n, rss FROM f
  UNION ALL SELECT series, step + 1, a + b * p, w + pow(b, 2 * step), a, b, n, rss FROM s WHERE step < 6)"""
AR1 = f"WITH RECURSIVE {SUPPLIER_MONTHLY},\n{_AR1} "

query("f14_autoregression", f"{AR1}SELECT series, step, round(p, 4) AS prediction FROM s")(
    using(supplier_panel, lambda p: round_to(jobs.autoregression(p, "y", 1, HORIZON), prediction=4)))
query("f14_autoregression_five")(using(supplier_panel, lambda p: jobs.autoregression(p, "y", 5, HORIZON)))
query(
    "e08_forecast_interval",
    f"""{AR1}SELECT series, step, round(p, 4) AS prediction, round(p - 1.96::DOUBLE * sqrt(rss / (n - 2)) * sqrt(w), 3) AS lower,
  round(p + 1.96::DOUBLE * sqrt(rss / (n - 2)) * sqrt(w), 3) AS upper FROM s""",
)(
    using(supplier_panel, lambda p: round_to(
        jobs.autoregression(p, "y", 1, HORIZON, z=1.96), prediction=4, lower=3, upper=3
    )))


def _exog_sql(c: str, i: int) -> str:
    return f"""r{i} AS (SELECT series, {c} AS y, lag({c}) {over()} AS x, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
f{i} AS (SELECT series, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, max(y) FILTER (back = 1) AS y0 FROM r{i} GROUP BY 1),
s{i} AS (SELECT series, 1 AS step, a + b * y0 AS p, a, b FROM f{i} UNION ALL SELECT series, step + 1, a + b * p, a, b FROM s{i} WHERE step < 6)"""


query(
    "f11_exogenous_future",
    f"WITH RECURSIVE {SUPPLIER_MONTHLY},\n{_exog_sql('rev', 1)},\n{_exog_sql('disc', 2)} "
    "SELECT series, step, round(s1.p, 1) AS rev, round(s2.p, 4) AS disc FROM s1 JOIN s2 USING (series, step)",
)(using(supplier_panel, lambda p: round_to(jobs.exogenous_future(p, ["rev", "disc"], HORIZON, order=1), rev=1, disc=4)))
query("f11_exogenous_future_smoothed")(
    using(supplier_panel, lambda p: jobs.exogenous_future(p, ["rev", "disc"], HORIZON, method="smooth")))


def _fill_tail(p):
    future = cal.future_months(p.df, ["series"], "date", HORIZON).withColumns(
        {"rev": F.when(F.col("step") == 1, F.lit(1000.0)), "disc": F.lit(None).cast("double")}
    )
    return round_to(jobs.fill_exogenous(p, future, ["rev", "disc"], order=1), rev=1, disc=4)


query(
    "f11_exogenous_tail_filled",
    f"WITH RECURSIVE {SUPPLIER_MONTHLY},\n{_exog_sql('rev', 1)},\n{_exog_sql('disc', 2)}, m AS (SELECT series, max(date) AS last FROM supplier_monthly GROUP BY 1) "
    "SELECT series, step, CAST(last + to_months(step) AS DATE) AS date, CASE WHEN step = 1 THEN 1000 ELSE round(s1.p, 1) END AS rev, round(s2.p, 4) AS disc "
    "FROM s1 JOIN s2 USING (series, step) JOIN m USING (series)",
)(using(supplier_panel, _fill_tail))
_GRID_SQL = ", ".join(f"({g}, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for g, (a, b, c) in enumerate(smoothing.GRID.tolist()))
_SMOOTH_SQL = f"""WITH RECURSIVE {SUPPLIER_MONTHLY},
o AS (SELECT series, y, row_number() {over()} - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM supplier_monthly),
h AS (SELECT series, avg(y) FILTER (i < 12) AS l0, (avg(y) FILTER (i >= 12 AND i < 24) - avg(y) FILTER (i < 12)) / 12 AS t0, list(y ORDER BY i) FILTER (i < 12) AS f0
  FROM o WHERE n >= 24 GROUP BY 1),
g(g, a, b, c) AS (VALUES {_GRID_SQL}),
s AS (
  SELECT series, g, a, b, c, 0 AS i, l0 AS l, t0 AS t, list_transform(f0, lambda v: v - l0) AS z, 0.0::DOUBLE AS sse FROM h, g
  UNION ALL
  SELECT series, g, a, b, c, i + 1, l + 0.95::DOUBLE * t + a * e, 0.95::DOUBLE * t + b * e,
    list_transform(z, lambda v, k: CASE WHEN k = i % 12 + 1 THEN v + c * e ELSE v END), sse + CASE WHEN i >= 24 THEN e * e ELSE 0 END
  FROM (SELECT s.*, o.y - (s.l + 0.95::DOUBLE * s.t + s.z[s.i % 12 + 1]) AS e FROM s JOIN o ON o.series = s.series AND o.i = s.i)),
last AS (SELECT * FROM s QUALIFY i = max(i) OVER (PARTITION BY series)),
d AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY sse, g) AS best FROM last),
k AS (SELECT unnest(range(1, 13)) AS step)
SELECT series, CAST(step AS INTEGER) AS step, round(l + 0.95::DOUBLE * (1 - pow(0.95::DOUBLE, step)) / (1 - 0.95::DOUBLE) * t + z[(i + step - 1) % 12 + 1], 3) AS prediction
FROM d, k WHERE best = 1
UNION ALL SELECT series, CAST(step AS INTEGER), y FROM o, k WHERE n < 24 AND i = n - 1"""
query("f15_smoothing_checked", _SMOOTH_SQL)(
    using(supplier_monthly, lambda p: round_to(smoothing.smoothing_forecast(p, "y", 12, 12), prediction=3))
)
query("f15_smoothing")(using(supplier_panel, lambda p: smoothing.smoothing_forecast(p, "y", 12, 12)))
query("f15_smoothing_rows")(lambda spark, sf: smoothing.smoothing_forecast(order_rows(spark, sf), "y", 12, 12))


def _features(spark, sf, fs=SMALL):
    return fd.numbered(config.build(supplier_panel(spark, sf), fs)).df


def _fit_predict(spark, sf, spec, fs=SMALL):
    rows = _features(spark, sf, fs)
    names = config.output_names(fs)
    model = md.fit(spec, rows.filter("date < '2001-01-01'"), names, "y")
    return model.predict(rows.filter("date >= '2001-01-01'")).select("series", "date", "y", "prediction")


for _name, _spec in (
    ("forest", TREES), ("boosted", md.ModelSpec("boosted", {"maxIter": 3, "maxDepth": 3})), ("tree", md.ModelSpec("tree", {"maxDepth": 4})),
):
    query(f"f13_{_name}", spec=_spec)(lambda spark, sf, spec: _fit_predict(spark, sf, spec))
query("f14_ridge")(lambda spark, sf: _fit_predict(spark, sf, RIDGE))
_ONE_LAG_ROWS = f"x AS (SELECT series, date, y, coalesce(lag(y) {over()}, y) AS x FROM supplier_monthly)"
query(
    "f14_linear",
    f"""{SM[:-1]},\n{_ONE_LAG_ROWS}, f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM x WHERE date < DATE '2001-01-01')
SELECT series, date, y, round(a + b * x, 3) AS prediction FROM x, f WHERE date >= DATE '2001-01-01'""",
)(lambda spark, sf: round_to(_fit_predict(spark, sf, LINEAR, ONE_LAG), prediction=3))


def _tail(p):
    return fd.tail_split(p, "date", HORIZON)


def _stepwise(p, fs, spec):
    report, _ = jobs.stepwise_prediction(p, fs, spec, _tail(p), 0, HORIZON)
    return mt.with_report_metrics(report, ["series", "model_type", "window"], "date")


query("f09_stepwise_forest")(using(supplier_panel, lambda p: _stepwise(p, SMALL, TREES)))
query(
    "f09_stepwise_linear",
    f"""WITH RECURSIVE {SUPPLIER_MONTHLY}, x AS (SELECT series, date, y, lag(y) {over()} AS l, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
t AS (SELECT series, date, y, coalesce(l, y) AS x FROM x WHERE back > 6),
f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t),
e AS (SELECT round(avg(abs((y - a - b * x) / y)), 4) AS "TRAINING_MAPE", round(sqrt(avg(pow(y - a - b * x, 2))), 2) AS "TRAINING_RMSE" FROM t, f),
s AS (SELECT series, 1 AS step, a + b * y AS p FROM x, f WHERE back = 7 UNION ALL SELECT series, step + 1, a + b * p FROM s, f WHERE step < 6)
SELECT x.series, x.date, s.step, x.y AS actual, round(p, 3) AS forecast, 'linear' AS model_type, 0 AS "window", e.* FROM s JOIN x ON x.series = s.series AND x.back = 7 - s.step, e""",
)(
    using(supplier_panel, lambda p: round_to(jobs.stepwise_prediction(p, ONE_LAG, LINEAR, _tail(p), 0, HORIZON)[0], forecast=3))
)


def _walk(spark, sf):
    p = supplier_panel(spark, sf)
    folds = fd.end_anchored_folds(p, "date", 2, HORIZON)
    return jobs.walk_forward(p, SMALL, [TREES, RIDGE], folds, [0, 1], HORIZON)


query("b07_walk_forward")(lambda spark, sf: _walk(spark, sf)[0])
query("b07_walk_forward_importances")(lambda spark, sf: _walk(spark, sf)[1])
# One exogenous lag shorter than the horizon: y on lag(rev, 1), with rev forecast by its own AR(1) per series.
WITH_EXOG = config.FeatureSet(target="y", exog_lags={"rev": (1,)})
_EXOG_FOLD = """ar{k} AS (SELECT series, regr_slope(rev, rl) AS b, regr_intercept(rev, rl) AS a, max(rev) FILTER (back = {far} + 1) AS r0 FROM x WHERE back > {far} GROUP BY 1),
fit{k} AS (SELECT regr_slope(y, v) AS b, regr_intercept(y, v) AS a FROM (SELECT y, coalesce(rl, rev) AS v FROM x WHERE back > {far})),
p{k} AS (SELECT series, 1 AS step, r0 AS v, a, b FROM ar{k} UNION ALL SELECT series, step + 1, a + b * v, a, b FROM p{k} WHERE step < 6),
o{k} AS (SELECT p{k}.series, step, fit{k}.a + fit{k}.b * v AS p FROM p{k}, fit{k})"""
_EXOG_ROWS = f"""WITH RECURSIVE {SUPPLIER_MONTHLY}, x AS (SELECT series, date, y, rev, lag(rev) {over()} AS rl, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),"""


def _exog_walk(p):
    folds = fd.end_anchored_folds(p, "date", 2, HORIZON)
    return jobs.walk_forward(p, WITH_EXOG, [LINEAR], folds, [0, 1], exogenous={"order": 1})[0]


query(
    "b07_walk_forward_exogenous",
    f"""{_EXOG_ROWS}
{_EXOG_FOLD.format(k=0, far=12)}, {_EXOG_FOLD.format(k=1, far=6)}
SELECT x.series, x.date, o0.step, x.y AS actual, round(o0.p, 2) AS forecast, 0 AS "window" FROM o0 JOIN x ON x.series = o0.series AND x.back = 13 - o0.step
UNION ALL SELECT x.series, x.date, o1.step, x.y, round(o1.p, 2), 1 FROM o1 JOIN x ON x.series = o1.series AND x.back = 7 - o1.step""",
)(using(supplier_panel, lambda p: round_to(_exog_walk(p), forecast=2).select("series", "date", "step", "actual", "forecast", "window")))
query(
    "f10_inference_exogenous",
    f"""{_EXOG_ROWS}
{_EXOG_FOLD.format(k=0, far=0)}
SELECT o0.series, step, round(p, 2) AS forecast, CAST(date + to_months(step) AS DATE) AS date FROM o0 JOIN x ON x.series = o0.series AND back = 1""",
)(
    using(
        supplier_panel,
        lambda p: round_to(
            jobs.inference(p, WITH_EXOG, [md.fit(LINEAR, config.build(p, WITH_EXOG).df, config.output_names(WITH_EXOG), "y")], HORIZON, "2001-12-01", "month", exogenous={"order": 1}),
            forecast=2,
        ).select("series", "step", "forecast", "date"),
    )
)
query("b08_select_model")(lambda spark, sf: jobs.select_model(_walk(spark, sf)[0]))


def _train(spark, sf):
    return jobs.train_and_choose(supplier_panel(spark, sf), config.FeatureSet(target="y", lags=(1, 2), averages=(3,)), [TREES, RIDGE], 180, sinks.scratch_folder(spark))


query("f18_train_and_choose")(lambda spark, sf: _train(spark, sf)[1])


def _infer(spark, sf):
    p, fs = supplier_panel(spark, sf), config.FeatureSet(target="y", lags=(1, 2), averages=(3,))
    fitted, _ = jobs.train_and_choose(p, fs, [TREES, RIDGE], 180, keep_all=True)
    return jobs.inference(p, fs, fitted, HORIZON, "2001-12-01", "month")


query("f10_inference")(_infer)
_HOLD = f"""{SM}, x AS (SELECT series, date, y, coalesce(lag(y) {over()}, y) AS x, max(date) OVER (PARTITION BY series) AS last FROM supplier_monthly),
f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM x WHERE date < last - 180) """
query(
    "f18_train_linear",
    _HOLD + """SELECT 'linear' AS model_type, round(avg(abs((y - a - b * x) / y)), 6) AS "MAPE", round(sqrt(avg(pow(y - a - b * x, 2))), 4) AS "RMSE",
  round(avg(abs(y - a - b * x)), 4) AS "MAE" FROM x, f WHERE date >= last - 180""",
)(using(supplier_panel, lambda p: round_to(jobs.train_and_choose(p, ONE_LAG, [LINEAR], 180)[1], MAPE=6, RMSE=4, MAE=4)))
query(
    "f10_inference_linear",
    f"""WITH RECURSIVE {SUPPLIER_MONTHLY}, x AS (SELECT series, date, y, coalesce(lag(y) {over()}, y) AS x, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM x),
s AS (SELECT series, 1 AS step, a + b * y AS p, date AS last FROM x, f WHERE back = 1 UNION ALL SELECT series, step + 1, a + b * p, last FROM s, f WHERE step < 6)
SELECT series, step, round(p, 3) AS forecast, 'linear' AS model_type, CAST(last + to_months(step) AS DATE) AS date, DATE '2001-12-01' AS run_date FROM s""",
)(
    using(
        supplier_panel,
        lambda p: round_to(
            jobs.inference(p, ONE_LAG, [jobs.train_and_choose(p, ONE_LAG, [LINEAR], 180)[0]], HORIZON, "2001-12-01", "month"), forecast=3
        ),
    )
)
query("f19_grid_search")(
    using(supplier_panel, lambda p: jobs.grid_search(p, config.FeatureSet(target="y", lags=(1, 2)), "ridge", 2, 6)[0].drop("params")))
query("f20_random_search")(
    using(supplier_panel, lambda p: jobs.random_search(p, config.FeatureSet(target="y", lags=(1, 2)), "ridge", 2, HORIZON)))
query(
    "f21_feature_subsets",
    f"""{SM}, x AS (SELECT year(date) AS fold, y, rev, disc FROM supplier_monthly), k AS (SELECT DISTINCT fold FROM x),
f AS (SELECT k.fold, regr_slope(y, rev) AS br, regr_intercept(y, rev) AS ar, regr_slope(y, disc) AS bd, regr_intercept(y, disc) AS ad
  FROM k JOIN x ON x.fold <> k.fold GROUP BY 1)
SELECT 'rev' AS features, 1 AS size, round(avg(pow(y - ar - br * rev, 2)), 3) AS mse FROM x JOIN f USING (fold)
UNION ALL SELECT 'disc', 1, round(avg(pow(y - ad - bd * disc, 2)), 3) FROM x JOIN f USING (fold)""",
)(
    lambda spark, sf: round_to(
        md.subset_scores(supplier_monthly_df(spark, sf).withColumn("fold", F.year("date")), "fold", ["rev", "disc"], "y", spark, most=1), mse=3
    )
)
query("f21_feature_subsets_all")(
    lambda spark, sf: md.subset_scores(_features(spark, sf).withColumn("fold", F.year("date")), "fold", config.output_names(SMALL), "y", spark)
)
_BOTH = """f2 AS (SELECT k.fold, (covar_pop(y, rev) * var_pop(disc) - covar_pop(y, disc) * covar_pop(rev, disc)) / (var_pop(rev) * var_pop(disc) - pow(covar_pop(rev, disc), 2)) AS br,
  (covar_pop(y, disc) * var_pop(rev) - covar_pop(y, rev) * covar_pop(rev, disc)) / (var_pop(rev) * var_pop(disc) - pow(covar_pop(rev, disc), 2)) AS bd, avg(y) AS my, avg(rev) AS mr, avg(disc) AS md
  FROM k JOIN x ON x.fold <> k.fold GROUP BY 1)"""
query(
    "f21_feature_subsets_powerset",
    f"""{SM}, x AS (SELECT year(date) AS fold, y, rev, disc FROM supplier_monthly), k AS (SELECT DISTINCT fold FROM x),
f AS (SELECT k.fold, regr_slope(y, rev) AS br, regr_intercept(y, rev) AS ar, regr_slope(y, disc) AS bd, regr_intercept(y, disc) AS ad
  FROM k JOIN x ON x.fold <> k.fold GROUP BY 1), {_BOTH}
SELECT 'rev' AS features, 1 AS size, round(avg(pow(y - ar - br * rev, 2)), 3) AS mse FROM x JOIN f USING (fold)
UNION ALL SELECT 'disc', 1, round(avg(pow(y - ad - bd * disc, 2)), 3) FROM x JOIN f USING (fold)
UNION ALL SELECT 'rev,disc', 2, round(avg(pow(y - my - br * (rev - mr) - bd * (disc - md), 2)), 3) FROM x JOIN f2 USING (fold)""",
)(
    lambda spark, sf: round_to(
        md.subset_scores(supplier_monthly_df(spark, sf).withColumn("fold", F.year("date")), "fold", ["rev", "disc"], "y", spark), mse=3
    )
)
query("x16_linear_report")(using(supplier_panel, lambda p: jobs.linear_report(p.df, "y", ["rev", "disc"], 0.2)[1]))
_TWO = """c AS (SELECT {keep}covar_pop(y, rev) AS yr, covar_pop(y, disc) AS yd, var_pop(rev) AS rr, var_pop(disc) AS dd, covar_pop(rev, disc) AS rd,
  avg(y) AS my, avg(rev) AS mr, avg(disc) AS md FROM {src}),
b AS (SELECT *, (yr * dd - yd * rd) / (rr * dd - rd * rd) AS br, (yd * rr - yr * rd) / (rr * dd - rd * rd) AS bd FROM c)"""
query("x16_linear_report_coefficients", f"""{SM}, {_TWO.format(keep='', src='supplier_monthly')}
SELECT 'rev' AS feature, round(br, 8) AS coefficient, round(my - br * mr - bd * md, 4) AS intercept FROM b
UNION ALL SELECT 'disc', round(bd, 8), round(my - br * mr - bd * md, 4) FROM b""")(using(supplier_panel, lambda p: round_to(jobs.linear_report(p.df, "y", ["rev", "disc"])[0], coefficient=8, intercept=4)))


def _corrected(spark, sf):
    p = supplier_panel(spark, sf)
    fitted = fc.seasonal_fitted(p, "y", 12)
    residuals = fitted.with_df(fitted.df.filter("fitted IS NOT NULL").select("series", "date", (F.col("y") - F.col("fitted")).alias("residual")))
    return jobs.residual_correction(fc.seasonal_naive(p, "y", 12, HORIZON), residuals, "residual", 1, HORIZON)


query(
    "f17_residual_correction",
    f"""WITH RECURSIVE {SUPPLIER_MONTHLY}, q AS (SELECT series, date, y, y - lag(y, 12) {over()} AS e, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
r AS (SELECT series, e, lag(e) {over()} AS x, back FROM q WHERE e IS NOT NULL),
f AS (SELECT series, regr_slope(e, x) AS b, regr_intercept(e, x) AS a, max(e) FILTER (back = 1) AS e0 FROM r GROUP BY 1),
s AS (SELECT series, 1 AS step, a + b * e0 AS p, a, b FROM f UNION ALL SELECT series, step + 1, a + b * p, a, b FROM s WHERE step < 6)
SELECT s.series, s.step, q.y AS prediction, round(s.p, 4) AS residual_forecast, round(q.y + s.p, 4) AS corrected
FROM s JOIN q ON q.series = s.series AND q.back = 13 - s.step""",
)(lambda spark, sf: round_to(_corrected(spark, sf), residual_forecast=4, corrected=4))


def _parts(spark, sf):
    p = st.decompose(supplier_panel(spark, sf), "y", 12)
    df = p.df.withColumns({"yhat": F.col("trend") + F.col("seasonal"), "lower": F.col("trend") - 10, "upper": F.col("trend") + 20})
    return fc.split_forecast(df, "trend", "seasonal", "yhat", "lower", "upper")


query(
    "f22_forecast_parts",
    f"""{SM}, t AS (SELECT *, (row_number() {over()} - 1) % 12 AS ph FROM supplier_monthly),
c AS (SELECT *, CASE WHEN count(y) {over('ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING')} = 13 THEN
  (sum(y) {over('ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING')} - (lag(y, 6) {over()} + lead(y, 6) {over()}) / 2) / 12 END AS trend FROM t),
p AS (SELECT series, ph, avg(y - trend) AS pm FROM c GROUP BY 1, 2), q AS (SELECT series, ph, pm - avg(pm) OVER (PARTITION BY series) AS seasonal FROM p)
SELECT series, date, round(trend + seasonal, 4) AS baseline, round(-10 - seasonal, 4) AS unexplained_lower, round(20 - seasonal, 4) AS unexplained_upper
FROM (SELECT series, date, trend, CASE WHEN trend IS NOT NULL THEN seasonal END AS seasonal FROM c JOIN q USING (series, ph))""",
)(
    lambda spark, sf: round_to(
        _parts(spark, sf).select("series", "date", "baseline", "unexplained_lower", "unexplained_upper"),
        baseline=4, unexplained_lower=4, unexplained_upper=4,
    )
)

# -- explanations and intervals ----------------------------------------------------------------

query("e01_importances")(
    lambda spark, sf: md.fit(TREES, _features(spark, sf), config.output_names(SMALL), "y").importances(spark).orderBy(F.col("importance").desc())
)
_COEF = {"rev": 0.0005, "disc": 1.5}
query(
    "e02_linear_contributions",
    f"""{SM}SELECT series, date, round(0.0005::DOUBLE * (rev - avg(rev) OVER ()), 4) AS rev, round(1.5::DOUBLE * (disc - avg(disc) OVER ()), 4) AS disc
FROM supplier_monthly""",
)(using(supplier_panel, lambda p: round_to(ex.linear_contributions(p.df, ["series", "date"], _COEF), rev=4, disc=4)))
query(
    "e03_rescaled_contributions",
    f"""{with_(FORECAST_REPORT)}, w AS (SELECT series, date, actual, max(forecast) FILTER (model_type = 'sma_3') AS a, max(forecast) FILTER (model_type = 'last_value') AS b
  FROM report GROUP BY 1, 2, 3)
SELECT series, date, round(a * ((actual - b) / nullif(a + b, 0)), 3) AS a, round(b * ((actual - b) / nullif(a + b, 0)), 3) AS b FROM w WHERE a IS NOT NULL""",
)(
    lambda spark, sf: round_to(
        ex.rescaled_contributions(
            rs.pivot_mean(forecast_report(spark, sf), ["series", "date", "actual"], "model_type", "forecast", ["sma_3", "last_value"])
            .select("series", "date", "actual", F.col("sma_3").alias("a"), F.col("last_value").alias("b"), F.col("last_value").alias("last"))
            .filter("a IS NOT NULL"),
            ["a", "b"], "actual", "last",
        ).select("series", "date", "a", "b"),
        a=3, b=3,
    )
)


def _interval(spark, sf):
    r = forecast_report(spark, sf).filter("model_type = 'sma_3'")
    per = r.groupBy("series").agg(mt.rmse("actual", "forecast").alias("rmse"))
    return r.join(per, "series").withColumns(ex.interval("forecast", "rmse", 80)).select(
        "series", "date", *[round_half_up(c, 3).alias(c) for c in ("half_width", "lower", "upper")]
    )


query(
    "e04_error_interval",
    f"""{with_(FORECAST_REPORT)}, r AS (SELECT *, 1.2815515655446004::DOUBLE * sqrt(avg((actual - forecast) * (actual - forecast)) OVER (PARTITION BY series)) AS h
  FROM report WHERE model_type = 'sma_3')
SELECT series, date, round(h, 3) AS half_width, round(forecast - h, 3) AS lower, round(forecast + h, 3) AS upper FROM r""",
)(_interval)
query(
    "e05_draw_interval",
    f"""{with_(ORDER_ROWS)}SELECT series, round(quantile_cont(y, 0.05), 4) AS lower, round(quantile_cont(y, 0.95), 4) AS upper FROM order_rows GROUP BY 1""",
)(lambda spark, sf: round_to(ex.draw_interval(order_rows_df(spark, sf), ["series"], "y", rows_per_task=2_000), lower=4, upper=4))
query(
    "e06_bin_probabilities",
    f"""{with_(ORDER_ROWS)}, d AS (SELECT series, date_trunc('month', date)::DATE AS date, y FROM order_rows),
l AS (SELECT series, arg_max(y, (date, id)) AS last FROM order_rows GROUP BY 1), t AS (SELECT series, date, count(*) AS n FROM d GROUP BY 1, 2),
b AS (SELECT series, date, floor(y / 25000) * 25000 AS bin_lo, count(*) AS c FROM d GROUP BY 1, 2, 3)
SELECT series, date, bin_lo, round(c / n, 6) AS probability, round(last, 4) AS last, round(bin_lo - last, 4) AS delta_lo, round(bin_lo + 25000 - last, 4) AS delta_hi
FROM b JOIN t USING (series, date) JOIN l USING (series)""",
)(
    lambda spark, sf: (
        lambda d: round_to(
            ex.bin_probabilities(
                attach(
                    d.select("series", F.trunc("date", "MM").alias("date"), "y"),
                    last_rows(d, ["series"], ["date", "id"], 1).select("series", F.col("y").alias("last")), ["series"],
                ),
                ["series", "date"], "y", 25000.0, "last",
            ),
            probability=6, last=4, delta_lo=4, delta_hi=4,
        )
    )(order_rows_df(spark, sf))
)


def _draws(spark, sf):
    p = supplier_panel(spark, sf)
    rows = config.build(p, config.FeatureSet(target="y", lags=(1,))).df
    model = md.fit(RIDGE, rows, ["rev", "disc"], "y")
    future = cal.future_months(p.df, ["series"], "date", 3)
    drawn = ex.simulated_inputs(p.df, future, ["series", "date"], ["series"], ["rev", "disc"], 50)
    return ex.draw_interval(model.predict(drawn), ["series", "date"], "prediction")


query("e07_simulated_forecasts")(_draws)


DRAWS = 10_000
# Most distance between what the draws show and what the normal law says, in standard errors.
OFF = 6
# Standard errors around a bound's place in that law between which the draws are looked at first.
LIKELY = 3


def _simulated(spark, sf):
    """Mean, deviation and bounds of 10^4 forecasts per supplier and month, against the normal law that a linear model gives them."""
    p = supplier_panel(spark, sf)
    model = md.fit(LINEAR, p.df, ["rev", "disc"], "y")
    future = cal.future_months(p.df, ["series"], "date", 3)
    moments = p.df.groupBy("series").agg(F.avg("rev").alias("rev"), F.avg("disc").alias("disc"), F.stddev_samp("rev").alias("sr"), F.stddev_samp("disc").alias("sd"))
    b = model.coefficients()
    wide = F.sqrt(F.pow(b["rev"] * F.col("sr"), F.lit(2)) + F.pow(b["disc"] * F.col("sd"), F.lit(2)))
    law = session.cut(model.predict(moments).select("series", F.col("prediction").alias("expected"), wide.alias("spread")))
    centre = F.col("expected")
    # Standard errors of the mean, the deviation and the 5 % quantile, for a spread of 1.
    error = {"mean": DRAWS**-0.5, "deviation": (2 * DRAWS) ** -0.5, "bound": (0.05 * 0.95 / DRAWS) ** 0.5 / 0.10313564}
    z = ex.Z_FOR_COVERAGE[90]
    at = lambda side: [centre + (side * z + k * error["bound"]) * F.col("spread") for k in (-LIKELY, LIKELY)]
    found = simulated.drawn_quantiles(
        attach(ex.with_moments(p.df, future, ["series"], ["rev", "disc"]), law, ["series"]),
        lambda points: model.predict(ex.drawn_inputs(points, ["series", "date"], ["rev", "disc"], DRAWS)),
        ["series", "date"], "prediction", {"lower": 0.05, "upper": 0.95}, near={"lower": at(-1), "upper": at(1)},
    )
    rows = attach(found, law, ["series"])
    near = lambda c, centre, e: (F.abs(F.col(c) - centre) <= OFF * error[e] * F.col("spread")).alias(f"{c}_near")
    return rows.select(
        "series", "date", "n", F.round("expected", 3).alias("expected"), F.round("spread", 3).alias("spread"), near("mean", centre, "mean"),
        near("deviation", F.col("spread"), "deviation"), near("lower", centre - z * F.col("spread"), "bound"), near("upper", centre + z * F.col("spread"), "bound"),
    )


query(
    "e07_simulated_bounds",
    f"""{SM}, {_TWO.format(keep='', src='supplier_monthly')},
m AS (SELECT series, max(date) AS last, avg(rev) AS rev, avg(disc) AS disc, stddev_samp(rev) AS sr, stddev_samp(disc) AS sd FROM supplier_monthly GROUP BY 1),
n AS (SELECT series, last, my + br * (rev - mr) + bd * (disc - md) AS expected, sqrt(br * br * sr * sr + bd * bd * sd * sd) AS spread FROM m, b)
SELECT series, CAST(last + to_months(CAST(step AS INTEGER)) AS DATE) AS date, CAST(CASE WHEN spread IS NULL THEN 0 ELSE {DRAWS} END AS BIGINT) AS n, round(expected, 3) AS expected, round(spread, 3) AS spread,
  CASE WHEN spread IS NOT NULL THEN true END AS mean_near, CASE WHEN spread IS NOT NULL THEN true END AS deviation_near,
  CASE WHEN spread IS NOT NULL THEN true END AS lower_near, CASE WHEN spread IS NOT NULL THEN true END AS upper_near
FROM n, (SELECT unnest([1, 2, 3]) AS step)""",
)(_simulated)


def _flag_contributions(spark, sf):
    model = md.fit(md.ModelSpec("linear"), flag_monthly_df(spark, sf), ["rev", "disc"], "y")
    return ex.linear_contributions(flag_monthly_df(spark, sf), ["series", "date"], model.coefficients())


query(
    "e02_fitted_contributions",
    f"""{with_(FLAG_MONTHLY)}, {_TWO.format(keep='', src='flag_monthly')}
SELECT series, date, round(br * (rev - mr), 3) AS rev, round(bd * (disc - md), 3) AS disc FROM flag_monthly, b""",
)(lambda spark, sf: round_to(_flag_contributions(spark, sf), rev=3, disc=3))

"""Models per series, and linear backtests and searches from one pass: the rest of the B, F and E rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.catalog.base import SUPPLIER_MONTHLY, over, query, round_to, supplier_panel, using, with_
from seriesloom.catalog.reports import FORECAST_REPORT, forecast_report
from seriesloom.operators import folds as fd
from seriesloom.operators import series_trees as trees
from seriesloom.operators.features import attach
from seriesloom.plans import config, fold_fits, jobs
from seriesloom.plans import models as md
from seriesloom.plans import series_models as sm
from seriesloom.sources import sinks

HORIZON = 6

# -- trees per series ---------------------------------------------------------------------------

BINS, LEAST = 16, 2
THREE = config.FeatureSet(target="y", lags=(1, 2), exog_lags={"rev": (6,)})
TWO_LAGS = config.FeatureSet(target="y", lags=(1, 2))


def tree_sql(rows: str, n: int, tag: str = "") -> str:
    """Depth-2 trees of the rows of ``rows`` (series, y, x0, x1, ...) by search over every cut of every node, as tables tree<tag> with one row per series."""
    limits = ", ".join(f"min(x{i}) AS lo{i}, max(x{i}) AS hi{i}" for i in range(n))
    bins = ", ".join(f"CASE WHEN hi{i} > lo{i} THEN CAST(least(floor((x{i} - lo{i}) / nullif(hi{i} - lo{i}, 0) * {BINS}), {BINS - 1}) AS INTEGER) ELSE 0 END AS b{i}" for i in range(n))
    listed = ", ".join(f"b{i}" for i in range(n))
    lows, highs = (", ".join(f"{x}{i}" for i in range(n)) for x in ("lo", "hi"))

    def search(source: str, out: str) -> str:
        return f"""h{out} AS (SELECT series, node, f, b, count(*) AS n, sum(y) AS s FROM {source} GROUP BY ALL),
c{out} AS (SELECT series, node, f, b, sum(n) OVER (PARTITION BY series, node, f ORDER BY b) AS ln, sum(s) OVER (PARTITION BY series, node, f ORDER BY b) AS ls,
  sum(n) OVER (PARTITION BY series, node, f) AS n, sum(s) OVER (PARTITION BY series, node, f) AS s FROM h{out}),
{out} AS (SELECT * FROM (SELECT *, ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n AS gain FROM c{out} WHERE ln >= {LEAST} AND n - ln >= {LEAST}) WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY series, node ORDER BY gain DESC, f, b) = 1)"""

    cut = lambda a: f"[{lows}][{a}.f + 1] + ([{highs}][{a}.f + 1] - [{lows}][{a}.f + 1]) * ({a}.b + 1) / {BINS}"
    return f"""lim{tag} AS (SELECT series, count(*) AS n, sum(y) AS s, {limits} FROM {rows} GROUP BY 1 HAVING count(*) >= {2 * LEAST}),
bin{tag} AS (SELECT r.series, y, {bins} FROM {rows} r JOIN lim{tag} USING (series)),
one{tag} AS (SELECT series, 1 AS node, y, unnest(range(0, {n})) AS f, unnest([{listed}]) AS b FROM bin{tag}),
{search(f'one{tag}', f'u{tag}')},
two{tag} AS (SELECT bin{tag}.series, 2 + CAST([{listed}][u{tag}.f + 1] > u{tag}.b AS INTEGER) AS node, y, unnest(range(0, {n})) AS f, unnest([{listed}]) AS b FROM bin{tag} JOIN u{tag} USING (series)),
{search(f'two{tag}', f'v{tag}')},
tree{tag} AS (SELECT l.series, l.s / l.n AS v1, a.f AS f1, {cut('a')} AS t1, a.gain AS g1, a.ls / a.ln AS v2, (a.s - a.ls) / (a.n - a.ln) AS v3,
  p.f AS f2, {cut('p')} AS t2, p.gain AS g2, p.ls / p.ln AS v4, (p.s - p.ls) / (p.n - p.ln) AS v5,
  q.f AS f3, {cut('q')} AS t3, q.gain AS g3, q.ls / q.ln AS v6, (q.s - q.ls) / (q.n - q.ln) AS v7
  FROM lim{tag} l LEFT JOIN u{tag} a ON a.series = l.series LEFT JOIN v{tag} p ON p.series = l.series AND p.node = 2 LEFT JOIN v{tag} q ON q.series = l.series AND q.node = 3)"""


def leaf_sql(values: str) -> str:
    """The value of a tree for a list of feature values."""
    pick = lambda k: f"{values}[f{k} + 1] > t{k}"
    return (f"CASE WHEN f1 IS NULL THEN v1 WHEN {pick(1)} THEN CASE WHEN f3 IS NULL THEN v3 WHEN {pick(3)} THEN v7 ELSE v6 END "
            f"ELSE CASE WHEN f2 IS NULL THEN v2 WHEN {pick(2)} THEN v5 ELSE v4 END END")


_ROWS3 = f"""x AS (SELECT series, date, y, lag(y) {over()} AS x0, lag(y, 2) {over()} AS x1, lag(rev, 6) {over()} AS x2 FROM supplier_monthly),
t AS (SELECT * FROM x WHERE date < DATE '2001-01-01' AND x0 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL)"""
_TREES3 = f"{with_(SUPPLIER_MONTHLY)[:-1]},\n{_ROWS3},\n{tree_sql('t', 3)}"
_GAINS = " UNION ALL ".join(f"SELECT series, f{k} AS f, g{k} AS g FROM tree WHERE f{k} IS NOT NULL" for k in (1, 2, 3))
_NAMES = "(VALUES (0, 'y_lag_1'), (1, 'y_lag_2'), (2, 'rev_lag_6')) n(f, feature)"


def _three(spark, sf):
    rows = config.build(supplier_panel(spark, sf), THREE, fill=None).df
    models = trees.fit(rows.filter("date < '2001-01-01'"), ["series"], config.output_names(THREE), "y", depth=2, bins=BINS, min_rows=LEAST)
    return rows, models


def _tree_predictions(spark, sf):
    rows, models = _three(spark, sf)
    value = trees.predicted([F.col(x) for x in config.output_names(THREE)])
    return round_to(attach(rows.filter("date >= '2001-01-01'"), models, ["series"]).select("series", "date", "y", value.alias("prediction")), prediction=4)


query("f13_series_tree", f"{_TREES3}\nSELECT x.series, date, y, round({leaf_sql('[x0, x1, x2]')}, 4) AS prediction FROM x LEFT JOIN tree USING (series) WHERE date >= DATE '2001-01-01'")(_tree_predictions)
query(
    "e01_series_tree_importances",
    f"""{_TREES3}, g AS ({_GAINS}), s AS (SELECT tree.series, feature, coalesce(sum(g.g), 0) AS gain FROM tree CROSS JOIN {_NAMES} LEFT JOIN g ON g.series = tree.series AND g.f = n.f GROUP BY 1, 2)
SELECT series, feature, round(gain, 3) AS gain, round(coalesce(gain / nullif(sum(gain) OVER (PARTITION BY series), 0), 0), 6) AS importance FROM s""",
)(lambda spark, sf: round_to(trees.importances(_three(spark, sf)[1], ["series"], config.output_names(THREE)), gain=3, importance=6))
query(
    "k09_tree_importances",
    f"""{_TREES3}, g AS ({_GAINS}) SELECT feature, round(sum(g) / (SELECT sum(g) FROM g), 6) AS importance FROM g JOIN {_NAMES} USING (f) GROUP BY 1 ORDER BY 2 DESC, 1""",
)(lambda spark, sf: round_to(sm.sorted_importances(_three(spark, sf)[1], ["series"], config.output_names(THREE), trees.MODEL), importance=6))

# -- the best model of every series: trained, saved, loaded, run ----------------------------------

_TRIED = sm.Candidates(kinds=(sm.LINEAR, sm.TREE), depth=2, bins=BINS, min_rows=LEAST)
_DAYS = 180


def linear_sql(rows: str, tag: str) -> str:
    return f"""lin{tag} AS (SELECT series, (yr * dd - yd * rd) / (rr * dd - rd * rd) AS c0, (yd * rr - yr * rd) / (rr * dd - rd * rd) AS c1, my, mr, md FROM (
  SELECT series, covar_pop(y, x0) AS yr, covar_pop(y, x1) AS yd, var_pop(x0) AS rr, var_pop(x1) AS dd, covar_pop(x0, x1) AS rd, avg(y) AS my, avg(x0) AS mr, avg(x1) AS md FROM {rows} GROUP BY 1))"""


_CHOICE = f"""x AS (SELECT series, date, y, lag(y) {over()} AS x0, lag(y, 2) {over()} AS x1, max(date) OVER (PARTITION BY series) AS last FROM supplier_monthly),
a AS (SELECT * FROM x WHERE x0 IS NOT NULL AND x1 IS NOT NULL), t AS (SELECT * FROM a WHERE date < last - {_DAYS}),
{tree_sql('t', 2)}, {linear_sql('t', '')},
p AS (SELECT a.series, y, unnest(['linear', 'tree']) AS model_type, unnest([my + c0 * (x0 - mr) + c1 * (x1 - md), {leaf_sql('[x0, x1]')}]) AS p
  FROM a JOIN tree USING (series) JOIN lin USING (series) WHERE date >= last - {_DAYS}),
score AS (SELECT series, model_type, avg(abs((y - p) / y)) AS m, sqrt(avg(pow(y - p, 2))) AS r, avg(abs(y - p)) AS e FROM p GROUP BY 1, 2)"""
query("f18_series_models", f"""{with_(SUPPLIER_MONTHLY)[:-1]}, {_CHOICE}
SELECT series, model_type, round(m, 6) AS "MAPE", round(r, 4) AS "RMSE", round(e, 4) AS "MAE", m = min(m) OVER (PARTITION BY series) AS chosen FROM score""")(
    using(supplier_panel, lambda p: _chosen(*sm.train(p, TWO_LAGS, _DAYS, _TRIED)))
)


def _chosen(models, scores):
    best = models.select("series", F.col("model_type").alias("best"))
    return round_to(attach(scores, best, ["series"]).withColumn("chosen", F.col("best") == F.col("model_type")).drop("best"), MAPE=6, RMSE=4, MAE=4)


def _trained_and_run(spark, sf):
    p = supplier_panel(spark, sf)
    models, _ = sm.train(p, TWO_LAGS, _DAYS, _TRIED)
    path = f"{sinks.scratch_folder(spark)}/models"
    sm.save(models.limit(0), path, "2001-11-01")
    sm.save(models, path, "2001-12-01")
    sm.save(models, path, "2001-12-01")  # a job that is run again
    out = sm.infer(p, TWO_LAGS, sm.load(spark, path), HORIZON, "2001-12-01")
    return round_to(out, forecast=3).drop("error")


query(
    "f10_series_models",
    f"""WITH RECURSIVE {SUPPLIER_MONTHLY}, {_CHOICE}, {tree_sql('a', 2, '_all')}, {linear_sql('a', '_all')},
best AS (SELECT series, arg_min(model_type, (m, model_type)) AS model_type FROM score GROUP BY 1),
back AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
start AS (SELECT series, max(y) FILTER (back = 1) AS l0, max(y) FILTER (back = 2) AS l1 FROM back GROUP BY 1),
s(series, step, l0, l1, p) AS (
  SELECT series, 0, l1, NULL::DOUBLE, l0 FROM start
  UNION ALL
  SELECT series, step + 1, l0, l1, CASE model_type WHEN 'tree' THEN {leaf_sql('[l0, l1]')} ELSE my + c0 * (l0 - mr) + c1 * (l1 - md) END
  FROM (SELECT series, step, p AS l0, l0 AS l1 FROM s WHERE step < {HORIZON}) JOIN best USING (series) JOIN tree_all USING (series) JOIN lin_all USING (series))
SELECT series, step, round(p, 3) AS forecast, model_type, DATE '2001-12-01' AS run_date FROM s JOIN best USING (series) WHERE step > 0""",
)(_trained_and_run)

# -- linear models of all folds ---------------------------------------------------------------------

ONE_LAG = config.FeatureSet(target="y", lags=(1,))
RIDGES = (0.0, 0.25)


def walk_sql(folds: str, models: str) -> str:
    return f"""WITH RECURSIVE {SUPPLIER_MONTHLY}, x AS (SELECT series, date, y, coalesce(lag(y) {over()}, y) AS x, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
k("window", far) AS (VALUES {folds}), m(model_type, ridge) AS (VALUES {models}),
t AS (SELECT * FROM x JOIN k ON back > far),
fit AS (SELECT "window", model_type, covar_pop(y, x) / (var_pop(x) * (1 + ridge)) AS b, avg(y) AS my, avg(x) AS mx FROM t, m GROUP BY "window", model_type, ridge),
e AS (SELECT "window", model_type, round(avg(abs((y - my - b * (x - mx)) / y)), 4) AS "TRAINING_MAPE", round(sqrt(avg(pow(y - my - b * (x - mx), 2))), 2) AS "TRAINING_RMSE" FROM t JOIN fit USING ("window") GROUP BY 1, 2),
s("window", model_type, series, step, x, p, "REFERENCE_DATE", "REFERENCE_PIX", far) AS (
  SELECT "window", model_type, series, 0, NULL::DOUBLE, y, date, y, far FROM t JOIN fit USING ("window") WHERE back = far + 1
  UNION ALL
  SELECT s."window", s.model_type, series, step + 1, p, my + b * (p - mx), "REFERENCE_DATE", "REFERENCE_PIX", far FROM s JOIN fit ON fit."window" = s."window" AND fit.model_type = s.model_type WHERE step < 6),
w AS (SELECT s.series, x.date, step, x.y AS actual, p AS forecast, model_type, "window", "TRAINING_MAPE", "TRAINING_RMSE", "REFERENCE_DATE", "REFERENCE_PIX", b * (s.x - mx) AS contribution_y_lag_1, my AS base
  FROM s JOIN x ON x.series = s.series AND x.back = far + 1 - step JOIN fit USING ("window", model_type) JOIN e USING ("window", model_type) WHERE step > 0),
r AS (SELECT series, model_type, "window", round(avg(abs((actual - forecast) / actual)), 4) AS "MAPE", round(sqrt(avg(pow(actual - forecast, 2))), 2) AS "RMSE" FROM w GROUP BY 1, 2, 3)
"""


_WALK = walk_sql("(0, 12), (1, 6)", "('linear', 0::DOUBLE), ('ridge_0.25', 0.25::DOUBLE)")


def _walk(p):
    return fold_fits.walk_forward(p, ONE_LAG, fd.end_anchored_folds(p, "date", 2, HORIZON), "2001-12-01", RIDGES)


query(
    "b07_walk_forward_linear",
    _WALK + """SELECT series, date, step, actual, round(forecast, 3) AS forecast, model_type, "window", "TRAINING_MAPE", "TRAINING_RMSE", "MAPE", "RMSE", 'validation' AS class,
  DATE '2001-12-01' AS "TRAINING_DATE", "REFERENCE_DATE", "REFERENCE_PIX", round(contribution_y_lag_1, 3) AS contribution_y_lag_1, round(base, 3) AS base FROM w JOIN r USING (series, model_type, "window")""",
)(
    using(supplier_panel, lambda p: round_to(_walk(p), forecast=3, contribution_y_lag_1=3, base=3).select(
        "series", "date", "step", "actual", "forecast", "model_type", "window", "TRAINING_MAPE", "TRAINING_RMSE", "MAPE", "RMSE", "class",
        "TRAINING_DATE", "REFERENCE_DATE", "REFERENCE_PIX", "contribution_y_lag_1", "base"))
)
query("b08_select_model_linear", _WALK + """SELECT model_type AS best_model, round(avg("MAPE"), 6) AS best_metric FROM r GROUP BY 1 ORDER BY avg("MAPE"), 1 LIMIT 1""")(
    using(supplier_panel, lambda p: round_to(jobs.select_model(_walk(p)), best_metric=6))
)

# -- searches ---------------------------------------------------------------------------------------

_GRID = (0.01, 0.1, 1.0)


def _searched(spark, sf):
    """The tuning table, with a mark on the row of the best parameters as they were saved and read back."""
    p = supplier_panel(spark, sf)
    table = fold_fits.ridge_grid(p, ONE_LAG, fd.end_anchored_folds(p, "date", 2, HORIZON), _GRID)
    folder = f"{sinks.scratch_folder(spark)}/best"
    sinks.write_params(md.best_params(table), folder)
    spec = md.read_spec(spark, folder, "ridge")
    return round_to(table.withColumn("best", F.col("params") == F.lit(fold_fits.saved(spec.params["ridge"]))), mape=6, rmse=4)


query(
    "f19_grid_search_linear",
    f"""{with_(SUPPLIER_MONTHLY)[:-1]}, x AS (SELECT y, coalesce(lag(y) {over()}, y) AS x, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
k(fold, far) AS (VALUES (0, 12), (1, 6)), g(ridge, params) AS (VALUES (0.01::DOUBLE, '{{"ridge":0.01}}'), (0.1::DOUBLE, '{{"ridge":0.1}}'), (1.0::DOUBLE, '{{"ridge":1.0}}')),
f AS (SELECT fold, far, params, covar_pop(y, x) / (var_pop(x) * (1 + ridge)) AS b, avg(y) AS my, avg(x) AS mx FROM x JOIN k ON back > far, g GROUP BY fold, far, params, ridge),
s AS (SELECT 'ridge' AS kind, params, fold, avg(abs((y - my - b * (x - mx)) / y)) AS mape, sqrt(avg(pow(y - my - b * (x - mx), 2))) AS rmse FROM f JOIN x ON back <= far AND back > far - 6 GROUP BY 2, 3),
b AS (SELECT arg_min(params, (m, params)) AS best FROM (SELECT params, avg(mape) AS m FROM s GROUP BY 1))
SELECT kind, params, fold, round(mape, 6) AS mape, round(rmse, 4) AS rmse, params = best AS best FROM s, b""",
)(_searched)
query(
    "f20_random_search_linear",
    walk_sql("(0, 6)", ", ".join(f"('{i}', pow(10, -3 + 4 * (CAST('0x' || sha256('7:{i}')[1:8] AS BIGINT) / 4294967296)))" for i in range(4)))
    + "SELECT CAST(model_type AS INTEGER) AS trial, round(avg(pow(actual - forecast, 2)), 2) AS mse FROM w GROUP BY 1",
)(using(supplier_panel, lambda p: round_to(fold_fits.random_search(p, ONE_LAG, 4, HORIZON, "2001-12-01").drop("params"), mse=2)))

# -- runs that are repeated ---------------------------------------------------------------------------


def _repeated(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/runs"
    for day, model in (("2001-01-01", "sma_3"), ("2001-02-01", "sma_3"), ("2001-02-01", "last_value"), ("2001-02-01", "sma_3")):  # the last one again
        rows = forecast_report(spark, sf).filter(F.col("model_type") == model).withColumn("run_date", F.to_date(F.lit(day)))
        sinks.replace_run(rows.select("series", "date", "forecast", "run_date", "model_type"), path, ["run_date", "model_type"])
    return round_to(spark.read.parquet(path), forecast=4).groupBy("run_date", "model_type", "series").agg(F.count("*").alias("rows"), F.max("forecast").alias("highest"))


query(
    "io07_repeated_run",
    f"""{with_(FORECAST_REPORT)}SELECT run_date, model_type, series, count(*) AS rows, round(max(forecast), 4) AS highest FROM report JOIN (VALUES (DATE '2001-01-01', 'sma_3'), (DATE '2001-02-01', 'sma_3'),
  (DATE '2001-02-01', 'last_value')) v(run_date, model_type) USING (model_type) GROUP BY 1, 2, 3""",
)(_repeated)

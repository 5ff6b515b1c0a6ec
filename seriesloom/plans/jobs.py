"""Jobs built from the operators: walk-forward validation, training, tuning, inference."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.operators import calendar as cal
from seriesloom.operators import folds as fd
from seriesloom.operators import forecast as fc
from seriesloom.operators import metrics as mt
from seriesloom.operators import reshape as rs
from seriesloom.operators import smoothing
from seriesloom.operators.cleaning import holdout, last_rows
from seriesloom.operators.features import attach
from seriesloom.operators.panel import Panel, matched
from seriesloom.operators.regression import FIT, fitted_value
from seriesloom.plans import config
from seriesloom.plans import models as md
from seriesloom.plans.config import FeatureSet

REPORT_KEYS = ("model_type", "window")


# -- per-series autoregression -----------------------------------------------------------------


def ar_features(c: str, p: int) -> FeatureSet:
    return FeatureSet(target=c, lags=tuple(range(1, p + 1)))


def autoregression(panel: Panel, c: str, p: int, horizon: int, *, ridge: float = 0.0, z: float | None = None) -> DataFrame:
    """Fit AR(p) to every series by least squares on its lags and run it forward.

    With ``z`` each step gets bounds of z times the forecast deviation, from the moving-average
    weights of the fitted recursion.
    """
    fs = ar_features(c, p)
    xs = config.output_names(fs)
    rows = config.build(panel, fs, fill=None).df
    fit = md.series_fit(rows, panel.series, xs, c, ridge)
    state = matched(fc.series_state(panel, c, p), fit, panel.series, how="inner")
    out = fc.recursive_forecast(state, fs, md.series_predictor(xs), horizon)
    if z is None:
        return out.drop(FIT)
    # Moving-average weights: w_0 = 1, w_j = sum_i b_i w_(j-i).
    coef = F.col(f"{FIT}.coefficients")

    def weight(acc, j):
        nxt = F.aggregate(
            F.sequence(F.lit(1), F.least(j, F.lit(p))), F.lit(0.0),
            lambda s, i: s + F.element_at(coef, i) * F.element_at(acc, j - i + 1),
        )
        return F.array_append(acc, nxt)

    weights = F.aggregate(F.sequence(F.lit(1), F.lit(max(horizon - 1, 1))), F.array(F.lit(1.0)), weight)
    free = F.col(f"{FIT}.n") - p - 1
    sigma = F.sqrt(F.try_divide(F.col(f"{FIT}.rss"), free.cast("double")))
    spread = F.sqrt(F.aggregate(F.slice("__w", F.lit(1), F.col("step")), F.lit(0.0), lambda s, w: s + w * w))
    out = out.withColumn("__w", weights).withColumn("__half", z * sigma * spread)
    return out.select(
        *panel.series, "step", "prediction",
        (F.col("prediction") - F.col("__half")).alias("lower"), (F.col("prediction") + F.col("__half")).alias("upper"),
    )


def residual_correction(forecast: DataFrame, residuals: Panel, c: str, p: int, horizon: int) -> DataFrame:
    """Add an AR(p) forecast of the residuals to a forecast with ``step`` and ``prediction``."""
    r = autoregression(residuals, c, p, horizon).select(*residuals.series, "step", F.col("prediction").alias("residual_forecast"))
    out = matched(forecast, r, [*residuals.series, "step"])
    return out.withColumn("corrected", F.col("prediction") + F.coalesce("residual_forecast", F.lit(0.0)))


def exogenous_future(panel: Panel, cols: Sequence[str], horizon: int, *, method: str = "ar", order: int = 3, period: int = 12) -> DataFrame:
    """Forecast every exogenous column of every series, in long form, then widen again."""
    long = panel.df.select(*panel.series, *panel.order, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [*panel.series, *panel.order], list(cols), "__name", "__value"
    )
    each = Panel(long, [*panel.series, "__name"], panel.order, rows_per_task=panel.limit, rows_bound=panel.rows_bound)
    if method == "ar":
        got = autoregression(each.with_df(long.filter("__value IS NOT NULL")), "__value", order, horizon)
    else:
        got = smoothing.smoothing_forecast(each, "__value", period, horizon)
    return got.groupBy(*panel.series, "step").pivot("__name", list(cols)).agg(F.first("prediction"))


def fill_exogenous(panel: Panel, future: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """Fill the null tail of exogenous columns in ``future`` (series, step, cols) with their forecasts."""
    horizon = future.agg(F.max("step")).first()[0]
    made = exogenous_future(panel, cols, int(horizon), **kw).withColumnsRenamed({c: f"__{c}" for c in cols})
    rows = matched(future, made, [*panel.series, "step"])
    return rows.withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in cols}).drop(*[f"__{c}" for c in cols])


# -- stepwise prediction and walk-forward ---------------------------------------------------------


def exogenous_paths(known: Panel, fs: FeatureSet, horizon: int, **how) -> DataFrame:
    """Per series, one array per feature of other columns with its values over the next ``horizon`` steps.

    Only ``known`` rows are read: the other columns are forecast from them (see :func:`exogenous_future`, which ``how`` goes to), and the features
    come from the last known rows and those forecasts together. A spread that would need the coming target is null.
    """
    s, cols, names = known.series, fs.inputs(), config.output_names(fs.outside())
    keep = [c for c in dict.fromkeys([fs.target, *cols])]
    tail = last_rows(known.df, s, known.order, fs.outside_memory(), "__back")
    tail = tail.select(*s, (1 - F.col("__back")).alias("step"), *[F.col(c).cast("double").alias(c) for c in keep])
    steps = tail.select(*s).distinct().select(*s, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    ahead = matched(steps, exogenous_future(known, cols, horizon, **how), [*s, "step"], True)
    both = Panel(tail.unionByName(ahead, allowMissingColumns=True), s, ["step"], rows_bound=fs.outside_memory() + horizon)
    made = config.build(both, fs.outside(), fill=None).df.filter("step > 0")
    packed = made.groupBy(*s).agg(F.sort_array(F.collect_list(F.struct("step", *names))).alias("__p"))
    return packed.select(*s, *[F.col("__p")[n].alias(f"path_{n}") for n in names])


def state_with_paths(known: Panel, fs: FeatureSet, horizon: int, exogenous: Mapping | None = None) -> tuple[DataFrame, list[str]]:
    """The last target values of each series with the paths of its other features, and the names of those."""
    state, names = fc.series_state(known, fs.target, fs.memory()), config.output_names(fs.outside())
    if names:
        state = matched(state, exogenous_paths(known, fs, horizon, **(exogenous or {})), known.series, True)
    return state, names


@dataclass(frozen=True)
class FoldRows:
    """What every model of a fold reads: training rows, the state that forecasts start from, the names of its paths, and the test rows."""

    fold: int
    horizon: int
    train: DataFrame
    state: DataFrame
    paths: list[str]
    tests: DataFrame


@contextmanager
def fold_rows(
    panel: Panel, fs: FeatureSet, folds: DataFrame, fold: int, horizon: int | None, features: DataFrame, exogenous: Mapping | None = None
) -> Iterator[FoldRows]:
    """The rows of one fold, made once for all its models; the training rows are kept until the block ends.

    Columns other than the target are forecast from the training rows alone, whatever the model, so the forecast is not made again for each.
    """
    s, date = panel.series, panel.order[0]
    one = folds.filter(F.col("fold") == fold).filter("test_end > test_start").persist()
    if horizon is None:
        horizon = int(one.agg(F.max(F.col("test_end") - F.col("test_start"))).first()[0] or 0)
    train = matched(features, one.select(*s, "train_end"), s, how="inner").filter(F.col(fd.ROW) < F.col("train_end")).drop("train_end").persist()
    known = Panel(train.select(*s, *panel.order, fs.target, *fs.inputs()), s, panel.order, rows_per_task=panel.limit, rows_bound=panel.rows_bound)
    state, paths = state_with_paths(known, fs, horizon, exogenous)
    tests = matched(features.select(*s, date, fd.ROW, F.col(fs.target).cast("double").alias("actual")), one, s, how="inner").filter(
        (F.col(fd.ROW) >= F.col("test_start")) & (F.col(fd.ROW) < F.col("test_end"))
    )
    tests = tests.select(*s, date, "actual", (F.col(fd.ROW) - F.col("test_start") + 1).cast("int").alias("step"))
    try:
        yield FoldRows(fold, horizon, train, session.cut(state), paths, session.cut(tests))
    finally:
        train.unpersist()
        one.unpersist()


def predicted_fold(rows: FoldRows, fs: FeatureSet, spec: md.ModelSpec, series: Sequence[str]) -> tuple[DataFrame, md.Fitted]:
    """One model on one fold: the report and the model, as :func:`stepwise_prediction` gives them."""
    model = md.fit(spec, rows.train, config.output_names(fs), fs.target)
    errors = model.predict(rows.train).agg(
        mt.rounded(mt.mape(fs.target, "prediction"), 4).alias("TRAINING_MAPE"), mt.rounded(mt.rmse(fs.target, "prediction"), 2).alias("TRAINING_RMSE")
    )
    out = fc.recursive_model_forecast(rows.state, fs, model.predict, rows.horizon, exogenous={n: f"path_{n}" for n in rows.paths})
    report = matched(rows.tests, out.select(*series, "step", F.col("prediction").alias("forecast")), [*series, "step"])
    report = report.withColumns({"model_type": F.lit(spec.label), "window": F.lit(rows.fold)}).crossJoin(F.broadcast(errors))
    # The model is done with; keep the rows of the report only.
    return session.cut(report), model


def stepwise_prediction(
    panel: Panel, fs: FeatureSet, spec: md.ModelSpec, folds: DataFrame, fold: int, horizon: int | None = None, features: DataFrame | None = None,
    exogenous: Mapping | None = None,
) -> tuple[DataFrame, md.Fitted]:
    """Fit on the rows before the fold's test and predict the test recursively.

    Nothing of the test rows but their dates and actual values is read: columns other than the target are forecast from the rows before
    (``exogenous`` has the arguments of that forecast). The horizon is the fold's longest test; under a shorter one the later
    rows keep a null forecast. Returns (series, step, date, actual, forecast, model_type, window, training errors) and the model.
    """
    if features is None:
        features = fd.numbered(config.build(panel, fs)).df
    with fold_rows(panel, fs, folds, fold, horizon, features, exogenous) as rows:
        return predicted_fold(rows, fs, spec, panel.series)


def walk_forward(
    panel: Panel, fs: FeatureSet, specs: Sequence[md.ModelSpec], folds: DataFrame, fold_ids: Sequence[int], horizon: int | None = None,
    exogenous: Mapping | None = None, run_date: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Stepwise prediction of every model on every fold, with metrics, and the stacked importances.

    The report has class ``validation``, TRAINING_DATE (``run_date``, today where none is given) and the date and target of the series' last training
    row as REFERENCE_DATE and REFERENCE_PIX. Linear models of the target's own past alone are cheaper by ``fold_fits.walk_forward``.

    The training features look back only (but for leading gaps, which ``bfill`` takes from the series' first rows), so they are built
    once; other columns are forecast anew in each fold, once for all its models. The driver loops over folds and models, and each turn fits and
    predicts all series at once.
    """
    spark = panel.df.sparkSession
    features = session.cut(fd.numbered(config.build(panel, fs)).df)
    folds = session.cut(folds)
    reports, importances = [], []
    for fold in fold_ids:
        with fold_rows(panel, fs, folds, fold, horizon, features, exogenous) as rows:
            for spec in specs:
                report, model = predicted_fold(rows, fs, spec, panel.series)
                reports.append(report)
                importances.append(model.importances(spark).withColumn("window", F.lit(fold)))
    both = mt.with_report_metrics(rs.stack(reports), [*panel.series, *REPORT_KEYS], panel.order[0])
    last = folds.select(*panel.series, F.col("fold").alias("window"), (F.col("train_end") - 1).alias(fd.ROW))
    last = matched(last, features.select(*panel.series, fd.ROW, F.col(panel.order[0]).alias("REFERENCE_DATE"), F.col(fs.target).cast("double").alias("REFERENCE_PIX")), [*panel.series, fd.ROW])
    both = matched(both, last.drop(fd.ROW), [*panel.series, "window"])
    today = F.to_date(F.lit(run_date)) if run_date else F.current_date()
    return both.withColumns({"class": F.lit("validation"), "TRAINING_DATE": today}), rs.stack(importances)


def select_model(report: DataFrame, metric: str = "MAPE") -> DataFrame:
    """Model with the lowest mean metric over the report."""
    return rs.best_model(mt.mean_by(report, ["model_type"], [metric]), [], "model_type", metric)


# -- training, tuning, inference -------------------------------------------------------------------


def train_and_choose(
    panel: Panel, fs: FeatureSet, specs: Sequence[md.ModelSpec], days: int, folder: str | None = None, metric: str = "MAPE", keep_all: bool = False
) -> tuple[md.Fitted | list[md.Fitted], DataFrame]:
    """Fit all models before the holdout, choose on it, refit the choice on every row, save it.

    ``keep_all`` refits and saves every model, for an ensemble.
    """
    date, names = panel.order[0], config.output_names(fs)
    rows = session.cut(holdout(config.build(panel, fs).df, panel.series, date, days))
    train, valid = rows.filter("part = 'train'"), rows.filter("part = 'validation'")
    scores = []
    for spec in specs:
        scored = md.fit(spec, train, names, fs.target).predict(valid)
        got = scored.agg(mt.mape(fs.target, "prediction").alias("MAPE"), mt.rmse(fs.target, "prediction").alias("RMSE"), mt.mae(fs.target, "prediction").alias("MAE"))
        scores.append(got.select(F.lit(spec.label).alias("model_type"), "*"))
    table = session.cut(rs.stack(scores))
    chosen = rs.best_model(table, [], "model_type", metric).first()["best_model"]
    final = [md.fit(s, rows, names, fs.target) for s in specs if keep_all or s.label == chosen]
    if folder:
        for m in final:
            m.save(f"{folder}/{m.spec.label}")
    return (final if keep_all else final[0]), table


def fold_frames(panel: Panel, fs: FeatureSet, n_splits: int, size: int) -> list[tuple[DataFrame, DataFrame]]:
    """Train and test feature rows of end-anchored folds."""
    rows = session.cut(fd.numbered(config.build(panel, fs)).df)
    folds = session.cut(fd.end_anchored_folds(panel, panel.order[0], n_splits, size))
    out = []
    for k in range(n_splits):
        x = matched(rows, folds.filter(F.col("fold") == k), panel.series, how="inner")
        at = F.col(fd.ROW)
        out.append((x.filter(at < F.col("train_end")), x.filter((at >= F.col("test_start")) & (at < F.col("test_end")))))
    return out


def grid_search(panel: Panel, fs: FeatureSet, kind: str, n_splits: int = 2, size: int = 6, space: Mapping | None = None) -> tuple[DataFrame, DataFrame]:
    """Every parameter set on every expanding fold: the tuning table and the best set."""
    table = md.score_specs(md.grid(kind, space), fold_frames(panel, fs, n_splits, size), config.output_names(fs), fs.target, panel.df.sparkSession)
    return table, md.best_params(table)


def random_search(panel: Panel, fs: FeatureSet, kind: str, n: int, horizon: int, seed: int = 7, space: Mapping | None = None, exogenous: Mapping | None = None) -> DataFrame:
    """Sampled parameter sets scored by the squared error of a recursive forecast of the last rows."""
    folds = session.cut(fd.tail_split(panel, panel.order[0], horizon))
    features = session.cut(fd.numbered(config.build(panel, fs)).df)
    parts = []
    with fold_rows(panel, fs, folds, 0, horizon, features, exogenous) as rows:
        for i, spec in enumerate(md.sample_grid(kind, n, seed, space)):
            report, _ = predicted_fold(rows, fs, spec, panel.series)
            params = F.lit(json.dumps({k: str(v) for k, v in sorted(spec.params.items())}))
            parts.append(report.agg(F.avg(F.pow(F.col("actual") - F.col("forecast"), 2)).alias("mse")).select(F.lit(i).alias("trial"), params.alias("params"), "mse"))
    return rs.stack(parts)


def inference(
    panel: Panel, fs: FeatureSet, fitted: Sequence[md.Fitted], horizon: int, run_date: str, dates: str = "week", exogenous: Mapping | None = None
) -> DataFrame:
    """Forecast every series with every model, and their mean as ``ensemble`` when there are several.

    Columns other than the target are forecast first, as in the backtest.
    """
    s, date = panel.series, panel.order[0]
    state, exog = state_with_paths(panel, fs, horizon, exogenous)
    state = session.cut(state)
    paths = {n: f"path_{n}" for n in exog}
    parts = [
        fc.recursive_model_forecast(state, fs, m.predict, horizon, exogenous=paths).withColumn("model_type", F.lit(m.spec.label)) for m in fitted
    ]
    out = rs.stack(parts)
    if len(parts) > 1:
        out = session.cut(out)
        out = out.unionByName(fc.voting_mean(out, [*s, "step"]).withColumn("model_type", F.lit("ensemble")))
    make = {"week": cal.future_weeks, "month": cal.future_months}[dates]
    when = make(panel.df, s, date, horizon)
    out = matched(out, when, [*s, "step"], how="inner").withColumnRenamed("prediction", "forecast")
    return out.withColumn("run_date", F.to_date(F.lit(run_date)))


def linear_report(df: DataFrame, target: str, features: Sequence[str], test_share: float | None = None, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Least-squares fit over all rows: coefficients, and metrics on the same or on held-out rows."""
    train, test = (df, df) if test_share is None else df.randomSplit([1 - test_share, test_share], seed)
    fit = md.series_fit(train, [], features, target)
    pairs = F.arrays_zip(F.array(*[F.lit(f) for f in features]).alias("name"), F.col(f"{FIT}.coefficients").alias("value"))
    table = fit.select(F.explode(pairs).alias("c"), F.col(f"{FIT}.intercept").alias("intercept")).select(
        F.col("c.name").alias("feature"), F.col("c.value").alias("coefficient"), "intercept"
    )
    scored = attach(test, fit, []).withColumn("forecast", fitted_value([F.col(f) for f in features]))
    scored = scored.withColumn("actual", F.col(target))
    return table, mt.metric_pack(scored, [])

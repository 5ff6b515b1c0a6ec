"""Linear and ridge models of every fold of an expanding backtest from one pass over the rows.

A training row of a fold is a training row of all later folds of its series, so rows are summed once, per range of folds that hold them; the moments of
a fold are the sum of the few ranges around it. All fits, of all folds and penalties, are small solves on those moments. The forecasts of all folds
run as one recursion, with the fit carried on the state row of its (series, fold, model). No job is started per fold or per model.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.operators import folds as fd
from seriesloom.operators import forecast as fc
from seriesloom.operators import metrics as mt
from seriesloom.operators.panel import Panel, matched
from seriesloom.operators.regression import FIT, FIT_TYPE, _solve
from seriesloom.plans import config
from seriesloom.plans import models as md
from seriesloom.plans.config import FeatureSet


def label(ridge: float) -> str:
    """The model type in reports."""
    return "linear" if ridge == 0 else f"ridge_{ridge:g}"


def held_by(features: DataFrame, folds: DataFrame, series: Sequence[str]) -> DataFrame:
    """Rows with ``__from`` and ``__to``, the first and the last fold that train on them; rows that none trains on are left out.

    Folds are numbered in the order of their training ends within a series, as expanding folds are.
    """
    ends = folds.groupBy(*series).agg(F.array_sort(F.collect_list(F.struct("fold", "train_end"))).alias("__ends"))
    rows = matched(features, ends, series, how="inner")
    holding = F.filter("__ends", lambda e: e["train_end"] > F.col(fd.ROW))
    rows = rows.withColumn("__held", holding).filter(F.size("__held") > 0)
    return rows.withColumns({"__from": F.element_at("__held", 1)["fold"], "__to": F.element_at("__held", -1)["fold"]}).drop("__ends", "__held")


def fold_fits(held: DataFrame, xs: Sequence[str], y: str, ridges: Sequence[float] = (0.0,)) -> DataFrame:
    """fold, model_type, ridge, fit, means (of the features, then the target): one fit over all series per fold and penalty.

    The penalty of a coefficient is ``ridge`` times the sum of squares of its centred feature, so it does not depend on units. Rows with a gap are
    left out.
    """
    cols = [*xs, y]
    k = len(cols)
    rows = held.na.drop(subset=cols)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    # Centred on the means over all rows, so that sums of products stay well conditioned.
    centre = rows.agg(*[F.avg(c).alias(c) for c in cols]).first()
    x = [F.col(c).cast("double") - F.lit(float(centre[c] or 0.0)) for c in cols]
    parts = [*x, *[x[i] * x[j] for i, j in pairs]]
    ranges = rows.groupBy("__from", "__to").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(p).alias(f"__{i}") for i, p in enumerate(parts)])
    # At most folds squared rows, each expanded to the folds it belongs to.
    each = ranges.select("*", F.explode(F.sequence("__from", "__to")).alias("fold"))
    moments = each.groupBy("fold").agg(F.sum("__n").alias("__n"), F.array(*[F.sum(f"__{i}") for i in range(len(parts))]).alias("__m"))
    moments = moments.select("*", F.explode(F.array(*[F.lit(float(r)) for r in ridges])).alias("ridge"))
    offset = np.array([float(centre[c] or 0.0) for c in cols])

    @F.pandas_udf(f"fit {FIT_TYPE}, means array<double>")
    def solve(n: pd.Series, m: pd.Series, ridge: pd.Series) -> pd.DataFrame:
        fits, means = [], []
        for count, flat, penalty in zip(n, m, ridge):
            mean = np.asarray(flat[:k], float) / count
            cov = np.zeros((k, k))
            for (i, j), v in zip(pairs, flat[k:]):
                cov[i, j] = cov[j, i] = v / count - mean[i] * mean[j]
            relative = np.zeros((k, k))
            np.fill_diagonal(relative[:-1, :-1], np.diag(cov)[:-1] * penalty)
            plain, bent = _solve(int(count), mean, cov, 0.0), _solve(int(count), mean, cov + relative, 0.0)
            fit = plain if penalty == 0 else {**bent, "errors": None, "rss": None}
            fit["intercept"] = float(mean[-1] + offset[-1] - np.dot(fit["coefficients"], mean[:-1] + offset[:-1]))
            fits.append(fit)
            means.append((mean + offset).tolist())
        return pd.DataFrame({"fit": fits, "means": means})

    solved = moments.select("fold", "ridge", solve("__n", "__m", "ridge").alias("__s"))
    names = F.create_map(*[v for r in ridges for v in (F.lit(float(r)), F.lit(label(r)))])
    return solved.select("fold", F.element_at(names, F.col("ridge")).alias("model_type"), "ridge", F.col("__s.fit").alias(FIT), F.col("__s.means").alias("means"))


def _each_model(fits: Sequence, held: bool = True) -> Column:
    """The fits as one literal array; those whose fold holds the row, if asked for. Folds and models are few."""
    one = lambda r: F.struct(
        F.lit(r["fold"]).alias("fold"), F.lit(r["model_type"]).alias("model_type"), F.lit(r["ridge"]).alias("ridge"), F.lit(r[FIT]["intercept"]).alias("intercept"),
        F.array(*[F.lit(float(b)) for b in r[FIT]["coefficients"]]).alias("coefficients"),
    )
    every = F.array(*[one(r) for r in fits])
    return F.filter(every, lambda m: (m["fold"] >= F.col("__from")) & (m["fold"] <= F.col("__to"))) if held else every


def _value(model: str, xs: Sequence[str]) -> Column:
    out = F.col(f"{model}.intercept")
    for i, x in enumerate(xs):
        out = out + F.col(f"{model}.coefficients")[i] * F.col(x)
    return out


def _errors(rows: DataFrame, models: Column, xs: Sequence[str], y: str) -> DataFrame:
    """fold, model_type, ridge, mape and rmse of every model on the rows it is paired with; summed in the scan, nothing is shuffled but sums."""
    scored = rows.select(y, *xs, F.explode(models).alias("__model")).select(F.col("__model.fold").alias("fold"), F.col("__model.model_type").alias("model_type"),
                                                                          F.col("__model.ridge").alias("ridge"), F.col(y).alias("__y"), _value("__model", xs).alias("__p"))
    return scored.groupBy("fold", "model_type", "ridge").agg(mt.mape("__y", "__p").alias("mape"), mt.rmse("__y", "__p").alias("rmse"))


def walk_forward(panel: Panel, fs: FeatureSet, folds: DataFrame, run_date: str, ridges: Sequence[float] = (0.0,), horizon: int | None = None) -> DataFrame:
    """The validation report of every linear model on every fold, with the contributions of the features beside each forecast.

    series, date, step, actual, forecast, model_type, window, TRAINING_MAPE, TRAINING_RMSE, report metrics, class (``validation``), TRAINING_DATE
    (``run_date``), REFERENCE_DATE and REFERENCE_PIX (date and target of the series' last training row), base and ``contribution_<feature>``: coefficient times
    distance from the feature's mean in training; with ``base``, the mean of the target, they sum to the forecast. Only features of the target's own past
    are taken (others need a forecast of their own, see ``jobs.walk_forward``). The horizon is the longest test where none is given; later
    rows of a longer test keep a null forecast.
    """
    if config.output_names(fs.outside()):
        raise ValueError("features of other columns need jobs.walk_forward")
    s, date, y = panel.series, panel.order[0], fs.target
    xs = config.output_names(fs)
    features = session.cut(fd.numbered(config.build(panel, fs)).df)
    folds = session.cut(folds.filter("test_end > test_start"))
    if horizon is None:
        horizon = int(folds.agg(F.max(F.col("test_end") - F.col("test_start"))).first()[0] or 1)
    held = held_by(features, folds, s)
    fits = session.cut(fold_fits(held, xs, y, ridges))
    solved = [r for r in fits.collect() if r[FIT]["coefficients"] is not None]
    training = _errors(held.na.drop(subset=[y, *xs]), _each_model(solved), xs, y).select(
        F.col("fold").alias("window"), "model_type", mt.rounded(F.col("mape"), 4).alias("TRAINING_MAPE"), mt.rounded(F.col("rmse"), 2).alias("TRAINING_RMSE")
    )
    # Every fold's last known values and its test rows, by the row number.
    memory = max(fs.memory(), 1)
    near = folds.select(*s, "fold", "train_end", "test_start", F.explode(F.sequence(F.greatest(F.lit(0), F.col("train_end") - memory), F.col("test_end") - 1)).alias(fd.ROW))
    rows = session.cut(matched(features.select(*s, fd.ROW, F.col(date).alias("__date"), F.col(y).cast("double").alias("__y")), near, [*s, fd.ROW], how="inner"))
    past = rows.filter(F.col(fd.ROW) < F.col("train_end")).groupBy(*s, "fold").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(fd.ROW, "__y"))), lambda r: r["__y"]).alias(fc.HISTORY),
        F.max("__date").alias("REFERENCE_DATE"), F.max_by("__y", fd.ROW).alias("REFERENCE_PIX"),
    )
    state = matched(past, fits.drop("ridge"), ["fold"], how="inner")
    made = fc.recursive_forecast(state, fs, md.series_predictor(xs), horizon, keep_features=True)
    parts = {f"contribution_{x}": F.col(f"{FIT}.coefficients")[i] * (F.col(x) - F.col("means")[i]) for i, x in enumerate(xs)}
    made = made.withColumns({**parts, "base": F.element_at("means", -1)}).drop(*xs, FIT, "means", fc.HISTORY)
    tests = rows.filter(F.col(fd.ROW) >= F.col("test_start")).select(
        *s, "fold", F.col("__date").alias(date), F.col("__y").alias("actual"), (F.col(fd.ROW) - F.col("test_start") + 1).cast("int").alias("step")
    )
    every = matched(tests, fits.select("fold", "model_type"), ["fold"], how="inner")
    report = matched(every, made.withColumnRenamed("prediction", "forecast"), [*s, "fold", "model_type", "step"]).withColumnRenamed("fold", "window")
    report = session.cut(matched(report, training, ["window", "model_type"]))
    report = mt.with_report_metrics(report, [*s, "model_type", "window"], date)
    return report.withColumns({"class": F.lit("validation"), "TRAINING_DATE": F.to_date(F.lit(run_date))})


def ridge_grid(panel: Panel, fs: FeatureSet, folds: DataFrame, ridges: Sequence[float]) -> DataFrame:
    """The tuning table: kind, params (JSON), fold, mape, rmse of every penalty on every fold's test rows, fits and scores each from one pass."""
    xs, y = config.output_names(fs), fs.target
    features = session.cut(fd.numbered(config.build(panel, fs)).df)
    held = held_by(features, folds, panel.series)
    solved = [r for r in fold_fits(held, xs, y, ridges).collect() if r[FIT]["coefficients"] is not None]
    tests = fd.numbered_test_rows(features, folds, panel.series).withColumns({"__from": F.col("fold"), "__to": F.col("fold")}).na.drop(subset=[y, *xs])
    return _errors(tests, _each_model(solved), xs, y).select(F.lit("ridge").alias("kind"), params_of(F.col("ridge")).alias("params"), "fold", "mape", "rmse")


def params_of(ridge: Column) -> Column:
    """A penalty as the JSON that is saved."""
    return F.to_json(F.struct(ridge.alias("ridge")))


def saved(ridge: float) -> str:
    """As :func:`params_of`, for one penalty."""
    return json.dumps({"ridge": float(ridge)}, separators=(",", ":"))


def random_ridges(n: int, seed: int = 7, low: float = -3.0, high: float = 1.0) -> list[float]:
    """``n`` penalties, powers of ten between 10^low and 10^high, from a hash of seed and trial: the same on every run."""
    share = lambda i: int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16) / 2**32
    return [10 ** (low + (high - low) * share(i)) for i in range(n)]


def random_search(panel: Panel, fs: FeatureSet, n: int, horizon: int, run_date: str, seed: int = 7) -> DataFrame:
    """trial, params (JSON), mse of the recursive forecast of the last ``horizon`` rows of all series: every trial from the same pass."""
    ridges = random_ridges(n, seed)
    report = walk_forward(panel, fs, fd.tail_split(panel, panel.order[0], horizon), run_date, ridges, horizon)
    names = F.create_map(*[v for i, r in enumerate(ridges) for v in (F.lit(label(r)), F.struct(F.lit(i).alias("trial"), F.lit(r).alias("ridge")))])
    found = report.groupBy(F.element_at(names, F.col("model_type")).alias("__t")).agg(F.avg(F.pow(F.col("actual") - F.col("forecast"), 2)).alias("mse"))
    return found.select("__t.trial", params_of(F.col("__t.ridge")).alias("params"), "mse")


__all__ = ["fold_fits", "held_by", "random_ridges", "random_search", "ridge_grid", "saved", "walk_forward"]

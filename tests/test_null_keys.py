"""A null series key is a series of its own: every operator gives it the rows that it would have under a name."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import calendar as cal
from seriesloom.operators import cleaning as cl
from seriesloom.operators import explain as ex
from seriesloom.operators import features as ft
from seriesloom.operators import folds as fd
from seriesloom.operators import forecast as fc
from seriesloom.operators import joins as jn
from seriesloom.operators import metrics as mt
from seriesloom.operators import smoothing
from seriesloom.operators import statistics as st
from seriesloom.operators.panel import Panel
from seriesloom.plans import config, jobs
from seriesloom.plans import models as md

S, FIRST = ["series"], dt.date(2021, 1, 1)
LAGS = config.FeatureSet(target="y", lags=(1, 2))
WITH_EXOG = config.FeatureSet(target="y", lags=(1,), exog_lags={"x": (1,)})
LINEAR = md.ModelSpec("linear")


def errors(p):
    return p.df.withColumns({"actual": F.col("y"), "forecast": F.col("y") + F.col("x") / 10})


def walk(p, fs=LAGS):
    return jobs.walk_forward(p, fs, [LINEAR], fd.end_anchored_folds(p, "date", 1, 4), [0])[0]


def infer(p):
    model = md.fit(LINEAR, config.build(p, WITH_EXOG).df, config.output_names(WITH_EXOG), "y")
    return jobs.inference(p, WITH_EXOG, [model], 3, "2022-01-01", exogenous={"order": 1})


def residuals(p):
    forecast = fc.seasonal_naive(p, "y", 6, 4)
    return jobs.residual_correction(forecast, p.with_df(p.df.select("series", "date", "x")), "x", 1, 4)


CASES = {
    "holdout": lambda p: cl.holdout(p.df, S, "date", 20),
    "outliers": lambda p: cl.flag_outliers(p.df, S, "y", rows_per_task=p.limit),
    "scaled": lambda p: cl.scaled(p.df, S, "y", "standard"),
    "scaled_robust": lambda p: cl.scaled(p.df, S, "y", "robust", rows_per_task=p.limit),
    "group_value": lambda p: jn.with_group_value(p.df, S, F.max("y"), "top"),
    "report_metrics": lambda p: mt.with_report_metrics(errors(p), S, "date"),
    "short_metrics": lambda p: mt.short_metrics(errors(p), S),
    "complete": lambda p: cal.complete(p.df, S, "date", "day"),
    "expanding": lambda p: fd.expanding_folds(p, "date", "2021-03-05", 3, 2),
    "missing_start": lambda p: fd.missing_start(p, "date", "1990-01-05"),
    "calendar_folds": lambda p: fd.test_rows(p, fd.calendar_folds(p, "date", 3, 14, 10)),
    "growing": lambda p: fd.test_rows(p, fd.growing_folds(p, "date", 20, 5, 5)),
    "fold_rows": lambda p: fd.fold_rows(p, fd.end_anchored_folds(p, "date", 2, 4)),
    "walk_forward": walk,
    "walk_forward_exogenous": lambda p: walk(p, WITH_EXOG),
    "inference": infer,
    "exogenous_future": lambda p: jobs.exogenous_future(p, ["x"], 3, order=1),
    "autoregression": lambda p: jobs.autoregression(p, "y", 2, 3, z=1.96),
    "residual_correction": residuals,
    "smoothing": lambda p: smoothing.smoothing_forecast(p, "y", 6, 4),
    "exogenous_smoothed": lambda p: jobs.exogenous_future(p, ["x"], 3, method="smooth", period=6),
    "future_frame": lambda p: fc.future_frame(p, LAGS, "date", 6),
    "spearman": lambda p: st.spearman_test(p.df, S, "x", "y", p_value=False, rows_per_task=p.limit),
    "seasonality": lambda p: st.seasonality_tests(p.df.withColumn("m", F.month("date")), S, "y", "m", p_value=False, rows_per_task=p.limit),
    "ks_normal": lambda p: st.ks_normal(p.df.withColumn("z", (F.col("y") - 50) / 20), S, "z", ["date"], rows_per_task=p.limit),
    "likely_distribution": lambda p: st.likely_distribution(p.df, S, "y", ["date"], rows_per_task=p.limit),
    "autocorrelation": lambda p: st.autocorrelation(p, "y", 4),
    "partial_autocorrelation": lambda p: st.partial_autocorrelation(p, "y", 4),
    "decompose": lambda p: st.decompose(p, "y", 4).finish(),
    "unit_root": lambda p: st.unit_root_test(p, "y", 1),
    "granger": lambda p: st.granger(p, "y", "x", 2, p_value=False),
    "smoothed": lambda p: ft.smoothed(p, "y", "s", 1).finish(),
    "span_average": lambda p: ft.span_average(p, "y", 5).finish(),
    "increase_runs": lambda p: ft.increase_runs(p, "y", 2).finish(),
    "detrended": lambda p: ft.detrended(p, "y").finish(),
    "bins": lambda p: ex.bin_probabilities(p.df, S, "y", 10.0),
    "draws": lambda p: ex.draw_interval(p.df, S, "y", rows_per_task=p.limit),
}


def rows_of(df):
    def shown(v):
        return None if isinstance(v, float) and np.isnan(v) else float(f"{v:.9g}") if isinstance(v, float) else v

    cols = sorted(df.columns)
    return sorted((tuple(shown(r[c]) for c in cols) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def panels(spark):
    rng = np.random.default_rng(11)
    rows = [(s, FIRST + dt.timedelta(days=7 * i), float(np.round(50 + 10 * np.sin(i) + rng.normal(0, 4), 2)), float(np.round(rng.normal(5, 2), 2))) for s in ("a", "none") for i in range(36)]
    named = spark.createDataFrame(rows, "series string, date date, y double, x double").persist()
    nulls = named.withColumn("series", F.nullif("series", F.lit("none")))
    return named, nulls


@pytest.mark.parametrize("limit", [None, 9])
@pytest.mark.parametrize("name", sorted(CASES))
def test_null_key(panels, name, limit):
    named, nulls = (CASES[name](Panel(df, S, ["date"], rows_per_task=limit)) for df in panels)
    assert named.count() > 0
    assert rows_of(nulls) == rows_of(named.withColumn("series", F.nullif("series", F.lit("none"))))

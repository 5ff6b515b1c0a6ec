"""Distributions, statistics, smoothing, spectra and fits against brute force."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesloom.functions import distributions as ds
from seriesloom.operators import metrics as mt
from seriesloom.operators import smoothing as sm
from seriesloom.operators import spectrum as sp
from seriesloom.operators import statistics as st
from seriesloom.operators.panel import Panel
from seriesloom.operators.regression import least_squares
from seriesloom.plans import jobs
from seriesloom.plans import models as md

rng = np.random.default_rng(11)
DAY = dt.date(2020, 1, 1)


def panel_of(spark, series, limit=None, **cols):
    rows = [(s, DAY + dt.timedelta(days=i), float(v)) for s, vs in series.items() for i, v in enumerate(vs)]
    return Panel(spark.createDataFrame(rows, "series string, date date, y double"), ["series"], ["date"], rows_per_task=limit)


def test_distribution_tails():
    # Published table values.
    assert ds.t_two_sided(2.228, 10) == pytest.approx(0.05, abs=2e-4)
    assert ds.t_two_sided(12.706, 1) == pytest.approx(0.05, abs=1e-4)
    assert ds.chi_square_tail(3.841, 1) == pytest.approx(0.05, abs=1e-4)
    assert ds.chi_square_tail(18.307, 10) == pytest.approx(0.05, abs=1e-4)
    assert ds.chi_square_tail(0.0, 3) == 1.0
    assert ds.f_tail(4.10, 2, 10) == pytest.approx(0.05, abs=1e-3)
    # Two degrees of freedom have a closed form.
    assert ds.chi_square_tail(5.0, 2) == pytest.approx(math.exp(-2.5))
    assert ds.t_two_sided(1.0, 1) == pytest.approx(0.5)


def plain_smoothing(y, m, horizon):
    best = None
    for a, b, c in sm.GRID:
        level, first = np.mean(y[:m]), np.array(y[:m])
        trend = (np.mean(y[m : 2 * m]) - level) / m
        season = first - level
        sse = 0.0
        for i, v in enumerate(y):
            e = v - (level + sm.DAMPING * trend + season[i % m])
            level, trend = level + sm.DAMPING * trend + a * e, sm.DAMPING * trend + b * e
            season[i % m] += c * e
            sse += e * e if i >= 2 * m else 0.0
        damp = np.cumsum(sm.DAMPING ** np.arange(1, horizon + 1))
        out = [level + damp[h] * trend + season[(len(y) + h) % m] for h in range(horizon)]
        if best is None or sse < best[0]:
            best = (sse, out)
    return best[1]


@pytest.mark.parametrize("limit", [None, 13])
def test_smoothing_matches_a_plain_loop(spark, limit):
    t = np.arange(60)
    data = {
        "a": 50 + 0.3 * t + 8 * np.sin(t * np.pi / 2) + rng.normal(0, 1, 60),
        "b": 20 + 3 * np.cos(t * np.pi / 2) + rng.normal(0, 2, 60),
        "short": [1.0, 2.0, 3.0],
    }
    got = sm.smoothing_forecast(panel_of(spark, data, limit), "y", 4, 6).orderBy("series", "step").toPandas()
    assert set(got["series"]) == {"a", "b", "short"}
    assert set(got[got["series"] == "short"]["prediction"]) == {3.0}  # under two seasons: the last value
    for s, g in got[got["series"] != "short"].groupby("series"):
        assert g["prediction"].tolist() == pytest.approx(plain_smoothing(list(data[s]), 4, 6), rel=1e-8)


@pytest.mark.parametrize("limit", [None, 9])
def test_amplitudes_match_fft(spark, limit):
    data = {"a": rng.normal(0, 1, 37), "b": np.sin(np.arange(64) * 2 * np.pi / 8)}
    got = sp.amplitudes(panel_of(spark, data, limit), "y").orderBy("series", "k").toPandas()
    for s, g in got.groupby("series"):
        y, n = np.asarray(data[s]), len(data[s])
        t = np.arange(1, n + 1)
        y = y - np.polyval(np.polyfit(t, y, 1), t)
        assert g["amplitude"].to_numpy() == pytest.approx(2 / n * np.abs(np.fft.fft(y))[: n // 2], abs=1e-9)
    peak = sp.dominant_cycle(panel_of(spark, data, limit), "y").filter("series = 'b'").first()
    assert peak["cycle"] == pytest.approx(8.0)


def test_least_squares_and_tests(spark):
    n = 80
    x1, x2 = rng.normal(1000, 5, n), rng.normal(0, 1e-3, n)
    y = 3 + 2 * x1 - 50 * x2 + rng.normal(0, 0.5, n)
    df = spark.createDataFrame([("a", *map(float, r)) for r in zip(x1, x2, y)], "s string, x1 double, x2 double, y double")
    fit = least_squares(df, ["s"], ["x1", "x2"], "y").first()["fit"]
    a = np.column_stack([np.ones(n), x1, x2])
    b, rss, *_ = np.linalg.lstsq(a, y, rcond=None)
    sigma2 = rss[0] / (n - 3)
    errors = np.sqrt(np.diag(np.linalg.inv(a.T @ a)) * sigma2)[1:]
    assert [fit["intercept"], *fit["coefficients"]] == pytest.approx(b.tolist(), rel=1e-6)
    assert fit["rss"] == pytest.approx(rss[0], rel=1e-8)
    assert fit["errors"] == pytest.approx(errors.tolist(), rel=1e-6)


def test_collinear_and_constant_columns_still_fit(spark):
    df = spark.range(10).select(F.lit("a").alias("s"), (F.col("id") * 1.0).alias("x"), (F.col("id") * 2.0).alias("x2"), F.lit(1.0).alias("k"), (F.col("id") * 3.0 + 1).alias("y"))
    fit = least_squares(df, ["s"], ["x", "x2", "k"], "y").first()["fit"]
    assert fit["rss"] == pytest.approx(0.0, abs=1e-9)


def test_unit_root_and_granger_match_numpy(spark):
    n = 120
    x = rng.normal(0, 1, n).cumsum()
    y = np.concatenate([[0.0], 0.8 * x[:-1]]) + rng.normal(0, 0.3, n)
    rows = [("a", DAY + dt.timedelta(days=i), float(x[i]), float(y[i])) for i in range(n)]
    p = Panel(spark.createDataFrame(rows, "series string, date date, x double, y double"), ["series"], ["date"])
    d = np.diff(x)
    a = np.column_stack([x[1:-1], d[:-1], np.ones(n - 2)])
    b, rss, *_ = np.linalg.lstsq(a, d[1:], rcond=None)
    want = b[0] / np.sqrt(rss[0] / (n - 2 - 3) * np.linalg.inv(a.T @ a)[0, 0])
    got = st.unit_root_test(p, "x", 1).first()
    assert got["statistic"] == pytest.approx(want, rel=1e-6) and not got["stationary"]
    f = {r["lag"]: r for r in st.granger(p, "y", "x", 2).collect()}
    own = np.column_stack([y[1:-1], y[:-2], np.ones(n - 2)])
    both = np.column_stack([own, x[1:-1], x[:-2]])
    r0, r1 = (np.linalg.lstsq(m, y[2:], rcond=None)[1][0] for m in (own, both))
    assert f[2]["f"] == pytest.approx(((r0 - r1) / 2) / (r1 / (n - 2 - 5)), rel=1e-6)
    assert f[1]["p"] < 1e-6


def test_partial_autocorrelation_of_ar1(spark):
    r = [0.6**k for k in range(6)]
    assert st.partial_from_auto(r) == pytest.approx([1, 0.6, 0, 0, 0, 0], abs=1e-12)


def test_likely_distribution_and_ks(spark):
    draws = {"norm": rng.normal(50, 5, 400), "expon": rng.exponential(3, 400), "lognorm": rng.lognormal(1, 0.8, 400)}
    for limit in (None, 60):
        p = panel_of(spark, draws)
        got = {r["series"]: r["distribution"] for r in st.likely_distribution(p.df, ["series"], "y", ["date"], rows_per_task=limit).collect()}
        assert got == {k: k for k in draws}
    z = panel_of(spark, {"z": rng.normal(0, 1, 300)})
    x = np.sort([r["y"] for r in z.df.collect()])
    f, i = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x]), np.arange(1, 301)
    want = max((i / 300 - f).max(), (f - (i - 1) / 300).max())
    for limit in (None, 50):
        assert st.ks_normal(z.df, ["series"], "y", ["date"], rows_per_task=limit).first()["ks_distance"] == pytest.approx(want, abs=1e-6)


def test_perfect_forecast_has_no_error(spark):
    df = spark.createDataFrame([("a", DAY + dt.timedelta(days=i), float(i + 1), float(i + 1)) for i in range(6)], "series string, date date, actual double, forecast double")
    r = mt.report_metrics(df, ["series"], "date").first()
    assert (r["MAPE"], r["RMSE"], r["MAE"], r["WAPE"], r["R2"], r["MAPE_6W"]) == (0, 0, 0, 0, 1, 0)


def test_zero_totals(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0)], "s string, actual double, forecast double")
    r = df.groupBy("s").agg(mt.absolute_wape("actual", "forecast").alias("w"), mt.mape("actual", "forecast").alias("m")).first()
    assert r["w"] == float("inf") and r["m"] is None


def test_subset_scores_match_refits(spark):
    n = 60
    x = rng.normal(0, 1, (n, 3))
    y = x[:, 0] * 2 - x[:, 2] + rng.normal(0, 0.1, n)
    fold = np.arange(n) % 3
    df = spark.createDataFrame([(int(f), *map(float, r), float(v)) for f, r, v in zip(fold, x, y)], "fold int, a double, b double, c double, y double")
    got = {r["features"]: r["mse"] for r in md.subset_scores(df, "fold", ["a", "b", "c"], "y", spark, 3).collect()}
    for name, cols in {"a": [0], "a,c": [0, 2], "a,b,c": [0, 1, 2]}.items():
        sse = 0.0
        for k in range(3):
            tr, te = fold != k, fold == k
            m = np.column_stack([np.ones(n), x[:, cols]])
            b = np.linalg.lstsq(m[tr], y[tr], rcond=None)[0]
            sse += ((y[te] - m[te] @ b) ** 2).sum()
        assert got[name] == pytest.approx(sse / n, rel=1e-6)
    assert min(got, key=got.get) in ("a,c", "a,b,c")


def test_autoregression_bounds_widen(spark):
    p = panel_of(spark, {"a": 10 + rng.normal(0, 1, 50).cumsum()})
    rows = jobs.autoregression(p, "y", 2, 5, z=1.96).orderBy("step").collect()
    widths = [r["upper"] - r["lower"] for r in rows]
    assert all(b >= a > 0 for a, b in zip(widths, widths[1:]))


def test_normal_distribution_expression(spark):
    x = [-8.0, -3.0, -1.959963984540054, -0.5, 0.0, 0.3, 1.0, 2.5, 6.0]
    got = spark.createDataFrame([(v,) for v in x], "x double").select(ds.normal_p_below(F.col("x")).alias("p")).collect()
    assert [r.p for r in got] == pytest.approx([0.5 * math.erfc(-v / math.sqrt(2)) for v in x], abs=2e-7)


@pytest.mark.parametrize("limit", [None, 5, 40])
def test_average_ranks_across_slabs(spark, limit):
    """One value that a third of all rows share, ties at every border, a null key and missing values."""
    r = np.random.default_rng(4)
    rows = [(None if i % 3 == 0 else "a", None if i % 17 == 0 else 5.0 if i % 3 == 1 else float(r.integers(0, 12)), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v double, i long")
    got = {x.i: (x.r, x.r_ties) for x in st.average_ranks(df, ["k"], "v", "r", ["i"], rows_per_task=limit).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "v", "i"]).dropna(subset="v")
    groups = pdf.groupby("k", dropna=False)["v"]
    ties = pdf.groupby(["k", "v"], dropna=False)["v"].transform("size")
    assert got == {i: (rank, n) for i, rank, n in zip(pdf["i"], groups.rank(), ties)}


def test_granger_depths_against_least_squares(spark):
    """Every depth against fits on its own rows; gaps inside the series, a null key and a series too short for the deeper lags."""
    r = np.random.default_rng(8)
    rows = []
    for s, n in (("a", 60), (None, 40), ("short", 6)):
        x, y = r.normal(0, 1, n), np.zeros(n)
        for i in range(1, n):
            y[i] = 0.4 * y[i - 1] + 0.7 * x[i - 1] + r.normal(0, 0.5)
        rows += [(s, DAY + dt.timedelta(days=i), 100 + float(y[i]), None if s == "a" and i in (20, 41) else float(x[i])) for i in range(n)]
    p = Panel(spark.createDataFrame(rows, "series string, date date, y double, x double"), ["series"], ["date"])
    got = {(g.series, g.lag): g for g in st.granger(p, "y", "x", 3, p_value=False).collect()}
    for s in ("a", None, "short"):
        own = [q for q in rows if q[0] == s]
        for depth in (1, 2, 3):
            use = [i for i in range(depth, len(own)) if all(own[i - k][3] is not None for k in range(1, depth + 1))]
            Y = np.array([own[i][2] for i in use])
            lag = lambda c: np.array([[own[i - k][c] for k in range(1, depth + 1)] for i in use])  # noqa: B023, E731
            small = np.column_stack([np.ones(len(use)), lag(2)])
            large = np.column_stack([small, lag(3)])
            rss = [((Y - m @ np.linalg.lstsq(m, Y, rcond=None)[0]) ** 2).sum() for m in (small, large)]
            free = len(use) - 2 * depth - 1
            g = got[s, depth]
            assert g.n == len(use) and g.free == free
            if free > 0:
                assert g.f == pytest.approx((rss[0] - rss[1]) / depth / (rss[1] / free), rel=1e-6)
            else:
                assert g.f is None


def test_short_series_are_forecast_by_their_last_value(spark):
    p = panel_of(spark, {"long": list(range(30)), "brief": [4, 5, 6]})
    got = {}
    for x in sm.smoothing_forecast(p, "y", 6, 2).collect():
        got.setdefault(x.series, []).append(x.prediction)
    assert set(got) == {"long", "brief"} and got["brief"] == [6.0, 6.0]

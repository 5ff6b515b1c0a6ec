"""Ordered passes: split plan equals whole plan equals pandas, and the edge frames."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import cleaning as cl
from seriesloom.operators import features as ft
from seriesloom.operators.calendar import interpolate
from seriesloom.operators.panel import Panel, decayed_sums

DAY = dt.date(2022, 1, 1)


def frame(spark, series: dict, shuffle=True):
    rows = [(s, DAY + dt.timedelta(days=i), None if v is None else float(v)) for s, vs in series.items() for i, v in enumerate(vs)]
    if shuffle:
        random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "series string, date date, y double")


def panel(df, limit=None):
    return Panel(df, ["series"], ["date"], rows_per_task=limit)


def series_of(df, c):
    pdf = df.select("series", "date", c).toPandas().sort_values(["series", "date"])
    return {s: [None if pd.isna(v) else v for v in g[c]] for s, g in pdf.groupby("series")}


def close(a, b, tol=1e-9):
    assert a.keys() == b.keys()
    for s in a:
        assert len(a[s]) == len(b[s])
        for x, y in zip(a[s], b[s]):
            if x is None or y is None or (isinstance(y, float) and np.isnan(y)):
                assert x is None and (y is None or np.isnan(y)), (s, a[s], b[s])
            else:
                assert x == pytest.approx(y, rel=tol, abs=tol), (s, a[s], b[s])


rng = np.random.default_rng(5)
HOT = [None if rng.random() < 0.2 else round(float(v), 2) for v in rng.normal(100, 20, 97)]
SERIES = {
    "hot": HOT,
    "short": [5, 6],
    "one": [7],
    "void": [None, None, None],
    "flat": [4.0] * 12,
    "head": [None, None, None, 1, 2, 3, 4, 5, 6],
    "middle": [1, None, None, None, 5, None, 7],
    "tail": [3, 2, 1, None, None],
    "wave": [-1, 2, -3, 4, -5, 6, -7, 8, 0, 0, 3],
}
LIMITS = [None, 7, 30]


def pandas_by(fn):
    return {s: [None if pd.isna(v) else float(v) for v in fn(pd.Series(v, dtype="float64"))] for s, v in SERIES.items()}


@pytest.mark.parametrize("limit", LIMITS)
def test_lag_and_average_match_pandas(spark, limit):
    p = ft.add_features(panel(frame(spark, SERIES), limit), [ft.lag("y", 2), ft.moving_average("y", 3), ft.moving_sum("y", 5)])
    close(series_of(p.df, "y_lag_2"), pandas_by(lambda x: x.shift(2).bfill()))
    close(series_of(p.df, "y_sma_3"), pandas_by(lambda x: x.rolling(3, closed="left").mean().bfill()))
    close(series_of(p.df, "y_ms_5"), pandas_by(lambda x: x.rolling(5, closed="left").sum().bfill()))


@pytest.mark.parametrize("limit", LIMITS)
def test_band_and_ratio_match_pandas(spark, limit):
    p = ft.add_features(panel(frame(spark, SERIES), limit), [ft.band_spread("y", 4), ft.lag_ratio("y", 1, 2), ft.moving_sum_ratio("y", 3, 6)])
    close(series_of(p.df, "bband_spread_4"), pandas_by(lambda x: (4 * x.rolling(4, closed="left").std()).bfill()), 1e-7)

    def ratio(x):
        a, b = x.shift(1).bfill(), x.shift(2).bfill()
        return 100 * a / b.replace(0, np.nan)

    close(series_of(p.df, "comparison_y_shift_1_2"), pandas_by(ratio))

    def sums(x):
        a, b = (x.rolling(n, min_periods=3, closed="left").sum().bfill() for n in (3, 6))
        return (100 * a / b.where(b.abs() > 1e-12)).bfill().ffill()

    close(series_of(p.df, "comparison_y_ms_3_6"), pandas_by(sums), 1e-7)


@pytest.mark.parametrize("limit", LIMITS)
def test_fills_and_interpolation_match_pandas(spark, limit):
    df = frame(spark, SERIES)
    close(series_of(panel(df, limit).fill_back(["y"]).df, "y"), pandas_by(lambda x: x.bfill()))
    close(series_of(panel(df, limit).fill_forward(["y"]).df, "y"), pandas_by(lambda x: x.ffill()))
    close(series_of(interpolate(panel(df, limit), ["y"]).df, "y"), pandas_by(lambda x: x.interpolate()))


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("alpha", [0.109, 0.9, 1 / 14])
@pytest.mark.parametrize("adjust", [True, False])
def test_decayed_mean_matches_pandas(spark, limit, alpha, adjust):
    p = panel(frame(spark, SERIES), limit).decayed_mean("e", "y", alpha, adjust=adjust)
    close(series_of(p.df, "e"), pandas_by(lambda x: x.ewm(alpha=alpha, adjust=adjust).mean()))
    assert [c for c in p.finish().columns] == ["series", "date", "y", "e"]


def test_decayed_sums_do_not_overflow():
    x = np.ones(50_000)
    num, den = decayed_sums(x, 0.1)
    assert np.isfinite(num).all() and num[-1] == pytest.approx(1 / 0.9)


@pytest.mark.parametrize("limit", LIMITS)
def test_running_sums_and_positions(spark, limit):
    p = panel(frame(spark, SERIES), limit).running_sums({"s": F.col("y")}).positions("pos")
    close(series_of(p.df, "s"), pandas_by(lambda x: x.fillna(0).cumsum()))
    close(series_of(p.df, "pos"), pandas_by(lambda x: pd.Series(range(1, len(x) + 1))))


@pytest.mark.parametrize("limit", [None, 4])
def test_increase_runs_follow_the_flip_rule(spark, limit):
    df = frame(spark, {"a": [1, 2, 3, 1, 2, 1, 3, 4, 1, 2, 1, 2, 3]})
    got = series_of(ft.increase_runs(panel(df, limit), "y", 2).df, "consecutive_increases_2")
    assert got == {"a": [0, 1, 2, 2, 3, 3, 4, 5, 5, 6, 6, 7, 8]}


def test_increase_runs_restart_when_the_flag_turns(spark):
    df = frame(spark, {"a": [1, 2, 3, 3, 3, 3, 4, 5]})
    got = series_of(ft.increase_runs(panel(df), "y", 1).df, "consecutive_increases_1")
    assert got == {"a": [0, 1, 2, 2, 0, 0, 1, 2]}


def test_strength_index_without_losses_is_a_gap(spark):
    p = ft.add_features(panel(frame(spark, {"up": [1, 2, 3, 4]})), [ft.strength_index("y", 2)], fill=None)
    assert series_of(p.df, "rsi_2") == {"up": [None] * 4}
    p = ft.add_features(panel(frame(spark, {"up": [1, 2, 3, 4]})), [ft.strength_index_inclusive("y", 2)], fill=None)
    assert series_of(p.df, "rsi_incl_2") == {"up": [None, 100.0, 100.0, 100.0]}


def test_no_bleed_between_series_and_no_order_dependence(spark):
    feats = [ft.lag("y", 1), ft.moving_average("y", 2)]
    a = frame(spark, {"a": [1, 2, 3, 4], "b": [10, 20, 30, 40]}, shuffle=False)
    b = frame(spark, {"b": [10, 20, 30, 40], "a": [1, 2, 3, 4]}).repartition(7)
    one = series_of(ft.add_features(panel(a), feats, fill=None).df, "y_sma_2")
    two = series_of(ft.add_features(panel(b), feats, fill=None).df, "y_sma_2")
    assert one == two == {"a": [None, None, 1.5, 2.5], "b": [None, None, 15.0, 25.0]}


def test_unfilled_features_of_a_prefix_are_the_prefix(spark):
    feats = [ft.lag("y", 1), ft.moving_average("y", 3), ft.band_spread("y", 4), ft.strength_index("y", 3)]
    whole = ft.add_features(panel(frame(spark, {"a": HOT})), feats, fill=None).df
    part = ft.add_features(panel(frame(spark, {"a": HOT[:40]})), feats, fill=None).df
    for f in feats:
        name = f.names[0]
        assert series_of(part, name)["a"] == series_of(whole, name)["a"][:40]


def test_split_plan_is_chosen_by_size(spark):
    df = frame(spark, {"a": HOT})
    assert panel(df, 10).is_split and not panel(df, 1000).is_split
    assert not Panel.calendar(df, ["series"], "date").is_split


def test_split_plan_keeps_every_row_under_extreme_skew(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("s"), F.pmod("id", F.lit(50)).cast("string"))).alias("series"),
        F.col("id").alias("t"), (F.col("id") * 1.0).alias("y"),
    )
    p = Panel(rows, ["series"], ["t"], rows_per_task=100)
    got = ft.add_features(p, [ft.lag("y", 1)], fill=None).df
    assert got.count() == 5000
    assert got.filter("series = 'hot' AND y_lag_1 = y - 1").count() == 3999
    # No task of the windowed stage may hold the hot series whole.
    assert got.groupBy("series", "__chunk").count().agg(F.max("count")).first()[0] <= 100


@pytest.mark.parametrize("limit", [None, 5])
def test_exact_quantiles(spark, limit):
    df = frame(spark, SERIES)
    got = {r["series"]: r for r in cl.exact_quantiles(df, ["series"], "y", {"a": 0.1, "m": 0.5, "z": 1.0}, rows_per_task=limit).collect()}
    for s, v in SERIES.items():
        x = pd.Series(v, dtype="float64").dropna()
        if len(x):
            assert [got[s][c] for c in "amz"] == pytest.approx([x.quantile(q) for q in (0.1, 0.5, 1.0)])
    assert "void" not in got


@pytest.mark.parametrize("limit", [None, 8])
def test_a_panel_without_keys_is_one_series(spark, limit):
    df = frame(spark, {"a": HOT}).drop("series")
    p = ft.add_features(Panel(df, [], ["date"], rows_per_task=limit), [ft.lag("y", 1), ft.moving_average("y", 2)])
    got = p.df.orderBy("date").toPandas()
    x = pd.Series(HOT, dtype="float64")
    assert got["y_lag_1"].tolist() == pytest.approx(x.shift(1).bfill().tolist(), nan_ok=True)
    assert got["y_sma_2"].tolist() == pytest.approx(x.rolling(2, closed="left").mean().bfill().tolist(), nan_ok=True)


def test_sizes_are_measured_once(spark):
    p = panel(frame(spark, SERIES), 1000)
    assert not p.is_split
    assert p.frames(lambda w: {"a": F.lag("y", 1).over(w)}, back=1).with_df(p.df).__dict__["_sizes"] == p._sizes


def test_last_rows_beyond_the_pruned_rank(spark):
    df = spark.range(3000).select(F.lit("a").alias("series"), F.col("id").alias("t"))
    few, many = cl.last_rows(df, ["series"], ["t"], 3), cl.last_rows(df, ["series"], ["t"], 1500)
    assert sorted((r["t"], r["from_end"]) for r in few.collect()) == [(2997, 3), (2998, 2), (2999, 1)]
    got = {r["t"]: r["from_end"] for r in many.collect()}
    assert len(got) == 1500 and got[2999] == 1 and got[1500] == 1500 and set(many.columns) == {"series", "t", "from_end"}


@pytest.mark.parametrize("limit", [None, 7])
def test_leading_fill_equals_general_fill(spark, limit):
    full = {s: [x for x in v if x is not None] for s, v in SERIES.items() if any(x is not None for x in v)}
    feats = [ft.lag("y", 3), ft.moving_average("y", 6), ft.band_spread("y", 7)]
    a = ft.add_features(panel(frame(spark, full), limit), feats, leading=True).df
    b = ft.add_features(panel(frame(spark, full), limit), feats, leading=False).df
    for f in feats:
        close(series_of(a, f.names[0]), {s: [np.nan if x is None else x for x in v] for s, v in series_of(b, f.names[0]).items()})


@pytest.mark.parametrize("limit", [None, 10])
def test_named_passes_equal_pandas(spark, limit):
    df = frame(spark, {"a": [x for x in HOT if x is not None]})
    x = pd.Series([v for v in HOT if v is not None])
    got = series_of(ft.detrended(panel(df, limit), "y").df, "y_detrended")["a"]
    t = np.arange(1, len(x) + 1)
    assert got == pytest.approx((x - np.polyval(np.polyfit(t, x, 1), t)).tolist())
    got = series_of(ft.smoothed(panel(df, limit), "y", "s", 3).df, "s")["a"]
    assert got == pytest.approx(x.shift(3).ewm(alpha=0.109).mean().bfill().ffill().tolist())
    d = x.diff()
    up, down = (v.ewm(alpha=1 / 5, adjust=False).mean() for v in (d.clip(lower=0), (-d).clip(lower=0)))
    got = series_of(ft.strength_index_smoothed(panel(df, limit), "y", 5).df, "rsi_wilder_5")["a"]
    want = 100 - 100 / (1 + up / down)
    assert got[2:] == pytest.approx(want.tolist()[2:])

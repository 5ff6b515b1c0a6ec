"""Trees and models per series, linear folds from one pass, saved models and parameters, repeated runs: against plain versions."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import folds as fd
from seriesloom.operators import series_trees as trees
from seriesloom.operators.features import attach
from seriesloom.operators.panel import Panel
from seriesloom.plans import config, fold_fits
from seriesloom.plans import models as md
from seriesloom.plans import series_models as sm
from seriesloom.sources import sinks

DAY = dt.date(2021, 1, 3)
S = ["series"]


def rows_of(seed=1):
    """(series, i, a, b, y): a null key, a series of ties, a constant target, one feature without spread, gaps, and two too short series."""
    rng = np.random.default_rng(seed)
    out = []
    for s, n in ((None, 90), ("ties", 60), ("flat", 40), ("narrow", 50), ("short", 3), ("gaps", 30)):
        for i in range(n):
            a, b = (float(v) for v in rng.integers(-9, 9, 2))
            y = float(rng.integers(-40, 40)) + 30 * (a > 2) - 25 * (b > 0)
            if s == "ties":
                a, y = float(i % 2), float(10 * (i % 2))
            if s == "flat":
                y = 7.0
            if s == "narrow":
                b = 4.0
            out.append((s, i, None if s == "gaps" else a, b, y))
    return out


def plain_tree(x, y, depth, bins, least):
    """node -> (feature, threshold, value) by trying every cut of every bin."""
    lo, hi = x.min(axis=0), x.max(axis=0)
    where = np.where(hi > lo, np.minimum(np.floor((x - lo) / np.where(hi > lo, hi - lo, 1) * bins), bins - 1), 0).astype(int)
    out, todo = {}, [(1, np.arange(len(y)), depth)]
    while todo:
        node, rows, left = todo.pop()
        best = (0.0, None, None)
        for f in range(x.shape[1]):
            for cut in range(bins):
                inside = where[rows, f] <= cut
                n, k = len(rows), int(inside.sum())
                if k < least or n - k < least:
                    continue
                s, t = y[rows].sum(), y[rows][inside].sum()
                gain = t * t / k + (s - t) * (s - t) / (n - k) - s * s / n
                if gain > best[0]:
                    best = (gain, f, cut)
        gain, f, cut = best
        out[node] = (f, None if f is None else lo[f] + (hi[f] - lo[f]) * (cut + 1) / bins, y[rows].mean(), gain)
        if f is not None and left > 1:
            todo += [(2 * node, rows[where[rows, f] <= cut], left - 1), (2 * node + 1, rows[where[rows, f] > cut], left - 1)]
        elif f is not None:
            for k, part in ((2 * node, rows[where[rows, f] <= cut]), (2 * node + 1, rows[where[rows, f] > cut])):
                out[k] = (None, None, y[part].mean(), 0.0)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "series string, i int, a double, b double, y double").repartition(3)


@pytest.mark.parametrize("depth,bins,least", [(1, 8, 1), (3, 16, 4)])
def test_trees_are_the_exhaustive_ones(spark, depth, bins, least):
    rows = rows_of()
    models = trees.fit(frame(spark, rows), S, ["a", "b"], "y", depth, bins, least)
    found = {r.series: r for r in models.collect()}
    assert set(found) == {None, "ties", "flat", "narrow", "short", "gaps"}
    assert found["gaps"].error == "too few whole rows: 0" and found["gaps"].tree_model is None
    assert (found["short"].error is None) == (2 * least <= 3)
    for s in (None, "ties", "flat", "narrow"):
        own = [r for r in rows if r[0] == s]
        want = plain_tree(np.array([r[2:4] for r in own]), np.array([r[4] for r in own]), depth, bins, least)
        got = found[s].tree_model.trees[0]
        assert set(got) == set(want)
        for node, (f, threshold, value, gain) in want.items():
            assert got[node].feature == f and got[node].value == pytest.approx(value)
            if f is not None:
                assert got[node].threshold == pytest.approx(threshold) and got[node].gain == pytest.approx(gain)
    assert len(found["flat"].tree_model.trees[0]) == 1 and found["narrow"].tree_model.trees[0][1].feature == 0


def test_tree_predictions_and_importances(spark):
    rows = rows_of()
    df = frame(spark, rows)
    models = trees.fit(df, S, ["a", "b"], "y", 2, 16, 4)
    own = {r.series: r.tree_model for r in models.collect()}
    got = attach(df, models, S).withColumn("p", trees.predicted([F.col("a"), F.col("b")])).collect()

    def walk(tree, x):
        node = 1
        while tree[node].feature is not None:
            if x[tree[node].feature] is None:
                return None
            node = 2 * node + (x[tree[node].feature] > tree[node].threshold)
        return tree[node].value

    for r in got:
        assert r.p == (None if own[r.series] is None else walk(own[r.series].trees[0], (r.a, r.b)))
    shares = trees.importances(models, S, ["a", "b"]).collect()
    per = {}
    for r in shares:
        per.setdefault(r.series, {})[r.feature] = r.importance
    assert per["flat"] == {"a": 0.0, "b": 0.0} and per["narrow"] == {"a": 1.0, "b": 0.0} and set(per) == {None, "ties", "flat", "narrow"}
    assert sum(per[None].values()) == pytest.approx(1)


def test_boosting_fits_what_is_left(spark):
    df = frame(spark, rows_of())
    errors = []
    for rounds in (1, 4):
        models = trees.fit(df, S, ["a", "b"], "y", 2, 16, 4, rounds=rounds, rate=0.7)
        scored = attach(df, models, S).withColumn("e", F.pow(F.col("y") - trees.predicted([F.col("a"), F.col("b")]), 2))
        errors.append(scored.filter("series IS NULL").agg(F.avg("e")).first()[0])
    model = trees.fit(df, S, ["a", "b"], "y", 2, 16, 4, rounds=4, rate=0.7).filter("series = 'flat'").first().tree_model
    assert errors[1] < errors[0] and model.base == 7.0 and len(model.trees) == 4


def panel_of(spark, sizes, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(s, DAY + dt.timedelta(days=7 * i), float(rng.integers(20, 60)), float(rng.integers(0, 9))) for s, n in sizes.items() for i in range(n)]
    return Panel(spark.createDataFrame(rows, "series string, date date, y double, x double"), S, ["date"])


LAGS = config.FeatureSet(target="y", lags=(1, 2), averages=(3,))


@pytest.mark.parametrize("ridge", [0.0, 0.3])
def test_all_folds_from_one_pass(spark, ridge):
    """Every fold's fit and forecast equals a fit on that fold's rows alone; one series lacks the later folds."""
    p = panel_of(spark, {"a": 40, None: 33, "late": 20})
    folds = fd.growing_folds(p, "date", 12, 5, 4)
    report = fold_fits.walk_forward(p, LAGS, folds, "2022-02-02", [ridge], horizon=4).collect()
    xs = config.output_names(LAGS)
    data = {}
    for r in fd.numbered(config.build(p, LAGS)).df.collect():
        data.setdefault(r.series, {})[r.row_no] = r
    cuts = folds.filter("test_end > test_start").collect()
    assert len({c.fold for c in cuts}) > 2 and report
    for k in {c.fold for c in cuts}:
        own = {c.series: c for c in cuts if c.fold == k}
        train = [data[s][i] for s, c in own.items() for i in range(c.train_end)]
        X, y = np.array([[r[x] for x in xs] for r in train]), np.array([r.y for r in train])
        mx, my = X.mean(axis=0), y.mean()
        gram = (X - mx).T @ (X - mx)
        b = np.linalg.solve(gram + ridge * np.diag(np.diag(gram)), (X - mx).T @ (y - my))
        fitted = my + (X - mx) @ b
        for s, c in own.items():
            past = [data[s][i].y for i in range(c.train_end)]
            mine = sorted((r for r in report if r.series == s and r.window == k), key=lambda r: r.step)
            assert [r.step for r in mine] == list(range(1, c.test_end - c.test_start + 1))
            for r in mine:
                now = np.array([past[-1], past[-2], np.mean(past[-3:])])
                want = my + (now - mx) @ b
                past.append(want)
                assert r.forecast == pytest.approx(want) and r.actual == data[s][c.test_start + r.step - 1].y
                parts = [r[f"contribution_{x}"] for x in xs]
                assert parts == pytest.approx(list((now - mx) * b)) and sum(parts) + r.base == pytest.approx(r.forecast)
                assert r.REFERENCE_PIX == data[s][c.train_end - 1].y and r.REFERENCE_DATE == data[s][c.train_end - 1].date
                assert r["class"] == "validation" and str(r.TRAINING_DATE) == "2022-02-02"
                assert r.TRAINING_MAPE == pytest.approx(np.abs((y - fitted) / y).mean(), abs=1e-4) and r.TRAINING_RMSE == pytest.approx(np.sqrt(((y - fitted) ** 2).mean()), abs=1e-2)


def test_other_columns_are_refused(spark):
    p = panel_of(spark, {"a": 20})
    with pytest.raises(ValueError):
        fold_fits.walk_forward(p, config.FeatureSet(target="y", exog_lags={"x": (1,)}), fd.tail_split(p, "date", 2), "2022-01-01")


def test_best_model_of_each_series_saved_and_run(spark, tmp_path):
    p = panel_of(spark, {"a": 60, None: 50, "tiny": 2})
    models, scores = sm.train(p, LAGS, 40, sm.Candidates(kinds=(sm.LINEAR, sm.TREE, sm.BOOSTED), depth=2, rounds=2))
    table = {}
    for r in scores.collect():
        table.setdefault(r.series, {})[r.model_type] = r.MAPE
    chosen = {r.series: r for r in models.collect()}
    assert set(chosen) == {"a", None, "tiny"} and chosen["tiny"].error and chosen["tiny"].model_type is None
    for s in ("a", None):
        assert len(table[s]) == 3 and table[s][chosen[s].model_type] == min(table[s].values())
        assert [k for k in (sm.LINEAR, sm.TREE, sm.BOOSTED) if chosen[s][k] is not None] == [chosen[s].model_type]
    path = f"{tmp_path}/models"
    for day in ("2022-01-01", "2022-02-01", "2022-02-01"):
        sm.save(models, path, day)
    assert spark.read.parquet(path).count() == 6 and sm.load(spark, path).count() == 3 == sm.load(spark, path, "2022-01-01").count()
    q = p.with_df(p.df.union(spark.createDataFrame([("new", DAY, 5.0, 1.0)], p.df.schema)))
    out = sm.infer(q, LAGS, sm.load(spark, path), 3, "2022-02-01").collect()
    assert len(out) == 12
    for r in out:
        assert (r.forecast is None) == (r.series in ("tiny", "new")) == (r.error is not None)


def test_parameters_are_saved_and_read(spark, tmp_path):
    p = panel_of(spark, {"a": 40, "b": 40})
    table = fold_fits.ridge_grid(p, LAGS, fd.end_anchored_folds(p, "date", 2, 5), [0.05, 50.0])
    best = md.best_params(table)
    folder = f"{tmp_path}/best"
    sinks.write_params(best, folder)
    spec = md.read_spec(spark, folder, "ridge")
    per = {r.params: r.m for r in table.groupBy("params").agg(F.avg("mape").alias("m")).collect()}
    assert fold_fits.saved(spec.params["ridge"]) == min(per, key=per.get) == best.first().params
    assert md.read_spec(spark, folder, "forest") == md.ModelSpec("forest", {})
    assert fold_fits.random_ridges(5) == fold_fits.random_ridges(5) and all(1e-3 <= r <= 10 for r in fold_fits.random_ridges(50))

"""Quantiles that are settled while the draws are made for the first time."""

import contextlib
import datetime
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.catalog import modelling
from seriesloom.operators import explain as ex
from seriesloom.operators import simulated
from seriesloom.operators.panel import Panel
from seriesloom.plans import models as md
from tests.test_simulated import QUANTILES, redraw


def plan_of(df):
    with contextlib.redirect_stdout(out := io.StringIO()):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("kind, lo, hi", [
    ("plain", 0.5, 0.9), ("plain", 50.0, 60.0), ("plain", None, 1.0), ("ties", -1.0, 8.0), ("one", 0.0, 0.0), ("far", 0.5, 0.9), ("far", 0.9, 0.5), ("gaps", float("nan"), 1.0), ("none", 0.5, 0.9),
])
def test_any_bounds_as_sorted(spark, kind, lo, hi):
    """Bounds that hold a quantile or miss it, overlap, hold all draws or are no bounds change nothing; keys may be null or repeat."""
    points = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "key string, other int")
    simulate = redraw(kind, 600)
    bounds = tuple(F.lit(b).cast("double") for b in (lo, hi))
    near = {"mid": bounds, "low": (F.lit(0.01), F.lit(0.2)), "high": (bounds[0], F.lit(3.0))}
    got = simulated.drawn_quantiles(points, simulate, ["key"], "v", QUANTILES, 8, 20, near=near).collect()
    assert sorted(str(r["key"]) for r in got) == ["None", "a", "b", "b"]
    per = {}
    for r in simulate(points).select("key", "v").collect():
        if r["v"] is not None and np.isfinite(r["v"]):
            per.setdefault(r["key"], []).append(r["v"])
    for r in got:
        values = np.array(per.get(r["key"], []))
        assert r["n"] == len(values)
        for name, q in QUANTILES.items():
            assert r[name] == (pytest.approx(np.quantile(values, q), rel=1e-12) if len(values) else None)
        if kind in ("plain", "ties", "one", "gaps"):
            assert r["mean"] == pytest.approx(values.mean(), rel=1e-9) and r["deviation"] == pytest.approx(values.std(ddof=1), rel=1e-9, abs=1e-12)


def test_draws_are_made_once(spark, monkeypatch):
    """Bounds taken from the normal law leave one pass, and no draw or count is moved after it."""
    rows = [(s, datetime.date(2000 + m // 12, m % 12 + 1, 28), float(100 + (m * 37 + s * 11) % 50), float(20 + (m * 13 + s) % 9)) for s in range(4) for m in range(36)]
    df = spark.createDataFrame(rows, "series long, date date, rev double, disc double").withColumn("y", 3 * F.col("rev") - 2 * F.col("disc"))
    monkeypatch.setattr(modelling, "supplier_panel", lambda *_: Panel.calendar(df, ["series"], "date"))
    made, drawn_inputs = [], ex.drawn_inputs
    monkeypatch.setattr(ex, "drawn_inputs", lambda *a, **k: made.append(drawn_inputs(*a, **k)) or made[-1])
    got = modelling._simulated(spark, "").collect()
    assert len(got) == 12 and all(r.n == 10_000 and r.mean_near and r.deviation_near and r.lower_near and r.upper_near for r in got)
    assert len(made) == 1
    plan = plan_of(made[0].groupBy("series", "date").agg(F.max("rev")))
    assert plan.count("Exchange") == 1


def test_many_draws_are_spread(spark):
    """Draws of one point that make several blocks are still dealt by block."""
    rows = spark.createDataFrame([(1, 5.0, 2.0)], "k long, __m_x double, __s_x double")
    out = ex.drawn_inputs(rows, ["k"], ["x"], 25_000)
    assert out.select("draw").distinct().count() == 25_000
    assert "__block" in plan_of(out).split("hashpartitioning(")[1].split(")")[0]


@pytest.mark.parametrize("features", [2, 9])
def test_linear_prediction_without_vectors(spark, features):
    names = [f"x{i}" for i in range(features)]
    df = spark.range(200).select(*[((F.rand(i) - 0.3) * 10**i).alias(c) for i, c in enumerate(names)]).localCheckpoint()
    df = df.withColumn("y", sum((F.col(c) * (i + 0.5) for i, c in enumerate(names)), F.lit(3.0)) + F.rand(99)).localCheckpoint()
    gaps = df.unionByName(df.limit(1).withColumn("x0", F.lit(None).cast("double"))).unionByName(df.limit(1).withColumn("x1", F.lit(float("nan"))))
    for kind in ("linear", "ridge"):
        fitted = md.fit(md.ModelSpec(kind), df, names, "y")
        out = fitted.predict(gaps.withColumn("prediction", F.lit(1.0)))
        assert "UDF" not in plan_of(out) and out.columns == [*names, "y", "prediction"]
        whole = fitted.model.transform(gaps).withColumnRenamed("prediction", "want")
        for r, w in zip(out.collect(), whole.collect()):
            assert r["prediction"] is None if r["x0"] is None else r["prediction"] == pytest.approx(w["want"], rel=1e-9, nan_ok=True)

"""Quantiles of draws that are made again, against sorting them."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.catalog import modelling
from seriesloom.operators import simulated
from seriesloom.operators.panel import Panel

QUANTILES = {"low": 0.05, "mid": 0.5, "high": 0.95, "least": 0.0, "most": 1.0}


def redraw(kind, draws):
    """Draws of a kind from a hash of point and number, all columns kept."""

    def simulate(points):
        rows = points.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
        u = (F.pmod(F.xxhash64("key", "draw"), F.lit(1_000_003)) + 0.5) / 1_000_003
        made = {
            "plain": -F.log(u),
            "ties": F.floor(u * 3).cast("double"),
            "one": F.lit(7.0),
            # One draw far out squeezes all others into one bin, again and again.
            "far": F.when(F.col("draw") == 1, F.lit(1e300)).when(F.col("draw") == 2, F.lit(-1e308)).when(F.col("draw") == 3, F.lit(1e9)).otherwise(u),
            "gaps": F.when(F.col("draw") % 3 == 0, F.lit(float("nan"))).when(F.col("draw") % 3 == 1, F.lit(None)).when(F.col("draw") == 5, F.lit(float("inf"))).otherwise(u),
            "none": F.lit(None).cast("double"),
        }[kind]
        return rows.withColumn("v", made)

    return simulate


@pytest.mark.parametrize("kind, draws, bins, most", [
    ("plain", 5_000, 64, 1_000), ("plain", 3_000, 4, 10), ("ties", 3_000, 8, 50), ("one", 500, 8, 50), ("far", 2_000, 16, 40), ("gaps", 900, 8, 20), ("plain", 1, 8, 20), ("plain", 2, 2, 1), ("none", 50, 8, 20),
])
def test_as_sorted(spark, kind, draws, bins, most):
    points = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "key string, other int")
    simulate = redraw(kind, draws)
    got = {r["key"]: r for r in simulated.drawn_quantiles(points, simulate, ["key"], "v", QUANTILES, bins, most).collect()}
    assert set(got) == {"a", "b", None}
    per = {}
    for r in simulate(points).select("key", "v").collect():
        if r["v"] is not None and np.isfinite(r["v"]):
            per.setdefault(r["key"], []).append(r["v"])
    for key, r in got.items():
        values = np.array(per.get(key, []))
        assert r["n"] == len(values)
        for name, q in QUANTILES.items():
            if not len(values):
                assert r[name] is None and r["mean"] is None
            else:
                assert r[name] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_no_points(spark):
    points = spark.createDataFrame([], "key string, other int")
    assert simulated.drawn_quantiles(points, redraw("plain", 10), ["key"], "v", QUANTILES).count() == 0


def test_passes(spark):
    """The draws are made once per pass, and the passes grow with the logarithm of the draws."""
    points = spark.createDataFrame([(str(i), i) for i in range(5)], "key string, other int")
    simulate, seen = redraw("plain", 20_000), []

    def watched(p):
        out = simulate(p)
        seen.append(out)
        return out

    simulated.drawn_quantiles(points, watched, ["key"], "v", {"low": 0.05, "high": 0.95}).count()
    assert len(seen) == 4  # bounds, two narrowings (20,000 to about 300 and less), the look


def test_history_whose_sums_differ(spark, monkeypatch):
    """Sums of floats differ in their last digits from one reading to the next; the draws of all passes must not."""
    rows = [(s, datetime.date(2000 + m // 12, m % 12 + 1, 28), float(100 + (m * 37 + s * 11) % 50), float(20 + (m * 13 + s) % 9)) for s in range(4) for m in range(36)]
    noise = F.udf(lambda: 1 + random.uniform(-1e-9, 1e-9), "double").asNondeterministic()
    df = spark.createDataFrame(rows, "series long, date date, rev double, disc double").withColumn("y", 3 * F.col("rev") - 2 * F.col("disc"))
    unsteady = df.withColumn("rev", F.col("rev") * noise())
    monkeypatch.setattr(modelling, "supplier_panel", lambda *_: Panel.calendar(unsteady, ["series"], "date"))
    got = modelling._simulated(spark, "").collect()
    assert len(got) == 12
    assert all(r.n == 10_000 and r.mean_near and r.deviation_near and r.lower_near and r.upper_near for r in got)

"""Quantiles of simulated forecasts without moving a draw.

A draw is fixed by a hash of its point and number (``explain.standard_normal``), so it can be made again at any time. Instead of sorting
the draws of a point, each pass makes them anew and counts them in a few bins between two bounds; what is shuffled are counts. The bin
that holds a wanted rank gives the bounds of the next pass, until so few draws lie between them that they can be looked at. Where a
caller knows bounds that are likely to hold a quantile, the first pass keeps the draws between them and settles what it can.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.functions.columns import sdiv
from seriesloom.operators.features import attach

#: Bins of a pass, and draws between two bounds that are looked at one by one.
BINS, MOST = 64, 1_000

Simulate = Callable[[DataFrame], DataFrame]


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """The bin of a value between two bounds, from 0. Halves keep the width of any two finite numbers finite."""
    share = sdiv(value / 2 - lo / 2, hi / 2 - lo / 2)
    return F.least(F.coalesce(F.floor(share * bins), F.when(value > lo, F.lit(bins - 1)).otherwise(0).cast("bigint")), F.lit(bins - 1).cast("bigint"))


def _goals(points: DataFrame, open_: DataFrame, keys: Sequence[str], simulate: Simulate, value: str) -> DataFrame:
    """The draws that lie within the bounds of an open goal of their point: keys, goal, value."""
    per_point = open_.groupBy(*keys).agg(F.collect_list(F.struct("lo", "hi", "before", "ranks")).alias("__goals"))
    drawn = simulate(attach(points, per_point, keys).filter("__goals IS NOT NULL"))
    tried = drawn.select(*keys, F.col(value).cast("double").alias("__v"), F.explode("__goals").alias("goal"))
    return tried.filter(F.col("__v").between(F.col("goal.lo"), F.col("goal.hi")))


def _near(i: int) -> tuple[Column, Column]:
    return F.col(f"__near_lo_{i}"), F.col(f"__near_hi_{i}")


def _first_pass(points: DataFrame, simulate: Simulate, keys: Sequence[str], value: str, quantiles: Mapping[str, float], near: int) -> DataFrame:
    """Per point with draws: n, mean, deviation, lo, hi of its draws and, by rank, the values ``__at`` of all wanted ranks, null where one was not met.

    Draws between two bounds of ``near`` are counted value by value, those between the bounds' stretches per stretch. A rank is met
    where it falls on a single value. Nothing is shuffled when ``simulate`` deals its draws by ``keys``.
    """
    v = F.col(value).cast("double")
    v = F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), v)
    by = []
    if near:
        held = reduce(or_, [F.col("__v").between(*_near(i)) for i in range(near)])
        stretch = reduce(add, [F.when(F.col("__v") > _near(i)[1], 1).otherwise(0) for i in range(near)])
        by = [stretch.alias("__stretch"), F.when(held, F.col("__v")).alias("__held")]
    parts = simulate(points).withColumn("__v", v).groupBy(*keys, *by).agg(
        F.count("__v").alias("n"), F.avg("__v").alias("mean"), F.var_pop("__v").alias("__var"), F.min("__v").alias("lo"), F.max("__v").alias("hi")
    ).filter("n > 0")
    of_point = Window.partitionBy(*keys)
    upto = F.sum("n").over(of_point.orderBy("lo").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = parts.withColumn("__upto", upto).withColumn("__n", F.sum("n").over(of_point))
    parts = parts.withColumn("__mean", F.sum(F.col("mean") * (F.col("n") / F.col("__n"))).over(of_point))
    squares = F.sum(F.col("n") * (F.col("__var") + F.pow(F.col("mean") - F.col("__mean"), F.lit(2))))
    ranks = [f(F.lit(float(q)) * (F.col("__n") - 1)) for q in quantiles.values() for f in (F.floor, F.ceil)]
    met = [F.max(F.when((F.col("lo") == F.col("hi")) & (r >= F.col("__upto") - F.col("n")) & (r < F.col("__upto")), F.struct(r.alias("rank"), F.col("lo").alias("at")))) for r in ranks]
    return parts.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("__mean").alias("mean"), F.sqrt(sdiv(squares, F.sum("n") - 1)).alias("deviation"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        *[m.alias(f"__met_{i}") for i, m in enumerate(met)],
    ).withColumn("__at", F.when(
        reduce(lambda a, b: a & b, [F.col(f"__met_{i}").isNotNull() for i in range(len(met))]),
        F.map_from_entries(F.array_distinct(F.array(*[F.col(f"__met_{i}") for i in range(len(met))]))),
    )).drop(*[f"__met_{i}" for i in range(len(met))])


def _searched(points: DataFrame, goals: DataFrame, simulate: Simulate, keys: Sequence[str], value: str, bins: int, most: int) -> DataFrame:
    """Per point of ``goals`` (bounds, draws below and between them, ranks) the values at its ranks, ``__at`` by rank."""
    done: list[DataFrame] = []
    wide = (F.col("lo") < F.col("hi")) & (F.col("inside") > most)
    while True:
        goals = session.cut(goals)
        done.append(goals.filter(~wide))
        open_ = goals.filter(wide)
        if open_.isEmpty():
            break
        inside = _goals(points, open_, keys, simulate, value)
        counted = inside.groupBy(*keys, F.col("goal.before").alias("start"), _bin(F.col("__v"), F.col("goal.lo"), F.col("goal.hi"), bins).alias("bin")).agg(
            F.count("*").alias("inside"), F.min("__v").alias("lo"), F.max("__v").alias("hi"), F.first("goal.ranks").alias("ranks")
        )
        # At most ``bins`` rows of a goal meet here.
        upto = F.sum("inside").over(Window.partitionBy(*keys, "start").orderBy("bin"))
        placed = counted.withColumn("before", F.col("start") + upto - F.col("inside"))
        placed = placed.withColumn("ranks", F.filter("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("inside"))))
        goals = placed.filter(F.size("ranks") > 0).select(*keys, "lo", "hi", "before", "inside", "ranks")
    found = reduce(DataFrame.unionByName, done)
    same = found.filter("lo = hi").select(*keys, F.explode("ranks").alias("rank"), F.col("lo").alias("at"))
    looked = _goals(points, found.filter("lo < hi"), keys, simulate, value).groupBy(*keys, F.col("goal.before").alias("before")).agg(
        F.sort_array(F.collect_list("__v")).alias("values"), F.first("goal.ranks").alias("ranks")
    )
    looked = looked.select(*keys, "before", "values", F.explode("ranks").alias("rank"))
    picked = looked.select(*keys, "rank", F.element_at("values", (F.col("rank") - F.col("before") + 1).cast("int")).alias("at"))
    return same.unionByName(picked).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "at"))).alias("__at"))


def drawn_quantiles(
    points: DataFrame, simulate: Simulate, keys: Sequence[str], value: str, quantiles: Mapping[str, float], bins: int = BINS, most: int = MOST,
    near: Mapping[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Per point of ``points`` (unique by ``keys``): n, mean, deviation of its draws and each named quantile, exactly as
    sorting them would give (between two draws the line through them).

    ``simulate`` turns points into their draws, one row each with ``value``; it keeps every other column and gives the same rows whenever it
    is asked, to the last digit: it draws from what the points carry (they are written out first) and sums nothing anew. Draws that are null or not finite are left out; a point without draws has n = 0 and nulls. A null key is a key. With 10^4 draws
    three passes suffice: bounds, one narrowing by ``bins``, the look at what is left. Each further factor of ``bins`` takes one more; equal
    draws end a search at once, as their bounds meet. Shuffled are at most ``bins`` counts per point, goal and task, and once ``most`` draws
    per goal.

    ``near`` may give bounds, from columns of ``points``, that are likely to hold a quantile and few draws. A point is done after the
    first pass when all its ranks fall between such bounds; the ranks are counted, so bounds that miss cost passes and change no result.
    """
    near = list((near or {}).values())
    points = session.cut(points.withColumns({f"__near_{side}_{i}": c for i, bounds in enumerate(near) for side, c in zip(("lo", "hi"), bounds)}))
    facts = session.cut(_first_pass(points, simulate, keys, value, quantiles, len(near)))
    at = {name: F.lit(float(q)) * (F.col("n") - 1) for name, q in quantiles.items()}
    ranks = F.array_distinct(F.concat(*[F.array(F.floor(x), F.ceil(x)) for x in at.values()]))
    per_point, rest = facts.filter("__at IS NOT NULL").select(*keys, "__at"), facts.filter("__at IS NULL")
    if not rest.isEmpty():
        goals = rest.select(
            *keys, "lo", "hi", F.lit(0).cast("bigint").alias("before"), F.col("n").alias("inside"), F.transform(ranks, lambda r: r.cast("bigint")).alias("ranks")
        )
        per_point = per_point.unionByName(_searched(points, goals, simulate, keys, value, bins, most))
    rows = attach(attach(points.select(*keys), facts.drop("lo", "hi", "__at"), keys), per_point, keys).withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    of = lambda r: F.try_element_at("__at", r.cast("bigint"))
    return rows.select(
        *keys, "n", "mean", "deviation",
        *[(of(F.floor(x)) + (of(F.ceil(x)) - of(F.floor(x))) * (x - F.floor(x))).alias(name) for name, x in at.items()],
    )

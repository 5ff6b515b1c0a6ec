"""Regression trees for every series at once, by level-wise histogram search, alone or boosted.

Each feature is cut into equal-width bins between its least and its largest value in the series. One level of all trees of all series is one grouped
sum per (series, node, feature, bin); running sums over the bins give the gain of every cut, and one ``max_by`` keeps the best per node. Rows never
gather by series: only sums leave the scan, so a series may be of any length. A fitted model is a row per series, and a prediction is an
expression over it, so models are saved and read as tables and run in the recursive forecast like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.operators.features import attach

MODEL = "tree_model"
NODE = "struct<feature:int,bin:int,threshold:double,gain:double,n:bigint,value:double>"
MODEL_TYPE = f"struct<base:double,rate:double,trees:array<map<int,{NODE}>>>"


def _binned(rows: DataFrame, keys: list[str], xs: Sequence[str], bins: int) -> tuple[DataFrame, DataFrame]:
    """Rows as (keys, __r, __bins), and per series its rows, sum and limits of the features."""
    stats = session.cut(rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__y").alias("__s"), F.array(*[F.min(x) for x in xs]).alias("__lo"), F.array(*[F.max(x) for x in xs]).alias("__hi"),
    ))
    wide = attach(rows, stats, keys)

    def place(i: int, x: str) -> Column:
        lo, hi = F.col("__lo")[i], F.col("__hi")[i]
        return F.when(hi > lo, F.least(F.floor((F.col(x) - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int")).otherwise(F.lit(0))

    return wide.select(*keys, F.col("__y").alias("__r"), F.array(*[place(i, x) for i, x in enumerate(xs)]).alias("__bins")), stats


def _level(rows: DataFrame, keys: list[str], min_rows: int) -> DataFrame:
    """The best cut of every node that has one: keys, __node, __split (feature, bin, gain, n, s, left n, left s)."""
    by = [*keys, "__node"]
    long = rows.select(*by, "__r", F.posexplode("__bins").alias("__f", "__b"))
    sums = long.groupBy(*by, "__f", "__b").agg(F.count(F.lit(1)).alias("__n"), F.sum("__r").alias("__s"))
    upto = Window.partitionBy(*by, "__f").orderBy("__b")
    whole = Window.partitionBy(*by, "__f")
    n, total = F.sum("__n").over(whole), F.sum("__s").over(whole)
    sums = sums.select(*by, "__f", "__b", F.sum("__n").over(upto).alias("__ln"), F.sum("__s").over(upto).alias("__ls"), n.alias("__all"), total.alias("__t"))
    left_n, left_s = F.col("__ln"), F.col("__ls")
    right_n, right_s = F.col("__all") - left_n, F.col("__t") - left_s
    sums = sums.filter((left_n >= min_rows) & (right_n >= min_rows))
    sums = sums.withColumn("__gain", left_s * left_s / left_n + right_s * right_s / right_n - F.col("__t") * F.col("__t") / F.col("__all")).filter("__gain > 0")
    # Ties go to the earlier feature, then to the lower cut.
    kept = {"feature": "__f", "bin": "__b", "gain": "__gain", "n": "__all", "s": "__t", "ln": "__ln", "ls": "__ls"}
    best = F.max_by(F.struct(*[F.col(c).alias(name) for name, c in kept.items()]), F.struct("__gain", -F.col("__f"), -F.col("__b")))
    return sums.groupBy(*by).agg(best.alias("__split"))


def _tree(binned: DataFrame, stats: DataFrame, keys: list[str], depth: int, bins: int, min_rows: int) -> DataFrame:
    """keys, __tree: one tree per series on the column __r."""
    rows = binned.withColumn("__node", F.lit(1))
    splits = None
    for level in range(depth):
        found = session.cut(_level(rows, keys, min_rows))
        splits = found if splits is None else splits.unionByName(found)
        if level + 1 < depth:
            here = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__node", "__split"))).alias("__at"))
            rows = attach(rows, here, keys, "inner").withColumn("__split", F.try_element_at("__at", F.col("__node"))).filter("__split IS NOT NULL")
            right = (F.get(F.col("__bins"), F.col("__split.feature")) > F.col("__split.bin")).cast("int")
            rows = rows.select(*keys, "__r", "__bins", (2 * F.col("__node") + right).alias("__node"))
    s = F.col("__split")
    lo, hi = F.get(F.col("__lo"), s["feature"]), F.get(F.col("__hi"), s["feature"])
    none = F.lit(None)

    def node(number: Column, n: Column, total: Column, feature: Column = none, cut: Column = none, threshold: Column = none, gain: Column = none) -> Column:
        body = F.struct(feature.cast("int").alias("feature"), cut.cast("int").alias("bin"), threshold.cast("double").alias("threshold"), gain.cast("double").alias("gain"),
                        n.cast("bigint").alias("n"), (total / n).alias("value"))
        return F.struct(number.cast("int").alias("node"), body.alias("body"))

    at = F.col("__node")
    made = F.array(
        node(at, s["n"], s["s"], s["feature"], s["bin"], lo + (hi - lo) * (s["bin"] + 1) / bins, s["gain"]),
        node(2 * at, s["ln"], s["ls"]), node(2 * at + 1, s["n"] - s["ln"], s["s"] - s["ls"]),
    )
    nodes = attach(splits, stats.select(*keys, "__lo", "__hi"), keys).select(*keys, F.explode(made).alias("__e"))
    root = stats.select(*keys, node(F.lit(1), F.col("__n"), F.col("__s")).alias("__e"))
    # A leaf that a deeper level splits again gives way to its split.
    nodes = nodes.unionByName(root).groupBy(*keys, F.col("__e.node").alias("__node")).agg(F.max_by("__e.body", F.col("__e.body.feature").isNotNull()).alias("__body"))
    return nodes.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__node", "__body")))).alias("__tree"))


def _walk(tree: Column, goes_right) -> Column:
    """The value of the leaf that a row reaches; null where a needed feature is missing."""
    deepest = F.array_max(F.map_keys(tree))
    steps = F.sequence(F.lit(0), F.length(F.bin(deepest.cast("bigint"))).cast("int"))

    def step(node: Column, _: Column) -> Column:
        here = F.try_element_at(tree, node)
        return F.when(here["feature"].isNull(), node).otherwise(2 * node + goes_right(here).cast("int"))

    return F.try_element_at(tree, F.aggregate(steps, F.lit(1), step))["value"]


def fit(df: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str, depth: int = 3, bins: int = 32, min_rows: int = 2, rounds: int = 1, rate: float = 1.0) -> DataFrame:
    """One row per series of ``df``: its keys, ``tree_model`` and ``error``.

    Rows with a gap are left out. A series with fewer than ``2 * min_rows`` whole rows has no model but a row that says so in ``error``; the
    others are not held up by it. A null key is a series of its own. ``rounds`` over 1 boosts: trees are fitted to what is left of the target after its
    mean and ``rate`` times the trees before.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(y).cast("double").alias("__y"), *[F.col(x).cast("double").alias(x) for x in xs]).na.drop(subset=["__y", *xs])
    binned, stats = _binned(rows, keys, xs, bins)
    fine = stats.filter(F.col("__n") >= 2 * min_rows)
    mean = F.col("__s") / F.col("__n") if rounds > 1 else F.lit(0.0)
    binned = attach(binned, fine.select(*keys, mean.alias("__base")), keys, "inner")
    binned = session.cut(binned.withColumn("__r", F.col("__r") - F.col("__base")).drop("__base"))
    model = fine.select(*keys, mean.alias("__base"), F.array().cast(f"array<map<int,{NODE}>>").alias("__trees"))
    for k in range(rounds):
        left = stats if k == 0 and rounds == 1 else attach(stats.drop("__s"), binned.groupBy(*keys).agg(F.sum("__r").alias("__s")), keys, "inner")
        tree = session.cut(_tree(binned, attach(left, fine.select(*keys), keys, "left_semi"), keys, depth, bins, min_rows))
        model = attach(model, tree, keys).withColumn("__trees", F.concat("__trees", F.array("__tree"))).drop("__tree")
        if k + 1 < rounds:
            reached = _walk(F.col("__tree"), lambda here: F.get(F.col("__bins"), here["feature"]) > here["bin"])
            binned = session.cut(attach(binned, tree, keys).withColumn("__r", F.col("__r") - rate * reached).drop("__tree"))
    packed = F.struct(F.col("__base").alias("base"), F.lit(float(rate)).alias("rate"), F.col("__trees").alias("trees"))
    every = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__all"))
    every = attach(attach(every, stats.select(*keys, "__n"), keys), model.select(*keys, packed.alias(MODEL)), keys)
    short = F.concat(F.lit("too few whole rows: "), F.coalesce("__n", F.lit(0)).cast("string"))
    return every.select(*keys, MODEL, F.when(F.col(MODEL).isNull(), short).alias("error"))


def predicted(values: Sequence[Column], model: str | Column = MODEL) -> Column:
    """The prediction of a model column for feature values; null without a model or where a feature on the way is missing."""
    m = F.col(model) if isinstance(model, str) else model
    x = F.array(*[v.cast("double") for v in values])
    right = lambda here: F.get(x, here["feature"]) > here["threshold"]
    return m["base"] + F.aggregate(m["trees"], F.lit(0.0), lambda total, tree: total + m["rate"] * _walk(tree, right))


def predictor(xs: Sequence[str]):
    """Predict with the model carried on each state row of a recursive forecast."""

    def predict(features: Mapping[str, Column]) -> Column:
        return predicted([features[x] for x in xs])

    return predict


def importances(models: DataFrame, keys: Sequence[str], xs: Sequence[str]) -> DataFrame:
    """keys, feature, importance: each feature's share of the gains of its series' trees; zeros where nothing was split, no rows without a model."""
    nodes = F.flatten(F.transform(F.col(f"{MODEL}.trees"), lambda t: F.map_values(t)))
    gain = lambda i: F.aggregate(nodes, F.lit(0.0), lambda a, b: a + F.when(b["feature"] == i, b["gain"]).otherwise(0.0))
    wide = models.filter(F.col(MODEL).isNotNull()).select(*keys, *[gain(i).alias(f"__g{i}") for i in range(len(xs))])
    total = sum((F.col(f"__g{i}") for i in range(1, len(xs))), F.col("__g0"))
    pairs = F.array(*[F.struct(F.lit(x).alias("feature"), F.col(f"__g{i}").alias("gain"), F.coalesce(F.try_divide(F.col(f"__g{i}"), total), F.lit(0.0)).alias("importance")) for i, x in enumerate(xs)])
    return wide.select(*keys, F.explode(pairs).alias("__e")).select(*keys, "__e.*")

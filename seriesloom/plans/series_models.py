"""Models per series: every candidate fitted to every series at once, the best one of each kept, saved and run.

The models are a table, one row per series, so training writes rows and inference reads them; a series that no candidate can be fitted to is a row with
``error`` and holds up no other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.operators import forecast as fc
from seriesloom.operators import metrics as mt
from seriesloom.operators import series_trees as trees
from seriesloom.operators.cleaning import holdout
from seriesloom.operators.features import attach
from seriesloom.operators.panel import Panel
from seriesloom.operators.regression import FIT, least_squares
from seriesloom.plans import config
from seriesloom.plans.config import FeatureSet

LINEAR, TREE, BOOSTED = "linear", "tree", "boosted"
METRICS = ("MAPE", "RMSE", "MAE")


@dataclass(frozen=True)
class Candidates:
    """Which kinds of model are tried, and how trees are grown."""

    kinds: tuple[str, ...] = (LINEAR, TREE)
    depth: int = 3
    bins: int = 32
    min_rows: int = 2
    rounds: int = 10
    rate: float = 0.3

    def fit(self, rows: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str) -> DataFrame:
        """keys and one column per kind: the model, null where it cannot be fitted."""
        out = rows.select(*keys).distinct()
        for kind in self.kinds:
            if kind == LINEAR:
                one = least_squares(rows, keys, xs, y).select(*keys, F.when(F.col(f"{FIT}.coefficients").isNotNull(), F.col(FIT)).alias(kind))
            else:
                more = {"rounds": self.rounds, "rate": self.rate} if kind == BOOSTED else {}
                one = trees.fit(rows, keys, xs, y, self.depth, self.bins, self.min_rows, **more).select(*keys, F.col(trees.MODEL).alias(kind))
            out = attach(out, one, list(keys))
        return session.cut(out)


def _predictions(kind: str, values: Sequence[Column], model: Column) -> Column:
    if kind != LINEAR:
        return trees.predicted(values, model)
    out = model["intercept"]
    for i, v in enumerate(values):
        out = out + model["coefficients"][i] * v
    return out


def train(panel: Panel, fs: FeatureSet, days: int, candidates: Candidates = Candidates(), metric: str = "MAPE") -> tuple[DataFrame, DataFrame]:
    """The models table and the score of every candidate on every series' last ``days`` days.

    Candidates are fitted to the rows before, scored on the last days, and the one with the least ``metric`` (ties: the earlier kind) is fitted again to all rows.
    Models: keys, model_type, score, one column per kind (null but for the chosen one), error. Scores: keys, model_type, MAPE, RMSE, MAE.
    """
    s, y, xs = panel.series, fs.target, config.output_names(fs)
    rows = session.cut(holdout(config.build(panel, fs, fill=None).df, s, panel.order[0], days))
    fitted = candidates.fit(rows.filter("part = 'train'"), s, xs, y)
    tests = attach(rows.filter("part = 'validation'"), fitted, s)
    values = [F.col(x) for x in xs]
    each = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(k).alias("model_type"), _predictions(k, values, F.col(k)).alias("forecast")) for i, k in enumerate(candidates.kinds)])
    scored = tests.select(*s, F.col(y).alias("actual"), F.explode(each).alias("__c")).select(*s, "actual", "__c.*").filter("forecast IS NOT NULL AND actual IS NOT NULL")
    scores = session.cut(scored.groupBy(*s, "at", "model_type").agg(
        mt.mape("actual", "forecast").alias("MAPE"), mt.rmse("actual", "forecast").alias("RMSE"), mt.mae("actual", "forecast").alias("MAE")))
    usable = scores.filter(F.col(metric).isNotNull())
    best = usable.groupBy(*s).agg(F.min_by("model_type", F.struct(metric, "at")).alias("model_type"), F.min(metric).alias("score"))
    final = attach(candidates.fit(rows, s, xs, y), best, s)
    chosen = [F.when(F.col("model_type") == k, F.col(k)).alias(k) for k in candidates.kinds]
    error = F.when(F.col("model_type").isNull(), F.lit("no candidate could be fitted and scored"))
    return final.select(*s, "model_type", "score", *chosen, error.alias("error")), scores.drop("at")


def save(models: DataFrame, path: str, run_date: str) -> None:
    """Write the models of a run; a run that is repeated replaces its own rows and no others."""
    from seriesloom.sources import sinks

    sinks.replace_run(models.withColumn("run_date", F.to_date(F.lit(run_date))), path, ["run_date"])


def load(spark, path: str, run_date: str | None = None) -> DataFrame:
    """The saved models of a run, the newest where none is named."""
    every = spark.read.parquet(path)
    if run_date is None:
        newest = every.agg(F.max("run_date")).first()[0]
        return every.filter(F.col("run_date") == F.lit(newest)).drop("run_date")
    return every.filter(F.col("run_date") == F.to_date(F.lit(run_date))).drop("run_date")


def infer(panel: Panel, fs: FeatureSet, models: DataFrame, horizon: int, run_date: str) -> DataFrame:
    """keys, step, forecast, model_type, error, run_date: the recursive forecast of each series by its own saved model.

    Series whose model row has an error, and series without a row, keep their rows with a null forecast. Only features of the target's own past are taken.
    """
    if config.output_names(fs.outside()):
        raise ValueError("features of other columns need jobs.inference")
    s, xs = panel.series, config.output_names(fs)
    kinds = [k for k in (LINEAR, TREE, BOOSTED) if k in models.columns]
    state = attach(fc.series_state(panel, fs.target, fs.memory()), models.drop("score"), s)

    def predict(features) -> Column:
        out = F.lit(None).cast("double")
        for k in kinds:
            out = F.when(F.col("model_type") == k, _predictions(k, [features[x] for x in xs], F.col(k))).otherwise(out)
        return out

    made = fc.recursive_forecast(state, fs, predict, horizon)
    error = F.coalesce("error", F.when(F.col("model_type").isNull(), F.lit("no model")))
    return made.select(*s, "step", F.col("prediction").alias("forecast"), "model_type", error.alias("error"), F.to_date(F.lit(run_date)).alias("run_date"))


def sorted_importances(models: DataFrame, keys: Sequence[str], xs: Sequence[str], kind: str = TREE) -> DataFrame:
    """feature, importance: the shares of all series' gains, the largest first."""
    each = trees.importances(models.withColumnRenamed(kind, trees.MODEL), keys, xs)
    per = each.groupBy("feature").agg(F.sum("gain").alias("gain"))
    share = F.coalesce(F.try_divide(F.col("gain"), F.col("__all")), F.lit(0.0))
    return attach(per, per.agg(F.sum("gain").alias("__all")), []).select("feature", share.alias("importance")).orderBy(F.desc("importance"), "feature")


__all__ = ["BOOSTED", "Candidates", "LINEAR", "TREE", "infer", "load", "save", "sorted_importances", "train"]

"""Regressors behind one small interface: fit on a feature frame, predict on a feature frame."""

from __future__ import annotations

import json
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.operators import metrics as mt
from seriesloom.operators.regression import FIT, _solve, fitted_value, least_squares

# --- fixed values: parameter spaces offered for tuning ---
SPACES = {
    "forest": {"numTrees": [20, 50], "maxDepth": [4, 6], "minInstancesPerNode": [1, 4]},
    "boosted": {"maxIter": [10, 20], "maxDepth": [3, 5], "stepSize": [0.05, 0.1]},
    "tree": {"maxDepth": [3, 5, 8], "minInstancesPerNode": [1, 10]},
    "ridge": {"regParam": [0.01, 0.1, 1.0, 10.0]},
}
# ---------------------------------------------------------

_MAKERS = {
    "forest": lambda p: RandomForestRegressor(seed=7, **p),
    "boosted": lambda p: GBTRegressor(seed=7, **p),
    "tree": lambda p: DecisionTreeRegressor(seed=7, **p),
    "ridge": lambda p: LinearRegression(elasticNetParam=0.0, solver="normal", **{"regParam": 0.1, **p}),
    "linear": lambda p: LinearRegression(regParam=0.0, solver="normal", **p),
}


@dataclass(frozen=True)
class ModelSpec:
    """A regressor by kind and parameters; ``name`` labels it in reports."""

    kind: str
    params: Mapping[str, object] = field(default_factory=dict)
    name: str = ""

    @property
    def label(self) -> str:
        return self.name or self.kind


DEFAULT_MODELS = (ModelSpec("forest", {"numTrees": 20, "maxDepth": 5}), ModelSpec("ridge"))


@dataclass(frozen=True)
class Fitted:
    """A fitted regressor and the features it reads."""

    spec: ModelSpec
    features: tuple[str, ...]
    model: PipelineModel

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; null where a feature is missing. No row is dropped."""
        whole = F.lit(True)
        for f in self.features:
            whole = whole & F.col(f).isNotNull()
        core = self.model.stages[-1]
        if isinstance(core, LinearRegressionModel) and all(t != "vector" for _, t in df.select(*self.features).dtypes):
            # A sum in generated code, in the order of the model's own; building a vector per row costs many times as much.
            value = F.lit(0.0)
            for f, b in zip(self.features, core.coefficients):
                value = value + F.col(f).cast("double") * F.lit(float(b))
            return df.drop("prediction").withColumn("prediction", F.when(whole, value + F.lit(float(core.intercept))))
        out = self.model.transform(df.drop("prediction"))
        return out.withColumn("prediction", F.when(whole, F.col("prediction"))).drop("__vector")

    def importances(self, spark) -> DataFrame:
        """One row per feature; zeros when the model has no importances."""
        core: Model = self.model.stages[-1]
        values = core.featureImportances.toArray() if hasattr(core, "featureImportances") else np.zeros(len(self.features))
        rows = [(f, float(v), self.spec.label) for f, v in zip(self.features, values)]
        return spark.createDataFrame(rows, "feature string, importance double, model_type string")

    def coefficients(self) -> dict[str, float] | None:
        core = self.model.stages[-1]
        return dict(zip(self.features, map(float, core.coefficients))) if hasattr(core, "coefficients") else None

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


def load(spec: ModelSpec, features: Sequence[str], path: str) -> Fitted:
    return Fitted(spec, tuple(features), PipelineModel.load(path))


def fit(spec: ModelSpec, train: DataFrame, features: Sequence[str], target: str) -> Fitted:
    """Fit one model over all series; rows with a gap are left out of training."""
    rows = train.na.drop(subset=[*features, target]).withColumn("__label", F.col(target).cast("double"))
    assembler = VectorAssembler(inputCols=list(features), outputCol="__vector", handleInvalid="keep")
    core = _MAKERS[spec.kind](dict(spec.params)).setFeaturesCol("__vector").setLabelCol("__label")
    return Fitted(spec, tuple(features), Pipeline(stages=[assembler, core]).fit(rows))


def vector_column(df: DataFrame, features: Sequence[str]) -> DataFrame:
    out = VectorAssembler(inputCols=list(features), outputCol="__vector", handleInvalid="keep").transform(df)
    return out.withColumn("features", vector_to_array("__vector")).drop("__vector")


# -- tuning ------------------------------------------------------------------------------------


def grid(kind: str, space: Mapping[str, Sequence] | None = None) -> list[ModelSpec]:
    space = SPACES[kind] if space is None else space
    names = sorted(space)
    return [ModelSpec(kind, dict(zip(names, values))) for values in product(*[space[n] for n in names])]


def sample_grid(kind: str, n: int, seed: int = 7, space: Mapping[str, Sequence] | None = None) -> list[ModelSpec]:
    """n distinct draws from the parameter grid."""
    every = grid(kind, space)
    return random.Random(seed).sample(every, min(n, len(every)))


def score_specs(
    specs: Sequence[ModelSpec], folds: Sequence[tuple[DataFrame, DataFrame]], features: Sequence[str], target: str, spark
) -> DataFrame:
    """Mean absolute percent error of every spec on every (train, test) fold: the tuning table.

    Each fold's frames are cached while the specs run over them.
    """
    rows = []
    for i, (train, test) in enumerate(folds):
        train, test = train.persist(), test.persist()
        for spec in specs:
            scored = fit(spec, train, features, target).predict(test)
            got = scored.agg(mt.mape(target, "prediction").alias("m"), mt.rmse(target, "prediction").alias("r")).first()
            rows.append((spec.kind, {k: str(v) for k, v in spec.params.items()}, i, got["m"], got["r"]))
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(rows, "kind string, params map<string,string>, fold int, mape double, rmse double")


def best_params(table: DataFrame) -> DataFrame:
    """Parameters with the lowest mean error per kind, as JSON."""
    params = F.col("params") if table.schema["params"].dataType.typeName() == "string" else F.to_json("params")
    per = table.groupBy("kind", params.alias("params")).agg(F.avg("mape").alias("mape"))
    return per.groupBy("kind").agg(F.min_by("params", F.struct("mape", "params")).alias("params"), F.min("mape").alias("mape"))


def read_spec(spark, folder: str, kind: str) -> ModelSpec:
    """The spec of ``kind`` with the parameters that ``sinks.write_params`` saved; the defaults where none are saved."""
    found = spark.read.schema("params string, mape double, kind string").json(folder).filter(F.col("kind") == kind).select("params").head(1)
    return ModelSpec(kind, json.loads(found[0]["params"]) if found else {})


def subset_scores(df: DataFrame, fold: str, features: Sequence[str], target: str, spark, most: int | None = None) -> DataFrame:
    """Cross-validated squared error of every feature subset of a linear model, lower is better.

    One aggregate gives each fold's moments; leaving a fold out is a subtraction, so no subset touches the rows again. The subsets are numbers
    whose bits pick features; they are dealt over the executors with the moments, and each is solved there. ``most`` limits the
    subsets' size if given. ``fold`` is a column of few values.
    """
    cols = [*features, target]
    rows = df.na.drop(subset=cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    # Centre on the overall means so that sums of products stay well conditioned.
    centre = rows.agg(*[F.avg(c).alias(c) for c in cols]).first()
    x = [F.col(c) - F.lit(float(centre[c])) for c in cols]
    got = rows.groupBy(F.col(fold).cast("string").alias("fold")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(v) for v in x]).alias("s"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("ss"),
    ).orderBy("fold").collect()
    k = len(cols)

    def unpack(r):
        m = np.zeros((k, k))
        for (i, j), v in zip(pairs, r["ss"]):
            m[i, j] = m[j, i] = v
        return r["n"], np.array(r["s"]), m

    parts = [unpack(r) for r in got]
    n_all, s_all, m_all = (sum(p[i] for p in parts) for i in range(3))

    def score(bits: int) -> float:
        pick = np.array([*[i for i in range(k - 1) if bits >> i & 1], k - 1])
        error = 0.0
        for n, s, m in parts:
            tn, ts, tm = n_all - n, s_all - s, m_all - m
            means = ts[pick] / tn
            solved = _solve(tn, means, tm[np.ix_(pick, pick)] / tn - np.outer(means, means), 0.0)
            w = np.array([*solved["coefficients"], -1.0])
            b = solved["intercept"]
            error += w @ m[np.ix_(pick, pick)] @ w + 2 * b * (w @ s[pick]) + n * b * b
        return float(error / n_all)

    @F.pandas_udf("double")
    def mse(bits: pd.Series) -> pd.Series:
        return bits.map(score)

    size = F.bit_count("bits").cast("int")
    subsets = spark.range(1, 1 << (k - 1)).withColumnRenamed("id", "bits")
    if most is not None:
        subsets = subsets.filter(size <= most)
    named = F.concat_ws(",", *[F.when(F.col("bits").bitwiseAND(F.lit(1 << i)) != 0, F.lit(f)) for i, f in enumerate(features)])
    return subsets.select(named.alias("features"), size.alias("size"), mse("bits").alias("mse"))


def series_fit(df: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str, ridge: float = 0.0) -> DataFrame:
    """One linear fit per series from one aggregate."""
    return least_squares(df, keys, xs, y, ridge)


def series_predictor(xs: Sequence[str]):
    """Predict with the fit carried on each state row."""

    def predict(features: Mapping[str, Column]) -> Column:
        return fitted_value([features[x] for x in xs])

    return predict


__all__ = [
    "DEFAULT_MODELS", "FIT", "Fitted", "ModelSpec", "best_params", "fit", "grid", "load", "read_spec", "sample_grid", "score_specs",
    "series_fit", "series_predictor", "subset_scores", "vector_column",
]

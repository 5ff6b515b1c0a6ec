"""Reshaping, choosing and combining rows of reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.cleaning import first_per_key, last_rows


def pivot_mean(df: DataFrame, rows: Sequence[str], label: str, value: str, labels: Sequence) -> DataFrame:
    """One column per label of ``labels`` holding the mean value. Where the labels are not known, keep the long form."""
    return df.groupBy(*rows).pivot(label, list(labels)).agg(F.avg(value))


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], kind: str = "kind", value: str = "value") -> DataFrame:
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(list(ids), list(cols), kind, value)


def ensemble_mean(df: DataFrame, keys: Sequence[str], predicted: str, out: str = "ensemble") -> DataFrame:
    """Mean over models of each point's prediction, from the long form; nulls are skipped."""
    return df.groupBy(*keys).agg(F.avg(predicted).alias(out))


def best_model(df: DataFrame, keys: Sequence[str], model: str, metric: str) -> DataFrame:
    """Model with the lowest metric per key; the name breaks ties."""
    return df.groupBy(*keys).agg(
        F.min_by(model, F.when(F.col(metric).isNotNull(), F.struct(metric, model))).alias("best_model"),
        F.min(metric).alias("best_metric"),
    )


def win_counts(df: DataFrame, keys: Sequence[str], model: str, metric: str) -> DataFrame:
    """How often each model is the best of its key."""
    return best_model(df, keys, model, metric).groupBy(F.col("best_model").alias(model)).agg(F.count("*").alias("wins"))


def last_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return last_rows(df, keys, order, 1, "__rank").drop("__rank")


def first_rows_by(df: DataFrame, c: str, n: int, ties: Sequence[str], descending: bool = True) -> DataFrame:
    """Top-n report rows by a column."""
    by = F.col(c).desc() if descending else F.col(c).asc()
    return df.orderBy(by, *ties).limit(n)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def champion_or_challenger(champion: DataFrame, challenger: DataFrame, metric: str, model: str) -> DataFrame:
    """Keep the champion unless the challenger's metric is lower; each side is one row, and more than one is an error."""

    def only(df: DataFrame, name: str) -> DataFrame:
        one = F.when(F.count(F.lit(1)) <= 1, F.first(F.struct(F.col(model), F.col(metric)))).otherwise(F.raise_error(F.lit(f"more than one {name}")))
        return df.agg(one.alias("__r"), F.count(F.lit(1)).alias("__n")).where("__n > 0").select(F.col(f"__r.{model}").alias(name), F.col(f"__r.{metric}").alias(f"{name}_metric"))

    a, b = only(champion, "champion"), only(challenger, "challenger")
    swap = F.col("challenger_metric") < F.col("champion_metric")
    return a.crossJoin(F.broadcast(b)).withColumns(
        {"chosen": F.when(swap, F.col("challenger")).otherwise(F.col("champion")), "swapped": F.coalesce(swap, F.lit(False))}
    )


__all__ = [
    "best_model", "champion_or_challenger", "ensemble_mean", "first_per_key", "first_rows_by", "last_per_group",
    "melt", "pivot_mean", "stack", "win_counts",
]

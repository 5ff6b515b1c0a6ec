"""Least squares per key from mergeable moments: one aggregate, one small solve per key."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT = "fit"
FIT_TYPE = "struct<coefficients:array<double>,errors:array<double>,intercept:double,rss:double,n:bigint>"


def _solve(n: int, means: np.ndarray, cov: np.ndarray, ridge: float) -> dict:
    """Centred normal equations; the last column is the target."""
    p = len(means) - 1
    blank = {"coefficients": None, "errors": None, "intercept": None, "rss": None, "n": n}
    if n == 0 or np.isnan(cov).any():
        return blank
    gram, xy, yy = cov[:p, :p] * n, cov[:p, p] * n, cov[p, p] * n
    # Scale to unit diagonal so the rank test does not depend on units.
    scale = np.sqrt(np.diag(gram + ridge * np.eye(p)))
    scale[scale == 0] = 1.0
    inverse = np.linalg.pinv((gram + ridge * np.eye(p)) / np.outer(scale, scale), rcond=1e-12, hermitian=True) / np.outer(scale, scale)
    b = inverse @ xy
    rss = max(float(yy - 2 * b @ xy + b @ gram @ b), 0.0)
    free = n - p - 1
    errors = np.sqrt(np.maximum(np.diag(inverse), 0.0) * rss / free).tolist() if free > 0 else None
    return {
        "coefficients": b.tolist(), "errors": errors, "intercept": float(means[p] - b @ means[:p]), "rss": rss, "n": int(n),
    }


def least_squares(df: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str, ridge: float = 0.0) -> DataFrame:
    """Fit ``y`` on ``xs`` with an intercept, per key. Rows with a gap are left out.

    Only means and covariances leave the scan, so a key of any length costs one buffer per task.
    """
    cols = [*xs, y]
    rows = df.na.drop(subset=cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    moments = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.array(*[F.avg(c) for c in cols]).alias("__means"),
        F.array(*[F.covar_pop(cols[i], cols[j]) for i, j in pairs]).alias("__cov"),
    )
    k = len(cols)

    @F.pandas_udf(FIT_TYPE)
    def solve(n: pd.Series, means: pd.Series, cov: pd.Series) -> pd.DataFrame:
        out = []
        for count, m, flat in zip(n, means, cov):
            full = np.zeros((k, k))
            for (i, j), v in zip(pairs, flat):
                full[i, j] = full[j, i] = np.nan if v is None else v
            out.append(_solve(int(count), np.asarray(m, dtype="float64"), full, ridge))
        return pd.DataFrame(out, columns=["coefficients", "errors", "intercept", "rss", "n"])

    return moments.select(*keys, solve("__n", "__means", "__cov").alias(FIT))


def fitted_value(xs: Sequence[Column]) -> Column:
    """The fit applied to feature columns."""
    value = F.col(f"{FIT}.intercept")
    for i, x in enumerate(xs):
        value = value + F.col(f"{FIT}.coefficients")[i] * x
    return value


def coefficient_table(fits: DataFrame, keys: Sequence[str], xs: Sequence[str], z: float = 1.96) -> DataFrame:
    """One row per coefficient with its interval and whether the interval leaves zero out."""
    rows = fits.select(
        *keys,
        F.explode(
            F.arrays_zip(
                F.array(*[F.lit(x) for x in xs]).alias("name"), F.col(f"{FIT}.coefficients").alias("value"), F.col(f"{FIT}.errors").alias("error")
            )
        ).alias("c"),
    )
    out = rows.select(
        *keys,
        F.col("c.name").alias("feature"),
        F.col("c.value").alias("coefficient"),
        (F.col("c.value") - z * F.col("c.error")).alias("lower"),
        (F.col("c.value") + z * F.col("c.error")).alias("upper"),
    )
    return out.withColumn("significance", significance("lower", "upper"))


def significance(lower: str, upper: str) -> Column:
    return F.when((F.col(lower) < 0) & (F.col(upper) > 0), "not significant").otherwise("significant")

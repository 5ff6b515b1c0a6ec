"""Contributions to a forecast, intervals around it, and simulated forecasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.functions.columns import sdiv
from seriesloom.operators.cleaning import exact_quantiles
from seriesloom.operators.features import attach

# --- fixed values: normal quantiles for two-sided coverage ---
Z_FOR_COVERAGE = {80: 1.2815515655446004, 90: 1.6448536269514722, 95: 1.959963984540054}
# -------------------------------------------------------------

DRAWS_PER_BLOCK = 10_000


def linear_contributions(df: DataFrame, keys: Sequence[str], coefficients: Mapping[str, float]) -> DataFrame:
    """Coefficient times distance from the feature's mean, per row."""
    means = df.agg(*[F.avg(c).alias(f"__m_{c}") for c in coefficients])
    rows = attach(df, means, [])
    return rows.select(*keys, *[(F.lit(float(b)) * (F.col(c) - F.col(f"__m_{c}"))).alias(c) for c, b in coefficients.items()])


def rescaled_contributions(df: DataFrame, cols: Sequence[str], prediction: str, last: str) -> DataFrame:
    """Scale contributions so that they sum to the move from the last value to the prediction."""
    whole = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    scale = sdiv(F.col(prediction) - F.col(last), whole)
    return df.withColumn("__scale", scale).withColumns({c: F.col(c) * F.col("__scale") for c in cols}).drop("__scale")


def interval(prediction: str, rmse: str, coverage: int = 80) -> dict[str, Column]:
    half = Z_FOR_COVERAGE[coverage] * F.col(rmse)
    return {"half_width": half, "lower": F.col(prediction) - half, "upper": F.col(prediction) + half}


def draw_interval(draws: DataFrame, keys: Sequence[str], value: str, lower: float = 0.05, upper: float = 0.95, **kw) -> DataFrame:
    """Bounds from simulated forecasts, exact quantiles per point."""
    return exact_quantiles(draws, keys, value, {"lower": lower, "upper": upper}, **kw)


def bin_probabilities(draws: DataFrame, keys: Sequence[str], value: str, width: float, last: str | None = None) -> DataFrame:
    """Share of draws per price bin ``[lo, lo + width)``, and the bin's distance to the last price."""
    lo = (F.floor(F.col(value) / width) * width).cast("double")
    per = draws.groupBy(*keys, *([last] if last else []), lo.alias("bin_lo")).agg(F.count(F.lit(1)).alias("__n"))
    total = draws.groupBy(*keys).agg(F.count(F.lit(1)).alias("__all"))
    out = attach(per, total, keys).withColumn("probability", F.col("__n") / F.col("__all"))
    if last:
        out = out.withColumns({"delta_lo": F.col("bin_lo") - F.col(last), "delta_hi": F.col("bin_lo") + width - F.col(last)})
    return out.drop("__n", "__all")


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) fixed by its inputs."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / F.lit(float(2**53))


def standard_normal(*parts: Column, seed: int = 7) -> Column:
    """A normal draw fixed by its inputs, so a task that runs again draws the same."""
    u, v = _uniform(*parts, F.lit(seed)), _uniform(*parts, F.lit(seed + 1_000_003))
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v)


def with_moments(history: DataFrame, future: DataFrame, series: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Each future row with mean and deviation of its series' history, ``__m_`` and ``__s_`` before the column's name.

    Sums of floats depend on the order in which partial sums arrive, so moments worked out twice may differ in their last digits. Whoever
    draws more than once from them writes these rows out first.
    """
    moments = history.groupBy(*series).agg(
        *[f(c).alias(f"__{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))]
    )
    return attach(future.drop(*cols), moments, series)


def drawn_inputs(rows: DataFrame, keys: Sequence[str], cols: Sequence[str], draws: int, seed: int = 7) -> DataFrame:
    """Each row of ``with_moments`` (unique by ``keys``) ``draws`` times, exogenous columns drawn from a normal with its moments.

    Blocks of draws are spread over all shuffle partitions, whatever their size in bytes, so one series' draws do not stay in one task. Where
    a row's draws are one block, they are dealt by ``keys``, and what is grouped by these needs no further shuffle.
    """
    blocks = rows.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit((draws - 1) // DRAWS_PER_BLOCK))))
    blocks = session.spread(blocks, [*keys, *(["__block"] if draws > DRAWS_PER_BLOCK else [])])
    ids = F.sequence(
        F.col("__block") * DRAWS_PER_BLOCK, F.least((F.col("__block") + 1) * DRAWS_PER_BLOCK, F.lit(draws)) - 1
    )
    out = blocks.withColumn("draw", F.explode(ids))
    by = [F.col(k) for k in keys]
    out = out.withColumns(
        {c: F.col(f"__m_{c}") + F.col(f"__s_{c}") * standard_normal(*by, F.col("draw"), F.lit(c), seed=seed) for c in cols}
    )
    return out.drop("__block", *[f"__{n}_{c}" for c in cols for n in ("m", "s")])


def simulated_inputs(history: DataFrame, future: DataFrame, keys: Sequence[str], series: Sequence[str], cols: Sequence[str], draws: int, seed: int = 7) -> DataFrame:
    """Each future row (unique by ``keys``) ``draws`` times, exogenous columns drawn from a normal
    with the history's moments."""
    return drawn_inputs(with_moments(history, future, series, cols), keys, cols, draws, seed)

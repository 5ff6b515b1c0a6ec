"""Forecast error metrics, reports over them, and distribution summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.functions.columns import rounded, sdiv
from seriesloom.operators.cleaning import exact_quantiles
from seriesloom.operators.features import attach

# --- fixed values: decimals each reported metric is rounded to ---
DECIMALS = {"MAPE": 4, "RMSE": 2, "MAE": 2, "R2": 4, "WAPE": 2, "Bias": 3, "MAPE_6W": 4, "RMSE_6W": 2}
DAILY_DECIMALS = 3
WAPE_DECIMALS = 5
MPE_DECIMALS = 7
RUN_DECIMALS = 4
GAP_DECIMALS = 2
RUN_METRICS = ("MAPE", "RMSE", "MAPE_6W", "RMSE_6W", "TRAINING_MAPE", "TRAINING_RMSE")
# ------------------------------------------------------------------


def _error(a: str, p: str) -> Column:
    return F.col(a).cast("double") - F.col(p).cast("double")


def mape(a: str, p: str) -> Column:
    return F.avg(F.abs(sdiv(_error(a, p), a)))


def rmse(a: str, p: str) -> Column:
    e = _error(a, p)
    return F.sqrt(F.avg(e * e))


def mae(a: str, p: str) -> Column:
    return F.avg(F.abs(_error(a, p)))


def r2(a: str, p: str) -> Column:
    e = _error(a, p)
    paired = F.when(F.col(p).isNotNull(), F.col(a).cast("double"))
    return 1 - sdiv(F.sum(e * e), F.var_pop(paired) * F.count(paired))


def wape(a: str, p: str) -> Column:
    """Total absolute error over the total of the actuals."""
    return sdiv(F.sum(F.abs(_error(a, p))), F.sum(F.when(F.col(p).isNotNull(), F.col(a))))


def absolute_wape(a: str, p: str) -> Column:
    """Total absolute error over the total absolute actual; infinite when that is zero."""
    total = F.sum(F.abs(F.col(a).cast("double")))
    return rounded(
        F.when(total == 0, F.lit(float("inf"))).otherwise(sdiv(F.sum(F.abs(_error(a, p))), total)), WAPE_DECIMALS
    )


def mean_percent_error(a: str, p: str) -> Column:
    return rounded(sdiv(F.sum(_error(a, p)), F.sum(F.col(a).cast("double"))), MPE_DECIMALS)


def total_bias(a: str, p: str) -> Column:
    return sdiv(F.sum(F.col(p).cast("double")), F.sum(F.col(a).cast("double"))) - 1


def row_bias(a: str, p: str) -> Column:
    return sdiv(F.col(p) - F.col(a), F.col(p) + F.col(a))


def asymmetric_loss(a: str, p: str) -> Column:
    """Squared error, twice as dear when the forecast is too low."""
    e = _error(a, p)
    return F.avg(F.when(e > 0, 2 * e * e).otherwise(e * e))


def report_metrics(df: DataFrame, keys: Sequence[str], date: str, a: str = "actual", p: str = "forecast") -> DataFrame:
    """All report metrics of each group, one row per group; the ``_6W`` pair looks at the last date only."""
    e = _error(a, p)
    last_pct = F.max_by(F.abs(sdiv(e, a)), F.col(date))
    last_abs = F.max_by(F.abs(e), F.col(date))
    found = {
        "MAPE": mape(a, p), "RMSE": rmse(a, p), "MAE": mae(a, p), "R2": r2(a, p), "WAPE": wape(a, p),
        "MAPE_6W": last_pct, "RMSE_6W": last_abs,
    }
    return df.groupBy(*keys).agg(*[rounded(v, DECIMALS[n]).alias(n) for n, v in found.items()])


def with_report_metrics(df: DataFrame, keys: Sequence[str], date: str, a: str = "actual", p: str = "forecast") -> DataFrame:
    """Report metrics written on every row of their group, plus the row's own bias."""
    rows = df.withColumn("Bias", rounded(row_bias(a, p), DECIMALS["Bias"]))
    return attach(rows, report_metrics(df, keys, date, a, p), keys)


def short_metrics(df: DataFrame, keys: Sequence[str], a: str = "actual", p: str = "forecast") -> DataFrame:
    """The three-metric form: MAPE and RMSE per group, bias per row."""
    per = df.groupBy(*keys).agg(
        rounded(mape(a, p), DECIMALS["MAPE"]).alias("MAPE"), rounded(rmse(a, p), DECIMALS["RMSE"]).alias("RMSE")
    )
    return attach(df.withColumn("Bias", rounded(row_bias(a, p), DECIMALS["Bias"])), per, keys)


def point_performance(df: DataFrame, a: str, p: str, date: str, run_date: str, model: str, series: str) -> DataFrame:
    """One performance row per forecast point."""
    e = _error(a, p)
    return df.select(
        F.col(date).alias("eval_date"),
        F.col(run_date).alias("run_date"),
        F.col(model).alias("model_name"),
        F.col(series).alias("series"),
        rounded(F.abs(e), DAILY_DECIMALS).alias("mae"),
        rounded(F.sqrt(e * e), DAILY_DECIMALS).alias("rmse"),
        rounded(F.abs(sdiv(e, a)), DAILY_DECIMALS).alias("mape"),
        rounded(row_bias(a, p), DAILY_DECIMALS).alias("bias"),
        rounded(F.col(p), DAILY_DECIMALS).alias("forecast"),
        rounded(F.col(a), DAILY_DECIMALS).alias("actual"),
    )


def metric_pack(df: DataFrame, keys: Sequence[str], a: str = "actual", p: str = "forecast") -> DataFrame:
    """The model-test pack: percent, squared and absolute errors, fit, bias, signed and weighted percent error."""
    found = {
        "mape": mape(a, p), "rmse": rmse(a, p), "mae": mae(a, p), "r2": r2(a, p), "forecast_bias": total_bias(a, p),
        "mpe": mean_percent_error(a, p), "wape": absolute_wape(a, p),
    }
    return df.groupBy(*keys).agg(*[v.alias(n) for n, v in found.items()])


def baseline_metrics(df: DataFrame, keys: Sequence[str], a: str = "actual", p: str = "forecast", *, root: bool = False) -> DataFrame:
    """Baseline pack with bias in percent. ``root=True`` gives the square root of MAPE instead of MAPE."""
    m = mape(a, p)
    return df.groupBy(*keys).agg(
        (F.sqrt(m) if root else m).alias("mape"), rmse(a, p).alias("rmse"), mae(a, p).alias("mae"),
        (100 * total_bias(a, p)).alias("bias_pct"),
    )


def mean_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def summary_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str], **kw) -> DataFrame:
    """Mean, exact median and deviation of each column per group. The input is computed once, the medians of all columns in one pass."""
    rows = session.cut(df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]))
    out = rows.groupBy(*keys).agg(
        *[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
    )
    long = rows.unpivot(list(keys), list(cols), "__name", "__value")
    medians = exact_quantiles(long, [*keys, "__name"], "__value", {"__median": 0.5}, **kw)
    wide = medians.groupBy(*keys).agg(*[F.max(F.when(F.col("__name") == c, F.col("__median"))).alias(f"{c}_median") for c in cols])
    return attach(out, wide, keys)


def window_mape_summary(df: DataFrame, keys: Sequence[str], window: str, a: str = "actual", p: str = "forecast", **kw) -> DataFrame:
    """MAPE of each window from its rows, then mean, median and deviation over windows."""
    per_window = df.groupBy(*keys, window).agg(mape(a, p).alias("mape"))
    return summary_by(per_window, keys, ["mape"], **kw)


def point_mape(a: str = "actual", p: str = "forecast") -> Column:
    return F.abs(sdiv(_error(a, p), a))


def overfit_gaps(df: DataFrame) -> DataFrame:
    """Test over training error; one means no gap."""
    return df.withColumns(
        {
            f"{m}_gap": rounded(sdiv(m, f"TRAINING_{m}"), GAP_DECIMALS)
            for m in ("MAPE", "RMSE")
        }
    )


def best_average(df: DataFrame, keys: Sequence[str], model: str, metric: str) -> DataFrame:
    """Best metric per key, then its mean over keys."""
    best = df.groupBy(*keys, model).agg(F.avg(metric).alias("__m")).groupBy(*keys).agg(F.min("__m").alias("__best"))
    return best.agg(F.avg("__best").alias(f"best_{metric}"))


def ensemble_ratio(df: DataFrame, keys: Sequence[str], model: str, metric: str, ensemble: str) -> DataFrame:
    """Ensemble metric over the best single model's, per key."""
    per = df.groupBy(*keys, model).agg(F.avg(metric).alias("__m"))
    name = F.col(model)
    return per.groupBy(*keys).agg(
        sdiv(F.max(F.when(name == ensemble, F.col("__m"))), F.min(F.when(name != ensemble, F.col("__m")))).alias("ratio")
    )


def distinct_count(df: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """Exact distinct values per group; duplicates fall away before the counting shuffle."""
    return df.select(*keys, c).distinct().groupBy(*keys).agg(F.count(c).alias(f"{c}_count"))


def histogram(df: DataFrame, keys: Sequence[str], c: str, lo: float, hi: float, bins: int) -> DataFrame:
    b = F.width_bucket(F.col(c), F.lit(lo), F.lit(hi), F.lit(bins))
    return df.groupBy(*keys, b.alias("bin")).agg(F.count("*").alias("n"))


def five_numbers(df: DataFrame, keys: Sequence[str], c: str, **kw) -> DataFrame:
    qs = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    return exact_quantiles(df, keys, c, qs, **kw)


def tuning_summary(cv: DataFrame, params: Sequence[str], score: str) -> DataFrame:
    """Mean score for every value of every parameter."""
    long = cv.select(score, *[F.col(p).cast("string").alias(p) for p in params]).unpivot([score], list(params), "param", "value")
    return long.groupBy("param", "value").agg(F.avg(score).alias("mean_score"))


def run_metrics(df: DataFrame, model: str = "model_type", cols: Sequence[str] = RUN_METRICS) -> DataFrame:
    """Mean metrics per model and, with a null model, over all models."""
    return df.rollup(model).agg(*[rounded(F.avg(c), RUN_DECIMALS).alias(c) for c in cols])

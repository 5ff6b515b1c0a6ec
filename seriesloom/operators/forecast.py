"""Recursive multi-step forecasts over all series at once, and the simple forecasters.

The state of a series is one row holding an array of its last values; a step reads features off
the array, predicts, and appends. No step shuffles and no series visits the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.functions import state as st
from seriesloom.operators import calendar as cal
from seriesloom.operators.cleaning import last_rows
from seriesloom.operators.features import attach
from seriesloom.operators.panel import Panel, matched
from seriesloom.plans.config import FeatureSet, output_names

HISTORY = "__history"
# Steps between lineage cuts when the predictor is a fitted model.
STEPS_PER_CUT = 2

ColumnPredict = Callable[[Mapping[str, Column]], Column]
FramePredict = Callable[[DataFrame], DataFrame]


def series_state(panel: Panel, c: str, n: int, keep_last: Sequence[str] = ()) -> DataFrame:
    """One row per series: its last ``n`` values, oldest first, and ``keep_last`` of the newest row.

    Only the last n rows of each series are shuffled: the rank filter runs before the exchange too.
    """
    rows = last_rows(panel.df, panel.series, panel.order, n, "__r")
    packed = rows.groupBy(*panel.series).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("__r")).alias("r"), F.col(c).cast("double").alias("v")))).alias("__p"),
        *[F.max_by(k, F.struct(*panel.order)).alias(k) for k in keep_last],
    )
    return packed.withColumn(HISTORY, F.transform("__p", lambda x: x["v"])).drop("__p")


def linear_predictor(coefficients: Mapping[str, float], intercept: float = 0.0) -> ColumnPredict:
    """A fixed linear model as an expression over the features."""

    def predict(features: Mapping[str, Column]) -> Column:
        value = F.lit(float(intercept))
        for name, b in coefficients.items():
            value = value + F.lit(float(b)) * features[name]
        return value

    return predict


def recursive_forecast(
    state: DataFrame,
    fs: FeatureSet,
    predict: ColumnPredict,
    horizon: int,
    *,
    exogenous: Mapping[str, str] | None = None,
    digits: int | None = None,
    keep_features: bool = False,
) -> DataFrame:
    """Predict ``horizon`` steps, feeding each prediction back into the target features.

    The whole recursion is one fold over the steps inside each state row: no job per step.
    ``exogenous`` maps feature columns to array columns of ``state`` with one value per step.
    Returns ``state``'s keys, ``step``, ``prediction`` and, on request, the features used.
    """
    exogenous = dict(exogenous or {})
    names = [*st_names(fs), *exogenous]
    keys = [c for c in state.columns if c != HISTORY and c not in exogenous.values()]
    memory = fs.memory()
    start = F.struct(
        F.col(HISTORY).cast("array<double>").alias("past"), F.array().cast(_out_type(names)).alias("out")
    )

    def advance(acc: Column, step: Column) -> Column:
        found = st.target_features(acc["past"], fs)
        found |= {n: F.try_element_at(F.col(a), step) for n, a in exogenous.items()}
        value = predict(found).cast("double")
        if digits is not None:
            value = F.round(value, digits)
        row = F.struct(value.alias("prediction"), *[found[n].cast("double").alias(n) for n in names])
        # Bind the row once; its prediction goes to both the past and the output.
        return F.element_at(
            F.transform(
                F.array(row),
                lambda r: F.struct(
                    st.tail(F.array_append(acc["past"], r["prediction"]), memory).alias("past"),
                    F.array_append(acc["out"], r).alias("out"),
                ),
            ),
            1,
        )

    folded = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, advance)
    return _unpack(state.withColumn("__out", folded["out"]), keys, names if keep_features else [])


def recursive_model_forecast(
    state: DataFrame,
    fs: FeatureSet,
    predict: FramePredict,
    horizon: int,
    *,
    exogenous: Mapping[str, str] | None = None,
    digits: int | None = None,
    keep_features: bool = False,
) -> DataFrame:
    """As :func:`recursive_forecast` for a fitted model: each step transforms the state of all series.

    Steps are narrow. Every few steps the state, one row per series, is written out so the plan stays short.
    """
    exogenous = dict(exogenous or {})
    names = [*st_names(fs), *exogenous]
    keys = [c for c in state.columns if c != HISTORY and c not in exogenous.values()]
    df = state.withColumn("__out", F.array().cast(_out_type(names)))
    for step in range(1, horizon + 1):
        found = st.target_features(F.col(HISTORY), fs)
        found |= {n: F.try_element_at(F.col(a), F.lit(step)) for n, a in exogenous.items()}
        df = predict(df.withColumns(found))
        value = F.col("prediction") if digits is None else F.round("prediction", digits)
        row = F.struct(value.cast("double").alias("prediction"), *[F.col(n).cast("double").alias(n) for n in names])
        df = df.withColumn("__row", row).select(
            *keys,
            *exogenous.values(),
            st.tail(F.array_append(HISTORY, F.col("__row.prediction")), fs.memory()).alias(HISTORY),
            F.array_append("__out", F.col("__row")).alias("__out"),
        )
        if step % STEPS_PER_CUT == 0 and step < horizon:
            df = session.cut(df)
    return _unpack(df, keys, names if keep_features else [])


def _unpack(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    steps = df.select(*keys, F.posexplode("__out").alias("__i", "__row"))
    return steps.select(*keys, (F.col("__i") + 1).alias("step"), *[F.col("__row")[n].alias(n) for n in ("prediction", *names)])


def _out_type(names: Sequence[str]) -> str:
    return "array<struct<" + ",".join(f"`{n}`:double" for n in ("prediction", *names)) + ">>"


def st_names(fs: FeatureSet) -> list[str]:
    """Names of the target features, in order."""
    target_only = FeatureSet(
        target=fs.target, lags=fs.lags, averages=fs.averages, sums=fs.sums, lag_ratios=fs.lag_ratios,
        sum_ratios=fs.sum_ratios, average_ratios=fs.average_ratios, bands=fs.bands, strength=fs.strength,
        trailing_max=fs.trailing_max,
    )
    return output_names(target_only)


# -- simple forecasters ------------------------------------------------------------------------


def seasonal_naive(panel: Panel, c: str, period: int, horizon: int) -> DataFrame:
    """Repeat the last season."""
    s = series_state(panel, c, period).filter(F.size(HISTORY) >= period)
    steps = s.select(*panel.series, HISTORY, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return steps.select(*panel.series, "step", F.element_at(HISTORY, F.pmod(F.col("step") - 1, F.lit(period)) + 1).alias("prediction"))


def seasonal_fitted(panel: Panel, c: str, period: int) -> Panel:
    return panel.frames(lambda w: {"fitted": F.lag(c, period).over(w)}, back=period)


def first_future_features(panel: Panel, fs: FeatureSet) -> DataFrame:
    """Target features of the first row after each series' end."""
    s = series_state(panel, fs.target, fs.memory())
    return s.withColumns(st.target_features(F.col(HISTORY), fs)).drop(HISTORY)


def future_frame(panel: Panel, fs: FeatureSet, date: str, horizon: int, weekend_days: int = 2) -> DataFrame:
    """Coming working days with date parts; target features are known only for the first."""
    days = cal.drop_weekends(cal.future_days(panel.df, panel.series, date, horizon), date)
    days = days.withColumns({k: v for k, v in cal.date_parts(date).items() if k != "weekday_name"})
    first = days.groupBy(*panel.series).agg(F.min(date).alias(date))
    seeded = matched(first, first_future_features(panel, fs), panel.series, how="inner")
    return matched(days, seeded, [*panel.series, date])


def future_feature_rows(history: DataFrame, future: DataFrame, series: Sequence[str], date: str, fs: FeatureSet, build) -> DataFrame:
    """Features over history and filled future together, future rows kept."""
    last = history.groupBy(*series).agg(F.max(date).alias("__last"))
    both = history.unionByName(future, allowMissingColumns=True)
    made = build(Panel.calendar(both, series, date), fs).df
    return attach(made, last, series).filter(F.col(date) > F.col("__last")).drop("__last")


def known_lag_columns(panel: Panel, lags: Mapping[str, Sequence[int]], horizon: int, *, differenced: bool = False) -> DataFrame:
    """Lag columns of the coming steps as far as history knows them; later steps are null."""
    cols = list(lags)
    deepest = max(n for ns in lags.values() for n in ns)
    p = panel
    if differenced:
        p = panel.frames(lambda w: {f"__d_{c}": F.col(c) - F.lag(c, 1).over(w) for c in cols}, back=1)
    rows = last_rows(p.df, p.series, p.order, deepest, "__r")
    packed = rows.groupBy(*p.series).agg(
        F.sort_array(
            F.collect_list(F.struct((-F.col("__r")).alias("r"), *[F.col(f"__d_{c}" if differenced else c).alias(c) for c in cols]))
        ).alias("__h")
    )
    steps = packed.select(*p.series, "__h", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    out = {
        f"{c}_lag_{n}": F.when(F.col("step") <= n, F.try_element_at("__h", F.col("step") - 1 - n)[c])
        for c, ns in lags.items()
        for n in ns
    }
    return steps.select(*p.series, "step", *[e.alias(k) for k, e in out.items()])


def voting_mean(forecasts: DataFrame, keys: Sequence[str], predicted: str = "prediction") -> DataFrame:
    return forecasts.groupBy(*keys).agg(F.avg(predicted).alias("prediction"))


def split_forecast(df: DataFrame, trend: str, yearly: str, yhat: str, lower: str, upper: str) -> DataFrame:
    """Baseline and unexplained parts of a forecast with bounds."""
    return df.withColumns(
        {
            "baseline": F.col(trend) + F.col(yearly),
            "unexplained_lower": F.col(lower) - F.col(yhat),
            "unexplained_upper": F.col(upper) - F.col(yhat),
        }
    )

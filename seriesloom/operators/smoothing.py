"""Damped additive trend-and-season smoothing, fitted over a small parameter grid.

For fixed parameters the state moves linearly, so a long series is scanned chunk by chunk: each
chunk reports where the zero state ends and how far it carries an entering state, a fold over
chunk summaries gives every chunk's true entering state, and a second scan scores the grid.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom import session
from seriesloom.operators.cleaning import last_rows
from seriesloom.operators.panel import CHUNK, Panel, matched

# --- fixed values: grid of level, trend and season weights, and the trend damping ---
LEVEL = (0.1, 0.3, 0.6)
TREND = (0.01, 0.1)
SEASON = (0.05, 0.2)
DAMPING = 0.95
# -------------------------------------------------------------------------------------

GRID = np.array(list(product(LEVEL, TREND, SEASON)))


def _step(level, trend, season, phase, y, grid):
    """Advance all grid rows by one observation in place; returns the one-step errors."""
    damped = DAMPING * trend
    error = y - (level + damped + season[:, phase])
    level[:] = level + damped + grid[:, 0] * error
    trend[:] = damped + grid[:, 1] * error
    season[:, phase] += grid[:, 2] * error
    return error


def _scan(y: np.ndarray, first: int, period: int, state: np.ndarray, score_from: int) -> tuple[np.ndarray, np.ndarray]:
    """Run all grid rows over ``y``; positions start at ``first``. Returns end state and squared error."""
    level, trend, season = state[:, 0].copy(), state[:, 1].copy(), state[:, 2:].copy()
    total = np.zeros(len(GRID))
    for i, v in enumerate(y.tolist()):
        e = _step(level, trend, season, (first + i) % period, v, GRID)
        if first + i >= score_from:
            total += e * e
    return np.column_stack([level, trend, season]), total


def _carry_matrices(length: int, first: int, period: int) -> np.ndarray:
    """Per grid row, the linear map of an entering state over ``length`` observations of zero input."""
    size = period + 2
    out = np.empty((len(GRID), size, size))

    def one_step(a: float, b: float, c: float, phase: int) -> np.ndarray:
        seen = np.zeros(size)
        seen[0], seen[1], seen[2 + phase] = 1.0, DAMPING, 1.0
        m = np.eye(size)
        m[0, 1], m[1, 1] = DAMPING, DAMPING
        gain = np.zeros(size)
        gain[0], gain[1], gain[2 + phase] = a, b, c
        return m - np.outer(gain, seen)

    for g, (a, b, c) in enumerate(GRID):
        steps = [one_step(a, b, c, (first + p) % period) for p in range(period)]
        cycle = np.eye(size)
        for m in steps:
            cycle = m @ cycle
        whole = np.linalg.matrix_power(cycle, length // period)
        for m in steps[: length % period]:
            whole = m @ whole
        out[g] = whole
    return out


def _opening(y: np.ndarray, period: int) -> np.ndarray:
    """Opening state from the first two seasons."""
    first, second = y[:period], y[period : 2 * period]
    level = first.mean()
    trend = (second.mean() - level) / period if len(second) == period else 0.0
    return np.concatenate([[level, trend], first - level])


def smoothing_forecast(panel: Panel, c: str, period: int, horizon: int) -> DataFrame:
    """Forecast every series with a value: the best grid row by squared error, or the last value where there are fewer than two seasons of values."""
    whole = panel
    panel = panel.with_df(panel.df.select(*panel.series, *panel.order, F.col(c).cast("double").alias("__y")).filter("__y IS NOT NULL"))
    wide = period + 2
    best = (_score_split if panel.is_split else _score_whole)(panel, period)
    pick = (F.array_position("__sse", F.array_min("__sse")) - 1).cast("int")
    chosen = best.withColumn("__g", pick).withColumn("__x", F.slice("__state", F.col("__g") * wide + 1, F.lit(wide)))
    steps = chosen.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    trend_sum = DAMPING * (1 - F.pow(F.lit(DAMPING), "step")) / (1 - DAMPING)
    phase = F.pmod(F.col("__n") + F.col("step") - 1, F.lit(period)).cast("int")
    value = F.element_at("__x", 1) + trend_sum * F.element_at("__x", 2) + F.element_at("__x", phase + 3)
    return with_fallback(steps.select(*panel.series, "step", value.alias("prediction")), naive_tail(whole, c, horizon), panel.series)


def _score_whole(panel: Panel, period: int) -> DataFrame:
    """Series that fit a task: one pass per series. Columns __n, __sse, __state."""
    s, order = panel.series, panel.order
    numbers = T.ArrayType(T.DoubleType())
    keys = [f for f in panel.df.schema.fields if f.name in s]
    schema = T.StructType([*keys, T.StructField("__n", T.LongType()), T.StructField("__sse", numbers), T.StructField("__state", numbers)])

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(order)["__y"].to_numpy()
        if len(y) < 2 * period:
            return pd.DataFrame(columns=schema.fieldNames())
        start = np.tile(_opening(y, period), (len(GRID), 1))
        end, sse = _scan(y, 0, period, start, 2 * period)
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in s}, "__n": len(y), "__sse": sse.tolist(), "__state": end.ravel().tolist()}])

    return session.spread(panel.df, s).groupBy(*s).applyInPandas(score, schema)


def _score_split(panel: Panel, period: int) -> DataFrame:
    """Series too long for a task, chunk by chunk. Columns __n, __sse, __state."""
    p = panel.positions("__i")
    s = p.series
    key_fields = [f for f in p.df.schema.fields if f.name in s]
    head = p.df.filter(F.col("__i") <= 2 * period).groupBy(*s).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("__i", "__y"))), lambda x: x["__y"]).alias("__head")
    )
    head = head.filter(F.size("__head") >= 2 * period)
    rows = session.spread(matched(p.df.select(*s, CHUNK, "__i", "__y"), head.select(*s), s, how="left_semi"), [*s, CHUNK])
    wide = period + 2
    numbers = T.ArrayType(T.DoubleType())

    def keyed(pdf: pd.DataFrame, **cols) -> pd.DataFrame:
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in s}, **cols}])

    # Pass 1: where the zero state ends in each chunk.
    ends_schema = T.StructType(
        [*key_fields, T.StructField(CHUNK, T.LongType()), T.StructField("__from", T.LongType()), T.StructField("__len", T.LongType()), T.StructField("__end", numbers)]
    )

    def chunk_end(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__i")
        first = int(pdf["__i"].iloc[0]) - 1
        end, _ = _scan(pdf["__y"].to_numpy(), first, period, np.zeros((len(GRID), wide)), 0)
        return keyed(pdf, **{CHUNK: pdf[CHUNK].iloc[0], "__from": first, "__len": len(pdf), "__end": end.ravel().tolist()})

    # Fold: a few numbers per chunk, at most MAX_CHUNKS chunks per series.
    entry_schema = T.StructType([*key_fields, T.StructField(CHUNK, T.LongType()), T.StructField("__enter", numbers)])

    def enter(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(CHUNK)
        state = np.tile(_opening(np.asarray(pdf["__head"].iloc[0]), period), (len(GRID), 1))
        out = []
        for chunk, first, length, end in zip(pdf[CHUNK], pdf["__from"], pdf["__len"], pdf["__end"]):
            out.append({**dict(zip(s, key)), CHUNK: chunk, "__enter": state.ravel().tolist()})
            moved = np.einsum("gij,gj->gi", _carry_matrices(int(length), int(first), period), state)
            state = moved + np.asarray(end).reshape(len(GRID), wide)
        return pd.DataFrame(out)

    ends = rows.groupBy(*s, CHUNK).applyInPandas(chunk_end, ends_schema)
    entries = matched(ends, head, s, how="inner").groupBy(*s).applyInPandas(enter, entry_schema)

    # Pass 2: squared error of every grid row, and the end state of each chunk.
    score_schema = T.StructType(
        [*key_fields, T.StructField("__i", T.LongType()), T.StructField("__sse", numbers), T.StructField("__state", numbers)]
    )

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__i")
        first = int(pdf["__i"].iloc[0]) - 1
        start = np.asarray(pdf["__enter"].iloc[0]).reshape(len(GRID), wide)
        end, sse = _scan(pdf["__y"].to_numpy(), first, period, start, 2 * period)
        return keyed(pdf, **{"__i": int(pdf["__i"].iloc[-1]), "__sse": sse.tolist(), "__state": end.ravel().tolist()})

    # The entering state rides on the first row of its chunk only.
    opening_row = matched(rows.groupBy(*s, CHUNK).agg(F.min("__i").alias("__i")), entries, [*s, CHUNK], how="inner")
    with_entry = matched(rows, opening_row, [*s, CHUNK, "__i"])

    scored = with_entry.groupBy(*s, CHUNK).applyInPandas(score, score_schema)
    return scored.groupBy(*s).agg(
        F.array(*[F.sum(F.col("__sse")[g]) for g in range(len(GRID))]).alias("__sse"),
        F.max_by("__state", "__i").alias("__state"),
        F.max("__i").alias("__n"),
    )


def naive_tail(panel: Panel, c: str, horizon: int) -> DataFrame:
    """Last value repeated, for series too short to smooth."""
    last = last_rows(panel.df.filter(F.col(c).isNotNull()), panel.series, panel.order, 1, "__r")
    return last.select(*panel.series, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), F.col(c).cast("double").alias("prediction"))


def with_fallback(forecast: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Forecast rows, and the fallback's where there are none."""
    return forecast.unionByName(matched(fallback, forecast, list(keys), how="left_anti"))

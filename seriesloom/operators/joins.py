"""Joins of sources on a calendar key, and of results on series and date."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.operators.features import attach
from seriesloom.operators.panel import matched
from seriesloom.sources import sinks


def star_join(base: DataFrame, tables: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Left-join every table to ``base`` on the same key.

    All sides hash on one key, so the chain needs one exchange per table and none between the
    joins; adaptive execution broadcasts the sides it measures as small.
    """
    return reduce(lambda left, right: left.join(right, list(on), "left"), tables, base)


def star_joins(base: DataFrame, tables: Mapping[str, DataFrame], sets: Mapping[str, Sequence[str]], on: Sequence[str]) -> dict[str, DataFrame]:
    """Several named table sets over one base."""
    return {name: star_join(base, [tables[t] for t in members], on) for name, members in sets.items()}


def bucketed(tables: Mapping[str, DataFrame], on: Sequence[str], rows_per_task: int | None = None, rows_bound: int | None = None) -> dict[str, DataFrame]:
    """The tables written in buckets of the same key and number, so that any of them join on it without an exchange.

    Worth it where several sets draw on the same tables: each is shuffled once, when it is written, however many stars it is in. The
    number of buckets is that of the largest table, at ``rows_per_task`` rows each (default: the session's), so a star of small tables is
    one task. Its rows are counted, on tables cut before, unless the caller proves a bound (one row per date, say). Nothing stays in the catalog; the files lie in the shared folder. A key that is null matches nothing, as in any star join.
    """
    spark = next(iter(tables.values())).sparkSession
    frames, rows = dict(tables), rows_bound
    if rows is None:
        frames = {name: session.cut(df) for name, df in tables.items()}
        counts = reduce(DataFrame.union, [df.agg(F.count("*").alias("n")) for df in frames.values()])
        rows = counts.agg(F.max("n")).first()[0]
    n = max(1, -(-rows // (rows_per_task or session.rows_per_task(spark))))
    out = {}
    for name, df in frames.items():
        entry = f"seriesloom_{uuid.uuid4().hex}"
        df.repartition(n, *on).write.bucketBy(n, *on).sortBy(*on).option("path", sinks.scratch_folder(spark)).saveAsTable(entry)
        out[name] = spark.table(entry)
        spark.sql(f"DROP TABLE {entry}")  # only the entry: the table lies at a path of its own, and the frame knows its buckets
    return out


def features_with_target(x: DataFrame, y: DataFrame, keys: Sequence[str]) -> DataFrame:
    return matched(x, y, keys)


def with_group_value(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Write an aggregate of each group on its rows."""
    return attach(df, df.groupBy(*keys).agg(value.alias(name)), keys)


def with_quarterly(monthly: DataFrame, quarterly: DataFrame, date: str, quarter: str, c: str) -> DataFrame:
    """Give each month the value of its quarter where the month has none."""
    q = quarterly.select(F.trunc(F.col(quarter), "quarter").alias("__q"), F.col(c).alias("__v"))
    rows = monthly.withColumn("__q", F.trunc(F.col(date), "quarter")).join(q, "__q", "left")
    value = F.coalesce(F.col(c), F.col("__v")) if c in monthly.columns else F.col("__v")
    return rows.withColumn(c, value).drop("__q", "__v")


def latest_forecast_with_actual(
    forecasts: DataFrame, actuals: DataFrame, series: Sequence[str], date: str, run_date: str
) -> DataFrame:
    """The newest run's forecast for each series' newest actual date, per model."""
    newest_actual = actuals.groupBy(*series).agg(F.max(date).alias(date))
    current = matched(actuals, newest_actual, [*series, date], how="inner")
    newest_run = forecasts.groupBy(*series).agg(F.max(run_date).alias(run_date))
    return matched(matched(forecasts, newest_run, [*series, run_date], how="inner"), current, [*series, date], how="inner")


def without_forecast(forecasts: DataFrame, actuals: DataFrame, series: Sequence[str], date: str) -> DataFrame:
    """Newest actuals no forecast covers."""
    newest = actuals.groupBy(*series).agg(F.max(date).alias(date))
    return matched(newest, forecasts, [*series, date], how="left_anti")


def with_interval(forecast: DataFrame, interval: DataFrame, keys: Sequence[str]) -> DataFrame:
    return matched(forecast, interval, keys)

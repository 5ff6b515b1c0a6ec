"""Backtest folds. A fold is one row of bounds per series; rows are attached only when needed.

Bounds are 0-based row positions: train is ``[0, train_end)``, test is ``[test_start, test_end)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators.calendar import working_horizon_days
from seriesloom.operators.features import attach
from seriesloom.operators.panel import Panel, matched

ROW = "row_no"


def numbered(panel: Panel) -> Panel:
    """Add the 0-based row number of each row in its series."""
    p = panel.positions(ROW)
    return p.with_df(p.df.withColumn(ROW, F.col(ROW) - 1))


def _sizes(rows: DataFrame, series: list[str], date: str) -> DataFrame:
    return rows.groupBy(*series).agg(F.count(F.lit(1)).alias("n_rows"), F.max(date).alias("last_date"))


def expanding_folds(panel: Panel, date: str, first_test: str | Column, size: int = 6, step: int = 6) -> DataFrame:
    """Expanding-window folds from the row dated ``first_test``.

    The first fold always exists. A later fold whose test would reach the last date is the
    final one; if it would pass it, its test is cut to the rows there are. A series without
    the date has no folds; :func:`missing_start` lists those.
    """
    rows = numbered(panel).df
    s = panel.series
    start = F.to_date(F.lit(first_test)) if isinstance(first_test, str) else first_test
    sizes = _sizes(rows, s, date)
    first = matched(rows.filter(F.col(date) == start).select(*s, F.col(ROW).alias("first_row")), sizes, s, how="inner")
    # Every step-th row from the first test row starts a fold; the rows themselves are the candidates.
    ahead = F.col(ROW) - F.col("first_row")
    dated = attach(rows.select(*s, date, ROW), first, s, "inner").filter((ahead >= 0) & (F.pmod(ahead, F.lit(step)) == 0))
    dated = dated.select(
        *s, "n_rows", "last_date", (F.floor(ahead / step) + 1).cast("int").alias("fold"), F.col(ROW).alias("test_start"), F.col(date).alias("start_date")
    )
    reach = F.date_add("start_date", 7 * size)
    dated = dated.withColumn("final", (F.col("fold") > 1) & (reach >= F.col("last_date")))
    stop = dated.filter("final").groupBy(*s).agg(F.min("fold").alias("stop_fold"))
    kept = matched(dated, stop, s).filter(F.col("stop_fold").isNull() | (F.col("fold") <= F.col("stop_fold")))
    end = F.when((F.col("fold") > 1) & (reach > F.col("last_date")), F.col("n_rows")).otherwise(
        F.least(F.col("test_start") + size, F.col("n_rows"))
    )
    return kept.select(*s, "fold", F.col("test_start").alias("train_end"), "test_start", end.alias("test_end"))


def missing_start(panel: Panel, date: str, first_test: str) -> DataFrame:
    """Series that have no row on the first test date."""
    hit = panel.df.filter(F.col(date) == F.to_date(F.lit(first_test))).select(*panel.series)
    return matched(panel.df.select(*panel.series).distinct(), hit, panel.series, how="left_anti")


def calendar_folds(panel: Panel, date: str, steps: int, size: int, horizon: int, weekend_days: int = 2) -> DataFrame:
    """``steps + 1`` folds cut by days before the last date; test is the end of each cut."""
    rows = numbered(panel).df
    s = panel.series
    last = rows.groupBy(*s).agg(F.max(date).alias("last_date"))
    ends = last.select(*s, "last_date", F.posexplode(F.sequence(F.lit(steps), F.lit(0), F.lit(-1))).alias("fold", "left"))
    ends = ends.select(*s, "fold", F.date_sub("last_date", F.col("left") * size).alias("cut_date"))
    # Each row counts into the earliest fold holding it; running sums over the few folds finish the count.
    dated = attach(rows.select(*s, date), last, s)
    away = F.datediff("last_date", date)
    first_fold = F.greatest(F.lit(0), F.lit(steps) - F.floor(away / size).cast("int"))
    counts = dated.groupBy(*s, first_fold.alias("fold")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*s).orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)
    test = working_horizon_days(horizon, weekend_days)
    seen = matched(ends, counts, [*s, "fold"]).withColumn("test_end", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    start = F.greatest(F.lit(0), F.col("test_end") - test)
    return seen.select(*s, "fold", start.alias("train_end"), start.alias("test_start"), "test_end")


def tail_split(panel: Panel, date: str, horizon: int) -> DataFrame:
    """One fold: the last ``horizon`` rows are the test."""
    start = F.greatest(F.lit(0), F.col("n_rows") - horizon)
    return _sizes(panel.df, panel.series, date).select(
        *panel.series, F.lit(0).alias("fold"), start.alias("train_end"), start.alias("test_start"), F.col("n_rows").alias("test_end")
    )


def growing_folds(panel: Panel, date: str, min_train: int, step: int, horizon: int) -> DataFrame:
    """Train on the first ``min_train + k * step`` rows, test on the next ``horizon``."""
    s = panel.series
    sizes = _sizes(panel.df, s, date).select(*s, "n_rows")
    ahead = F.col(ROW) - min_train
    starts = numbered(panel).df.select(*s, ROW).filter((ahead >= 0) & (F.pmod(ahead, F.lit(step)) == 0))
    fold = F.floor(ahead / step).cast("int")
    folds = attach(starts, sizes, s).filter(fold < F.floor((F.col("n_rows") - min_train - step) / step))
    start = F.col(ROW)
    return folds.select(
        *s, fold.alias("fold"), start.alias("train_end"), start.alias("test_start"), F.least(start + horizon, F.col("n_rows")).alias("test_end")
    )


def end_anchored_folds(panel: Panel, date: str, n_splits: int, size: int) -> DataFrame:
    """``n_splits`` consecutive tests of ``size`` rows ending at the last row; each trains on all rows before."""
    s = panel.series
    sizes = _sizes(panel.df, s, date).filter(F.col("n_rows") > n_splits * size)
    folds = sizes.select(*s, "n_rows", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold"))
    start = F.col("n_rows") - (n_splits - F.col("fold")) * size
    return folds.select(*s, "fold", start.alias("train_end"), start.alias("test_start"), (start + size).alias("test_end"))


def test_rows(panel: Panel, folds: DataFrame) -> DataFrame:
    """Test rows of every fold, by an equi-join on the row number."""
    return numbered_test_rows(numbered(panel).df, folds, panel.series)


def numbered_test_rows(rows: DataFrame, folds: DataFrame, series: Sequence[str]) -> DataFrame:
    """As :func:`test_rows`, for rows that have their numbers."""
    wanted = folds.filter("test_end > test_start").select(
        *series, "fold", F.explode(F.sequence("test_start", F.col("test_end") - 1)).alias(ROW)
    )
    return matched(rows, wanted, [*series, ROW], how="inner")


def train_rows(panel: Panel, folds: DataFrame, fold: int) -> DataFrame:
    """Training rows of one fold."""
    one = folds.filter(F.col("fold") == fold).select(*panel.series, "fold", "train_end")
    rows = numbered(panel).df
    return matched(rows, one, panel.series, how="inner").filter(F.col(ROW) < F.col("train_end")).drop("train_end")


def fold_rows(panel: Panel, folds: DataFrame) -> DataFrame:
    """Every row of every fold with its part; the output itself grows with rows times folds."""
    rows = matched(numbered(panel).df, folds, panel.series, how="inner").filter(F.col(ROW) < F.col("test_end"))
    rows = rows.filter((F.col(ROW) < F.col("train_end")) | (F.col(ROW) >= F.col("test_start")))
    part = F.when(F.col(ROW) < F.col("train_end"), "train").otherwise("test")
    return rows.withColumn("part", part).drop("train_end", "test_start", "test_end")


def row_from_end(panel: Panel, nth: int) -> DataFrame:
    """The nth row from the end of each series."""
    from seriesloom.operators.cleaning import last_rows

    return last_rows(panel.df, panel.series, panel.order, nth, "__from_end").filter(F.col("__from_end") == nth).drop("__from_end")

"""Calendar buckets, spines, alignment and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.columns import col, non_null_first
from seriesloom.operators.panel import Panel, matched

# --- fixed values ---
SERIAL_DAY_ZERO = "1899-12-30"
MID_MONTH_DAY = 15
WEEKEND_DAYS = (5, 6)
# Largest gap in days for each label; a longer step is yearly.
STEP_LABELS = ((1, "D"), (7, "W"), (31, "M"), (92, "Q"))
# --------------------


def week_ending(date: str | Column, day: str) -> Column:
    """The named weekday on or after ``date``."""
    return F.next_day(F.date_sub(col(date), 1), day)


def friday_of_week(date: str | Column) -> Column:
    """Friday of the Monday-first week of ``date``; Saturday and Sunday go back."""
    d = col(date).cast("date")
    return F.date_add(d, 4 - F.weekday(d))


def nearest_month_start(date: str | Column) -> Column:
    d = col(date).cast("date")
    this = F.trunc(d, "MM").cast("date")
    return F.when(F.dayofmonth(d) <= MID_MONTH_DAY, this).otherwise(F.add_months(this, 1))


def from_serial_day(n: str | Column) -> Column:
    return F.date_add(F.lit(SERIAL_DAY_ZERO).cast("date"), col(n).cast("int"))


def date_parts(date: str) -> dict[str, Column]:
    d = F.col(date)
    return {
        "day_of_month": F.dayofmonth(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "day_of_week": F.weekday(d),
        "week_of_month": F.floor((F.dayofmonth(d) - 1) / 7).cast("int") + 1,
        "year": F.year(d),
        "weekday_name": F.date_format(d, "EEEE"),
    }


def working_horizon(horizon: int | str | Column, weekend_days: int = 2) -> Column:
    """Horizon in days less its share of weekend days."""
    h = F.lit(horizon) if isinstance(horizon, int) else col(horizon)
    return (h - F.floor(h * weekend_days / 7)).cast("int")


def working_horizon_days(horizon: int, weekend_days: int = 2) -> int:
    return horizon - horizon * weekend_days // 7


def drop_weekends(df: DataFrame, date: str) -> DataFrame:
    return df.filter(~F.weekday(date).isin(*WEEKEND_DAYS))


# -- spines ----------------------------------------------------------------------------------

_STEPS = {
    "day": "interval 1 day",
    "week": "interval 7 days",
    "hour": "interval 1 hour",
}


def spine(df: DataFrame, series: Sequence[str], date: str, step: str) -> DataFrame:
    """Every step from each series' first to last date. Month steps are month ends."""
    ends = df.groupBy(*series).agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    if step == "month_end":
        months = F.sequence(F.trunc("lo", "MM").cast("date"), F.trunc("hi", "MM").cast("date"), F.expr("interval 1 month"))
        return ends.select(*series, F.explode(months).alias("__m")).select(*series, F.last_day("__m").alias(date))
    return ends.select(*series, F.explode(F.sequence("lo", "hi", F.expr(_STEPS[step]))).alias(date))


def complete(df: DataFrame, series: Sequence[str], date: str, step: str) -> DataFrame:
    """The rows of ``df`` on its full calendar; missing dates become null rows."""
    return matched(spine(df, series, date, step), df, [*series, date])


def align_to_weekday(df: DataFrame, series: Sequence[str], date: str, cols: Sequence[str], day: str = "FRI") -> DataFrame:
    """One row per week ending on ``day``: first non-null value of each column in date order.

    Weeks without rows appear with nulls; the date of the first row is kept.
    """
    weekly = df.groupBy(*series, week_ending(date, day).alias("__week")).agg(
        F.min(date).alias("original_date"), *[non_null_first(c, date).alias(c) for c in cols]
    )
    return complete(weekly.withColumnRenamed("__week", date), series, date, "week")


def interpolate(panel: Panel, cols: Sequence[str]) -> Panel:
    """Linear between known values, by row position; leading nulls stay, the tail holds the last value."""
    p = panel.positions("__i")
    names = {c: (f"__p_{c}", f"__pi_{c}", f"__n_{c}", f"__ni_{c}") for c in cols}
    seed: dict[str, Column] = {}
    for c, (pv, pi, nv, ni) in names.items():
        at = F.when(F.col(c).isNotNull(), F.col("__i"))
        seed.update({pv: F.col(c).cast("double"), nv: F.col(c).cast("double"), pi: at, ni: at})
    p = p.with_df(p.df.withColumns(seed))
    p = p.fill_forward([x for pv, pi, _, _ in names.values() for x in (pv, pi)])
    p = p.fill_back([x for _, _, nv, ni in names.values() for x in (nv, ni)])
    out = {}
    for c, (pv, pi, nv, ni) in names.items():
        prev, prev_i, nxt, nxt_i = (F.col(x) for x in (pv, pi, nv, ni))
        inside = prev + (nxt - prev) * (F.col("__i") - prev_i) / (nxt_i - prev_i)
        out[c] = F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(nxt.isNull(), prev).otherwise(inside)
    df = p.df.withColumns(out)
    return p.with_df(df.drop("__i", *[x for t in names.values() for x in t]))


def fill_edges(panel: Panel, cols: Sequence[str]) -> Panel:
    """Next known value, then last known value."""
    return panel.fill_back(cols).fill_forward(cols)


def to_weekly(df: DataFrame, series: Sequence[str], date: str, cols: Sequence[str], day: str = "FRI") -> DataFrame:
    """Mean per week ending on ``day``, missing weeks interpolated."""
    weekly = df.groupBy(*series, week_ending(date, day).alias("__week")).agg(*[F.avg(c).alias(c) for c in cols])
    full = complete(weekly.withColumnRenamed("__week", date), series, date, "week")
    return interpolate(Panel.calendar(full, series, date), cols).finish()


def to_month_ends(df: DataFrame, series: Sequence[str], date: str, cols: Sequence[str]) -> DataFrame:
    """Rows that fall exactly on a month end, on the full month-end grid, gaps interpolated."""
    on_grid = df.filter(F.col(date) == F.last_day(date)).select(*series, date, *cols)
    full = matched(spine(df, series, date, "month_end"), on_grid, [*series, date])
    return interpolate(Panel.calendar(full, series, date), cols).finish()


# -- futures ---------------------------------------------------------------------------------


def future_days(df: DataFrame, series: Sequence[str], date: str, horizon: int) -> DataFrame:
    """``horizon + 1`` days after each series' last date."""
    last = df.groupBy(*series).agg(F.max(date).cast("date").alias("__last"))
    days = F.sequence(F.date_add("__last", 1), F.date_add("__last", horizon + 1))
    return last.select(*series, F.explode(days).alias(date))


def future_weeks(df: DataFrame, series: Sequence[str], date: str, horizon: int, day: str = "FRI") -> DataFrame:
    """The next ``horizon`` named weekdays after each series' last date."""
    last = df.groupBy(*series).agg(F.max(date).cast("date").alias("__last"))
    first = F.next_day("__last", day)
    weeks = F.sequence(first, F.date_add(first, 7 * (horizon - 1)), F.expr("interval 7 days"))
    return last.select(*series, F.posexplode(weeks).alias("step", date)).withColumn("step", F.col("step") + 1)


def future_months(df: DataFrame, series: Sequence[str], date: str, horizon: int) -> DataFrame:
    last = df.groupBy(*series).agg(F.max(date).cast("date").alias("__last"))
    steps = last.select(*series, "__last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return steps.select(*series, "step", F.add_months("__last", F.col("step")).alias(date))


# -- frequency and window ids ----------------------------------------------------------------


def infer_step(panel: Panel, date: str) -> DataFrame:
    """Most common gap in days per series, its label, and whether every gap agrees with it."""
    p = panel.frames(lambda w: {"__gap": F.datediff(F.col(date), F.lag(date, 1).over(w))}, back=1)
    gaps = p.df.filter(F.col("__gap").isNotNull()).groupBy(*p.series, "__gap").count()
    label = F.lit("A")
    for days, name in reversed(STEP_LABELS):
        label = F.when(F.col("step_days") <= days, name).otherwise(label)
    found = gaps.groupBy(*p.series).agg(
        F.max_by("__gap", F.struct(F.col("count"), -F.col("__gap"))).alias("step_days"),
        (F.count("*") == 1).alias("regular"),
    )
    return found.withColumn("frequency", label)


def number_labels(df: DataFrame, label: str, out: str) -> DataFrame:
    """Number the ordered distinct labels from 1.

    Only the distinct labels are ranked; the ranks are joined back. Null is a label too and comes first.
    """
    p = Panel(df.select(label).distinct(), [], [label]).positions(out)
    return matched(df, p.df.select(label, F.col(out).cast("int").alias(out)), [label], True)

"""Small column expressions shared by every operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sdiv(a: str | Column, b: str | Column) -> Column:
    """Division that gives null, not an error, on a zero denominator."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def before(w: WindowSpec, n: int) -> WindowSpec:
    """The n rows before the current one, which stays out."""
    return w.rowsBetween(-n, -1)


def upto(w: WindowSpec, n: int) -> WindowSpec:
    """The n rows ending at the current one."""
    return w.rowsBetween(-(n - 1), 0)


def guarded(agg: Callable[[Column], Column], c: str | Column, frame: WindowSpec, least: int) -> Column:
    """``agg`` over ``frame``, null while the frame has fewer than ``least`` non-null values."""
    return F.when(F.count(col(c)).over(frame) >= least, agg(col(c)).over(frame))


def rolling(agg: Callable[[Column], Column], c: str | Column, w: WindowSpec, n: int, least: int | None = None) -> Column:
    """``agg`` over the n rows before the current one."""
    return guarded(agg, c, before(w, n), n if least is None else least)


def non_null_first(c: str, order: str | Column) -> Column:
    """First non-null ``c`` in ``order``, as a mergeable aggregate."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), col(order)))


def finite_or_null(c: str | Column) -> Column:
    x = col(c)
    return F.when(F.abs(x) != F.lit(float("inf")), x)


def rounded(c: str | Column, digits: int) -> Column:
    """Round half away from zero, after dropping float noise three places further down.

    Rounding doubles directly makes exact ties depend on the last bit of a sum's order. Whole
    numbers do the work, so the expression stays in generated code; values too large for that
    go through decimals, and infinities pass.
    """
    x = col(c).cast("double")
    scaled = F.abs(x) * F.lit(float(10 ** (digits + 3)))
    steps = F.floor((F.floor(scaled + 0.5) + 500) / 1000)
    fast = F.when(x < 0, -steps).otherwise(steps) / F.lit(float(10**digits))
    slow = F.round(x.cast(f"decimal(38,{digits + 3})"), digits).cast("double")
    return F.when(scaled < F.lit(2.0**52), fast).when(scaled < F.lit(1e30), slow).otherwise(x)

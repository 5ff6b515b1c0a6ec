"""Target features read off an array of past values, newest last.

These mirror the window features so that a forecast can refresh them from its own predictions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesloom.functions.columns import sdiv
from seriesloom.operators import features as ft
from seriesloom.plans.config import FeatureSet


def tail(h: Column, n: int) -> Column:
    """The last n values, fewer when there are not as many."""
    return F.slice(h, F.greatest(F.size(h) - n + 1, F.lit(1)), F.lit(n))


def nth_last(h: Column, n: int) -> Column:
    return F.try_element_at(h, F.lit(-n))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def mean(a: Column) -> Column:
    return sdiv(total(a), F.size(a))


def deviation(a: Column) -> Column:
    """Sample standard deviation."""
    m = mean(a)
    squares = F.aggregate(F.transform(a, lambda x: x - m), F.lit(0.0), lambda acc, d: acc + d * d)
    return F.sqrt(sdiv(squares, F.size(a) - 1))


def full(h: Column, n: int, value: Column) -> Column:
    return F.when(F.size(h) >= n, value)


def strength(h: Column, n: int) -> Column:
    """Strength index over the last n changes; 100 when nothing was lost."""
    past = tail(h, n + 1)
    k = F.size(past)
    changes = F.zip_with(F.slice(past, F.lit(2), k - 1), F.slice(past, F.lit(1), k - 1), lambda b, a: b - a)
    gain = total(F.transform(changes, lambda d: F.greatest(d, F.lit(0.0))))
    loss = total(F.transform(changes, lambda d: F.greatest(-d, F.lit(0.0))))
    return F.when(loss > 0, 100 - 100 / (1 + gain / loss)).otherwise(F.lit(100.0))


def target_features(h: Column, fs: FeatureSet) -> dict[str, Column]:
    """All target features of ``fs`` for the row after the last value of ``h``."""
    y = fs.target
    out: dict[str, Column] = {ft.LAG_NAME.format(c=y, n=n): nth_last(h, n) for n in fs.lags}
    out |= {ft.SMA_NAME.format(c=y, n=n): full(h, n, mean(tail(h, n))) for n in fs.averages}
    out |= {ft.SUM_NAME.format(c=y, n=n): full(h, n, total(tail(h, n))) for n in fs.sums}
    out |= {
        ft.LAG_RATIO_NAME.format(c=y, a=a, b=b): 100 * sdiv(nth_last(h, a), nth_last(h, b)) for a, b in fs.lag_ratios
    }
    out |= {
        ft.SUM_RATIO_NAME.format(c=y, a=a, b=b): 100 * sdiv(total(tail(h, a)), total(tail(h, b))) for a, b in fs.sum_ratios
    }
    out |= {
        ft.SMA_RATIO_NAME.format(c=y, a=a, b=b): 100 * sdiv(mean(tail(h, a)), mean(tail(h, b))) for a, b in fs.average_ratios
    }
    out |= {ft.BAND_NAME.format(n=n): full(h, n, 4 * deviation(tail(h, n))) for n in fs.bands}
    out |= {ft.RSI_NAME.format(n=n): strength(h, n) for n in fs.strength}
    if fs.trailing_max:
        out["cum_max"] = F.array_max(tail(h, ft.TRAILING_MAX_ROWS))
    return out

"""Distribution functions: the normal one as an expression, those for p-values as vectorised functions over small aggregated tables."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_EPS = 1e-15
_TINY = 1e-300


# A published Chebyshev fit of the complementary error function, error below 1.2e-7 everywhere, lowest power first.
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def normal_p_below(x: Column) -> Column:
    """Standard normal distribution function, as an expression."""
    z = F.abs(x) / math.sqrt(2.0)
    t = 1 / (1 + z / 2)
    power = F.lit(ERFC[-1])
    for c in reversed(ERFC[:-1]):
        power = F.lit(c) + t * power
    tail = t * F.exp(power - z * z) / 2
    return F.when(x > 0, 1 - tail).otherwise(tail)


def _fraction(terms, limit: int = 500) -> float:
    """Continued fraction by the modified Lentz rule; ``terms`` yields (a, b)."""
    f, c, d = _TINY, _TINY, 0.0
    for i, (a, b) in enumerate(terms):
        d = b + a * d
        d = 1.0 / (d if d else _TINY)
        c = b + a / c
        c = c if c else _TINY
        f *= c * d
        if i > 2 and abs(c * d - 1.0) < _EPS or i > limit:
            break
    return f


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_cdf(1.0 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a

    def terms():
        yield 1.0, 1.0
        m = 0
        while True:
            m += 1
            yield -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1)), 1.0
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    return front * _fraction(terms())


def chi_square_tail(x: float, k: float) -> float:
    """Upper tail of the chi-square distribution."""
    a, y = k / 2.0, x / 2.0
    if y <= 0.0:
        return 1.0
    front = math.exp(a * math.log(y) - y - math.lgamma(a))
    if y < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * _EPS:
            n += 1.0
            term *= y / n
            total += term
        return 1.0 - total * front

    def terms():
        yield 1.0, y + 1.0 - a
        i = 0
        while True:
            i += 1
            yield -i * (i - a), y + 2.0 * i + 1.0 - a

    return front * _fraction(terms())


def t_two_sided(t: float, df: float) -> float:
    return beta_cdf(df / (df + t * t), df / 2.0, 0.5)


def f_tail(f: float, d1: float, d2: float) -> float:
    return beta_cdf(d2 / (d2 + d1 * f), d2 / 2.0, d1 / 2.0)


def _lift(fn, *args: pd.Series) -> pd.Series:
    rows = zip(*[a.astype("float64").tolist() for a in args])
    return pd.Series([fn(*r) if not any(math.isnan(v) or math.isinf(v) for v in r) else math.nan for r in rows], dtype="float64")


def t_two_sided_p(t, df):
    @F.pandas_udf("double")
    def p(t: pd.Series, df: pd.Series) -> pd.Series:
        return _lift(t_two_sided, t, df)

    return p(t, df)


def chi_square_p(x, k):
    @F.pandas_udf("double")
    def p(x: pd.Series, k: pd.Series) -> pd.Series:
        return _lift(chi_square_tail, x, k)

    return p(x, k)


def f_p(f, d1, d2):
    @F.pandas_udf("double")
    def p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
        return _lift(f_tail, f, d1, d2)

    return p(f, d1, d2)

"""Ordered features of a panel, built together so they share one exchange and one sort.

A :class:`Feature` says which columns it needs over which frames; :func:`add_features` runs
any number of them in one pass: frame stages, fills, then plain arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from seriesloom.functions.columns import before, guarded, rolling, sdiv, upto
from seriesloom.operators.panel import Panel, matched

# --- fixed values: output column names and defaults users rely on ---
LAG_NAME = "{c}_lag_{n}"
SMA_NAME = "{c}_sma_{n}"
MAX_NAME = "{c}_mm_{n}"
SUM_NAME = "{c}_ms_{n}"
TO_SMA_NAME = "comparison_{c}_sma_{n}"
LAG_RATIO_NAME = "comparison_{c}_shift_{a}_{b}"
SUM_RATIO_NAME = "comparison_{c}_ms_{a}_{b}"
SMA_RATIO_NAME = "comparison_{c}_sma_{a}_{b}"
BAND_NAME = "bband_spread_{n}"
RSI_NAME = "rsi_{n}"
RUN_NAME = "consecutive_increases_{n}"
SMOOTH_ALPHA = 0.109
TRAILING_MAX_ROWS = 52
RATIO_LEAST_ROWS = 3
# --------------------------------------------------------------------

Stage = Callable[[WindowSpec], Mapping[str, Column]]


@dataclass(frozen=True)
class Feature:
    """Columns over frames (``stages``), back-filled columns, then row arithmetic (``final``)."""

    names: tuple[str, ...]
    stages: tuple[Stage, ...]
    back: int
    ahead: int = 0
    fill: tuple[str, ...] = ()
    final: Callable[[], Mapping[str, Column]] = dict
    edge_fill: bool = False


def add_features(panel: Panel, features: Sequence[Feature], *, fill: str | None = "bfill", leading: bool = False) -> Panel:
    """Add all ``features``.

    ``fill='bfill'`` fills leading gaps with the first later value, which shows the first rows
    their own future; ``fill=None`` leaves them null. ``leading=True`` states that the inputs
    have no nulls, so filled columns can only be null at the head and a cheaper fill does.
    """
    depth = max((len(f.stages) for f in features), default=0)

    def merged(i: int) -> Stage:
        def build(w: WindowSpec) -> dict[str, Column]:
            out: dict[str, Column] = {}
            for f in features:
                if i < len(f.stages):
                    out.update(f.stages[i](w))
            return out

        return build

    p = panel.frames(
        *[merged(i) for i in range(depth)],
        back=max((f.back for f in features), default=0),
        ahead=max((f.ahead for f in features), default=0),
    )
    if fill == "bfill":
        p = p.fill_back(list(dict.fromkeys(c for f in features for c in f.fill)), leading=leading)
    final = {n: e for f in features for n, e in f.final().items()}
    if final:
        p = p.with_df(p.df.withColumns(final))
    if fill == "bfill":
        edge = [n for f in features if f.edge_fill for n in f.names]
        p = p.fill_back(edge).fill_forward(edge)
    scratch = {c for c in p.df.columns if c.startswith("__f_")}
    return p.with_df(p.df.drop(*scratch))


# -- lags and moving aggregates ------------------------------------------------------------


def lag(c: str, n: int) -> Feature:
    name = LAG_NAME.format(c=c, n=n)
    return Feature((name,), (lambda w: {name: F.lag(c, n).over(w)},), n, fill=(name,))


def _moving(name: str, agg: Callable[[Column], Column], c: str, n: int) -> Feature:
    return Feature((name,), (lambda w: {name: rolling(agg, c, w, n)},), n, fill=(name,))


def moving_average(c: str, n: int) -> Feature:
    return _moving(SMA_NAME.format(c=c, n=n), F.avg, c, n)


def moving_max(c: str, n: int) -> Feature:
    return _moving(MAX_NAME.format(c=c, n=n), F.max, c, n)


def moving_sum(c: str, n: int) -> Feature:
    return _moving(SUM_NAME.format(c=c, n=n), F.sum, c, n)


def trailing_max(c: str, n: int = TRAILING_MAX_ROWS, name: str = "cum_max") -> Feature:
    return Feature((name,), (lambda w: {name: F.max(c).over(before(w, n))},), n)


def shifted_window(c: str, start: int, end: int, name: str, agg: Callable[[Column], Column] = F.avg) -> Feature:
    """``agg`` of the rows from ``end`` back to ``start`` back, full windows only."""
    return Feature(
        (name,), (lambda w: {name: guarded(agg, c, w.rowsBetween(-end, -start), end - start + 1)},), end
    )


def shifted_quantile(c: str, start: int, end: int, q: float, name: str) -> Feature:
    return shifted_window(c, start, end, name, lambda x: F.percentile(x, F.lit(q)))


def differences(c: str, lags: Sequence[int] = (1, 12)) -> Feature:
    names = {f"{c}_diff_{k}": k for k in lags}
    return Feature(
        tuple(names), (lambda w: {n: F.col(c) - F.lag(c, k).over(w) for n, k in names.items()},), max(lags)
    )


# -- ratios --------------------------------------------------------------------------------


def to_moving_average(c: str, n: int) -> Feature:
    """Current value over the moving average before it."""
    name, tmp = TO_SMA_NAME.format(c=c, n=n), f"__f_avg_{c}_{n}"
    return Feature(
        (name,), (lambda w: {tmp: rolling(F.avg, c, w, n)},), n, fill=(tmp,), final=lambda: {name: sdiv(c, tmp)}
    )


def lag_ratio(c: str, a: int, b: int) -> Feature:
    name = LAG_RATIO_NAME.format(c=c, a=a, b=b)
    ta, tb = f"__f_lag_{c}_{a}", f"__f_lag_{c}_{b}"
    return Feature(
        (name,),
        (lambda w: {ta: F.lag(c, a).over(w), tb: F.lag(c, b).over(w)},),
        max(a, b),
        fill=(ta, tb),
        final=lambda: {name: 100 * sdiv(ta, tb)},
    )


def _window_ratio(name: str, agg: Callable[[Column], Column], kind: str, c: str, a: int, b: int) -> Feature:
    ta, tb = f"__f_{kind}_{c}_{a}", f"__f_{kind}_{c}_{b}"
    least = {t: min(RATIO_LEAST_ROWS, n) for t, n in ((ta, a), (tb, b))}
    return Feature(
        (name,),
        (lambda w: {ta: rolling(agg, c, w, a, least[ta]), tb: rolling(agg, c, w, b, least[tb])},),
        max(a, b),
        fill=(ta, tb),
        final=lambda: {name: 100 * sdiv(ta, tb)},
        edge_fill=True,
    )


def moving_sum_ratio(c: str, a: int, b: int) -> Feature:
    return _window_ratio(SUM_RATIO_NAME.format(c=c, a=a, b=b), F.sum, "s3", c, a, b)


def moving_average_ratio(c: str, a: int, b: int) -> Feature:
    return _window_ratio(SMA_RATIO_NAME.format(c=c, a=a, b=b), F.avg, "a3", c, a, b)


def spread(a: str, b: str, n: int, name: str) -> Feature:
    out = LAG_NAME.format(c=name, n=n)
    return Feature(
        (out,),
        (lambda w: {out: F.lag(F.col(a) - F.col(b), n).over(w)},),
        n,
        fill=(out,),
    )


# -- bands and oscillators -----------------------------------------------------------------


def band_spread(c: str, n: int, k: float = 2.0) -> Feature:
    """Width of the k-deviation band around the moving average."""
    name = BAND_NAME.format(n=n)
    return Feature((name,), (lambda w: {name: 2 * k * rolling(F.stddev_samp, c, w, n)},), n, fill=(name,))


def band_lines(c: str, n: int, k: float = 2.0) -> Feature:
    """Middle, upper and lower band line and their spread, unfilled."""
    mid, dev = f"__f_mid_{c}_{n}", f"__f_dev_{c}_{n}"
    names = (f"middle_bband_{n}", f"upper_bband_{n}", f"lower_bband_{n}", BAND_NAME.format(n=n))

    def lines() -> dict[str, Column]:
        m, d = F.col(mid), F.col(dev)
        return dict(zip(names, (m, m + k * d, m - k * d, 2 * k * d)))

    return Feature(
        names,
        (lambda w: {mid: rolling(F.avg, c, w, n), dev: rolling(F.stddev_samp, c, w, n)},),
        n,
        final=lines,
    )


def _change(c: str) -> Stage:
    return lambda w: {f"__f_d_{c}": F.col(c) - F.lag(c, 1).over(w)}


def _gain(c: str) -> Column:
    d = F.col(f"__f_d_{c}")
    return F.when(d.isNotNull(), F.greatest(d, F.lit(0.0)))


def _loss(c: str) -> Column:
    d = F.col(f"__f_d_{c}")
    return F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0)))


def strength_index(c: str, n: int) -> Feature:
    """Relative strength index over the n changes before the row; no losses give a gap."""
    name = RSI_NAME.format(n=n)

    def index(w: WindowSpec) -> dict[str, Column]:
        gain, loss = F.avg(_gain(c)).over(before(w, n)), F.avg(_loss(c)).over(before(w, n))
        return {name: 100 - 100 / (1 + sdiv(gain, F.nullif(loss, F.lit(0.0))))}

    return Feature((name,), (_change(c), index), n + 1, fill=(name,))


def strength_index_inclusive(c: str, n: int) -> Feature:
    """Relative strength index with the current change inside; the first change counts as zero."""
    name = f"rsi_incl_{n}"

    def index(w: WindowSpec) -> dict[str, Column]:
        f = upto(w, n)
        gain, loss = (F.avg(F.coalesce(x, F.lit(0.0))).over(f) for x in (_gain(c), _loss(c)))
        return {name: F.when((loss == 0) & (gain > 0), 100.0).otherwise(100 - 100 / (1 + sdiv(gain, loss)))}

    return Feature((name,), (_change(c), index), n + 1)


def strength_index_smoothed(panel: Panel, c: str, n: int = 14) -> Panel:
    """Relative strength index with gains and losses averaged by a 1/n recursion."""
    p = panel.frames(
        lambda w: {"__f_prev": F.lag(c, 1).over(w)}, back=1
    )
    d = F.col(c) - F.col("__f_prev")
    p = p.with_df(
        p.df.withColumns(
            {"__f_gain": F.greatest(d, F.lit(0.0)), "__f_loss": F.greatest(-d, F.lit(0.0))}
        ).withColumns({x: F.when(F.col("__f_prev").isNotNull(), F.col(x)) for x in ("__f_gain", "__f_loss")})
    )
    p = p.decayed_mean("__f_up", "__f_gain", 1.0 / n, adjust=False).decayed_mean("__f_down", "__f_loss", 1.0 / n, adjust=False)
    up, down = F.col("__f_up"), F.col("__f_down")
    value = F.when((down == 0) & (up > 0), 100.0).otherwise(100 - 100 / (1 + sdiv(up, down)))
    df = p.df.withColumn(f"rsi_wilder_{n}", value)
    return p.with_df(df.drop(*[c for c in df.columns if c.startswith("__f_")]))


def stochastic(low: str, high: str, close: str, n: int = 14, smooth: int = 3) -> Feature:
    """%K: place of the close in the last n rows' range; %D: its short average."""
    k, d = f"stoch_k_{n}", f"stoch_d_{smooth}"

    def first(w: WindowSpec) -> dict[str, Column]:
        f = upto(w, n)
        lo = F.when(F.count(low).over(f) >= n, F.min(low).over(f))
        hi = F.when(F.count(high).over(f) >= n, F.max(high).over(f))
        return {k: 100 * sdiv(F.col(close) - lo, hi - lo)}

    return Feature((k, d), (first, lambda w: {d: guarded(F.avg, k, upto(w, smooth), smooth)}), n + smooth)


def price_range(c: str, n: int = 12, least: int = 2) -> Feature:
    """Moving max and min before the row, their distance, and its change."""
    hi, lo, amp, damp = (f"{c}_{x}_{n}" for x in ("rmax", "rmin", "amplitude", "amplitude_diff"))
    return Feature(
        (hi, lo, amp, damp),
        (
            lambda w: {hi: rolling(F.max, c, w, n, least), lo: rolling(F.min, c, w, n, least)},
            lambda w: {amp: F.col(hi) - F.col(lo)},
            lambda w: {damp: F.col(amp) - F.lag(amp, 1).over(w)},
        ),
        n + 1,
    )


def returns(c: str, n: int = 12) -> Feature:
    """Log return, its size, its moving deviation, and level deviation, average and variation."""
    r, a, vol, dev, avg, cv = (
        f"{c}_{x}" for x in ("log_return", "abs_return", f"volatility_{n}", f"std_{n}", f"avg_{n}", f"cv_{n}")
    )
    return Feature(
        (r, a, vol, dev, avg, cv),
        (
            lambda w: {
                r: F.log(sdiv(c, F.lag(c, 1).over(w))),
                dev: guarded(F.stddev_samp, c, upto(w, n), n),
                avg: guarded(F.avg, c, upto(w, n), n),
            },
            lambda w: {a: F.abs(F.col(r)), vol: guarded(F.stddev_samp, r, upto(w, n), n), cv: sdiv(dev, avg)},
        ),
        n + 1,
    )


def short_volatility(c: str, n: int = 3) -> Feature:
    name = f"{c}_vol_{n}"
    return Feature((name,), (lambda w: {name: F.stddev_samp(c).over(before(w, n))},), n)


def crossover_averages(c: str, a: int, b: int) -> Feature:
    names = {f"sma_{n}": n for n in (a, b)}
    return Feature(tuple(names), (lambda w: {k: guarded(F.avg, c, upto(w, n), n) for k, n in names.items()},), max(a, b))


# -- features that need the whole series -----------------------------------------------------


def smoothed(panel: Panel, c: str, out: str, n: int, alpha: float = SMOOTH_ALPHA) -> Panel:
    """Shift by n, average with decaying weights, fill both ends."""
    p = panel.frames(lambda w: {"__f_shifted": F.lag(c, n).over(w)}, back=n)
    p = p.decayed_mean(out, "__f_shifted", alpha, adjust=True)
    p = p.with_df(p.df.drop("__f_shifted"))
    return p.fill_back([out]).fill_forward([out])


def span_average(panel: Panel, c: str, span: int) -> Panel:
    """Recursive average with weight 2/(span+1) on the new value."""
    return panel.decayed_mean(f"{c}_ema_{span}", c, 2.0 / (span + 1), adjust=False)


def increase_runs(panel: Panel, c: str, n: int) -> Panel:
    """Count of increases so far in the current run.

    A run ends whenever "more than n of the last n+1 rows did not rise" turns true or false.
    """
    name = RUN_NAME.format(n=n)
    p = panel.frames(
        lambda w: {"__f_up": F.coalesce(F.col(c) > F.lag(c, 1).over(w), F.lit(False)).cast("long")},
        lambda w: {"__f_idle": (F.sum(1 - F.col("__f_up")).over(upto(w, n + 1)) > n).cast("int")},
        lambda w: {"__f_turn": (~F.lag("__f_idle", 1).over(w).eqNullSafe(F.col("__f_idle"))).cast("long")},
        back=n + 2,
    )
    # Increases since the run began = all increases so far - those before the run's first row.
    p = p.running_sums({"__f_all": F.col("__f_up")})
    p = p.with_df(p.df.withColumn("__f_before", F.when(F.col("__f_turn") == 1, F.col("__f_all") - F.col("__f_up"))))
    p = p.fill_forward(["__f_before"])
    df = p.df.withColumn(name, F.col("__f_all") - F.coalesce("__f_before", F.lit(0)))
    return p.with_df(df.drop(*[x for x in df.columns if x.startswith("__f_")]))


def detrended(panel: Panel, c: str, out: str | None = None) -> Panel:
    """Subtract the least-squares line over the row position."""
    out = out or f"{c}_detrended"
    p = panel.positions("__f_t")
    fit = p.df.groupBy(*p.series).agg(
        F.regr_slope(F.col(c), F.col("__f_t")).alias("__f_b"), F.regr_intercept(F.col(c), F.col("__f_t")).alias("__f_a")
    )
    df = attach(p.df, fit, p.series).withColumn(out, F.col(c) - (F.col("__f_a") + F.col("__f_b") * F.col("__f_t")))
    return p.with_df(df.drop("__f_a", "__f_b", "__f_t"))


def attach(df, per_key, keys: Sequence[str], how: str = "left"):
    """Join one row per key back to the rows; the row of a null key goes to the rows with a null key.

    No broadcast hint: adaptive execution broadcasts when the measured side is small, and
    otherwise splits the hot keys of the large side.
    """
    return matched(df, per_key, list(keys), how=how) if keys else df.crossJoin(F.broadcast(per_key))

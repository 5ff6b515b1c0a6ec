"""Statistics of series: correlation, rank tests, shape, memory, seasonality, stationarity."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.functions import distributions as ds
from seriesloom.functions.columns import sdiv
from seriesloom.operators.features import attach
from seriesloom.operators.panel import SLAB, Panel, in_slabs, matched
from seriesloom.operators.regression import FIT, _solve, least_squares

# --- fixed values: MacKinnon (2010) response surface, constant, one variable ---
UNIT_ROOT_SURFACE = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}
HURST_LAGS = tuple(range(4, 20))
# -------------------------------------------------------------------------------


def correlations(df: DataFrame, keys: Sequence[str], target: str, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of the target with each column, pairwise complete."""
    wide = df.groupBy(*keys).agg(*[F.corr(target, c).alias(c) for c in cols])
    return wide.unpivot(list(keys), list(cols), "column_name", "correlation")


def lagged_correlations(panel: Panel, target: str, c: str, max_lag: int) -> DataFrame:
    """Correlation of the target with ``c`` lagged 1 to ``max_lag``."""
    names = {f"{c}_lag_{k}": k for k in range(1, max_lag + 1)}
    p = panel.frames(lambda w: {n: F.lag(c, k).over(w) for n, k in names.items()}, back=max_lag)
    return correlations(p.df, p.series, target, list(names))


def pearson_test(df: DataFrame, keys: Sequence[str], x: str, y: str, *, p_value: bool = True) -> DataFrame:
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    out = df.filter(both).groupBy(*keys).agg(F.corr(x, y).alias("r"), F.count(F.lit(1)).alias("n"))
    out = out.withColumn("t", F.col("r") * F.sqrt(sdiv(F.col("n") - 2, 1 - F.col("r") * F.col("r"))))
    return out.withColumn("p", ds.t_two_sided_p(F.col("t"), F.col("n") - 2)) if p_value else out


def average_ranks(df: DataFrame, keys: Sequence[str], c: str, out: str, spread: Sequence[str] = (), rows_per_task: int | None = None) -> DataFrame:
    """Add the average rank of ``c`` in its key and, as ``<out>_ties``, how many rows share it. Rows without a value are left out.

    Keys that fit a task are one window. Otherwise rows are range-partitioned on (key, value, ``spread``) and ranked inside their sorted slab; a row per
    (key, slab) then shifts the ranks and puts together the values that lie across the border of slabs. No rows are joined on the
    value, so a value that very many rows share is as cheap as another.
    """
    rows = df.filter(F.col(c).isNotNull())
    panel = Panel(rows, keys, [c], rows_per_task=rows_per_task)
    ties = F.col(f"{out}_ties")
    if not panel.is_split:
        rows = rows.withColumns({out: F.rank().over(Window.partitionBy(*keys).orderBy(c)), f"{out}_ties": F.count(F.lit(1)).over(Window.partitionBy(*keys, c))})
        return rows.withColumn(out, F.col(out) + (ties - 1) / 2)
    slabbed = in_slabs(rows, [*keys, c, *spread], panel.total, panel.limit)
    own = Window.partitionBy(SLAB, *keys).orderBy(c)
    # ties in the slab, and rows of the slab before them
    slabbed = slabbed.withColumns({f"{out}_ties": F.count(F.lit(1)).over(Window.partitionBy(SLAB, *keys, c)), "__before": F.rank().over(own) - 1})
    slabbed = session.cut(slabbed)
    edges = slabbed.groupBy(*keys, SLAB).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(c).alias("__lo"), F.max(c).alias("__hi"), F.min_by(ties, c).alias("__lo_n"), F.max_by(ties, c).alias("__hi_n"),
    )
    before = F.sum("__rows").over(Window.partitionBy(*keys).orderBy(SLAB)) - F.col("__rows")
    edges = edges.withColumn("__base", before)
    # The first and the last value of each slab are the only ones that others may hold too.
    low = F.struct(F.col("__lo").alias("v"), F.col("__lo_n").alias("n"), F.col("__base").alias("at"), F.lit(True).alias("lo"))
    high = F.struct(F.col("__hi").alias("v"), F.col("__hi_n").alias("n"), (F.col("__base") + F.col("__rows") - F.col("__hi_n")).alias("at"), F.lit(False).alias("lo"))
    each = edges.select(*keys, SLAB, "__base", F.explode(F.when(F.col("__lo") == F.col("__hi"), F.array(low)).otherwise(F.array(low, high))).alias("__e"))
    whole = Window.partitionBy(*keys, "__e.v")
    each = each.withColumns({"__all": F.sum("__e.n").over(whole), "__start": F.min("__e.at").over(whole)})
    at_edge = lambda lo: F.max(F.when(F.col("__e.lo") == lo, F.struct("__e.v", "__all", "__start")))
    shifts = each.groupBy(*keys, SLAB).agg(F.first("__base").alias("__base"), at_edge(True).alias("__first"), at_edge(False).alias("__last"))
    placed = matched(slabbed, shifts, [*keys, SLAB], how="inner")
    edge = F.when(F.col(c) == F.col("__first.v"), F.col("__first")).when(F.col(c) == F.col("__last.v"), F.col("__last"))
    placed = placed.withColumn("__edge", edge)
    start = F.coalesce(F.col("__edge.__start"), F.col("__base") + F.col("__before"))
    placed = placed.withColumn(f"{out}_ties", F.coalesce(F.col("__edge.__all"), ties))
    placed = placed.withColumn(out, start + (F.col(f"{out}_ties") + 1) / 2)
    return placed.drop(SLAB, "__before", "__base", "__first", "__last", "__edge")


def spearman_test(df: DataFrame, keys: Sequence[str], x: str, y: str, *, p_value: bool = True, **kw) -> DataFrame:
    """Rank correlation. Each column is ranked in one ordered pass; a row goes through both with its key, its values and its ranks only."""
    both = df.select(*keys, F.col(x).alias("__x"), F.col(y).alias("__y")).filter("__x IS NOT NULL AND __y IS NOT NULL")
    ranked = average_ranks(average_ranks(both, keys, "__x", "__rx", ["__y"], **kw), keys, "__y", "__ry", ["__rx"], **kw)
    out = ranked.groupBy(*keys).agg(
        F.covar_pop("__rx", "__ry").alias("__xy"), F.var_pop("__rx").alias("__xx"), F.var_pop("__ry").alias("__yy"), F.count(F.lit(1)).alias("n")
    )
    out = out.select(*keys, sdiv(F.col("__xy"), F.sqrt(F.col("__xx") * F.col("__yy"))).alias("r"), "n")
    out = out.withColumn("t", F.col("r") * F.sqrt(sdiv(F.col("n") - 2, 1 - F.col("r") * F.col("r"))))
    return out.withColumn("p", ds.t_two_sided_p(F.col("t"), F.col("n") - 2)) if p_value else out


def seasonality_tests(df: DataFrame, keys: Sequence[str], c: str, group: str, alpha: float = 0.05, *, p_value: bool = True, **kw) -> DataFrame:
    """Do the groups (such as months) differ in level (Kruskal-Wallis) or in variance (Bartlett)?

    With a group of one row, which has no variance, ``bartlett`` is null. Rows without a value are left out.
    """
    rows = df.select(*keys, group, F.col(c).cast("double").alias(c))
    ranked = average_ranks(rows, keys, c, "__r", [group], **kw)
    per_group = ranked.groupBy(*keys, group).agg(
        F.count(F.lit(1)).alias("n"), F.sum("__r").alias("rank_sum"), F.var_samp(c).alias("v"),
        F.sum(F.col("__r_ties") * F.col("__r_ties") - 1).alias("tie_sum"),
    )
    n, k, v = F.col("n"), F.count(F.lit(1)), F.col("v")
    total = per_group.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"),
        k.alias("groups"),
        F.sum(F.col("rank_sum") * F.col("rank_sum") / n).alias("__rr"),
        F.sum("tie_sum").alias("__ties"),
        sdiv(F.sum((n - 1) * v), F.sum(n - 1)).alias("__pooled"),
        F.sum((n - 1) * F.log(v)).alias("__logs"),
        F.when(F.min(n) > 1, F.sum(sdiv(F.lit(1.0), n - 1))).alias("__inv"),
    )
    big = F.col("n_rows").cast("double")
    h = (12 / (big * (big + 1)) * F.col("__rr") - 3 * (big + 1)) / (1 - F.col("__ties") / (big * big * big - big))
    free = big - F.col("groups")
    bartlett = (free * F.log("__pooled") - F.col("__logs")) / (1 + (F.col("__inv") - 1 / free) / (3 * (F.col("groups") - 1)))
    out = total.select(*keys, "n_rows", "groups", h.alias("kruskal_h"), bartlett.alias("bartlett"))
    if not p_value:
        return out
    df1 = F.col("groups") - 1
    out = out.withColumns({"kruskal_p": ds.chi_square_p(F.col("kruskal_h"), df1), "bartlett_p": ds.chi_square_p(F.col("bartlett"), df1)})
    return out.withColumn("seasonal", F.col("kruskal_p") < alpha)


def normality(df: DataFrame, keys: Sequence[str], c: str, *, p_value: bool = True) -> DataFrame:
    """Omnibus normality statistic from skewness and kurtosis."""
    m = df.groupBy(*keys).agg(F.count(c).cast("double").alias("n"), F.skewness(c).alias("skew"), F.kurtosis(c).alias("kurt"))
    n = F.col("n")
    # Skewness to normal score.
    y = F.col("skew") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    b2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (b2 - 1)) - 1
    delta, a = 1 / F.sqrt(0.5 * F.log(w2)), F.sqrt(2 / (w2 - 1))
    z1 = delta * F.log(y / a + F.sqrt((y / a) * (y / a) + 1))
    # Kurtosis to normal score.
    mean = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("kurt") + 3 - mean) / F.sqrt(var)
    third = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    g = 6 + 8 / third * (2 / third + F.sqrt(1 + 4 / (third * third)))
    z2 = (1 - 2 / (9 * g) - F.cbrt((1 - 2 / g) / (1 + x * F.sqrt(2 / (g - 4))))) / F.sqrt(2 / (9 * g))
    out = m.filter(n >= 8).select(*keys, F.col("n").cast("long").alias("n"), z1.alias("z_skew"), z2.alias("z_kurtosis"), (z1 * z1 + z2 * z2).alias("k2"))
    return out.withColumn("p", ds.chi_square_p(F.col("k2"), F.lit(2.0))) if p_value else out


def ks_distance(panel: Panel, cdf: Column, name: str = "ks_distance") -> DataFrame:
    """Largest gap between the empirical and a given distribution; the panel is ordered by the value first."""
    p = panel.positions("__i")
    n = p.df.groupBy(*p.series).agg(F.count(F.lit(1)).alias("__n"))
    rows = attach(p.df.withColumn("__f", cdf), n, p.series)
    gap = F.greatest(F.col("__i") / F.col("__n") - F.col("__f"), F.col("__f") - (F.col("__i") - 1) / F.col("__n"))
    return rows.groupBy(*p.series).agg(F.max(gap).alias(name), F.max("__n").alias("n"))


def ks_normal(df: DataFrame, keys: Sequence[str], c: str, tie: Sequence[str], **kw) -> DataFrame:
    """One-sample distance from the standard normal."""
    return ks_distance(Panel(df.filter(F.col(c).isNotNull()), keys, [c, *tie], **kw), ds.normal_p_below(F.col(c)))


def likely_distribution(df: DataFrame, keys: Sequence[str], c: str, tie: Sequence[str], **kw) -> DataFrame:
    """Fit normal, log-normal and exponential by moments and keep the closest."""
    rows = df.filter(F.col(c).isNotNull()).select(*keys, c, *tie)
    x = F.col(c).cast("double")
    log_x = F.when(x > 0, F.log(x))
    fit = rows.groupBy(*keys).agg(
        F.avg(x).alias("__m"), F.stddev_pop(x).alias("__s"), F.min(x).alias("__lo"),
        F.when(F.min(x) > 0, F.avg(log_x)).alias("__lm"), F.stddev_pop(log_x).alias("__ls"),
    )
    fitted = attach(rows, fit, keys)
    shapes = {
        "norm": ds.normal_p_below(sdiv(x - F.col("__m"), "__s")),
        "lognorm": F.when(F.col("__lm").isNotNull(), ds.normal_p_below(sdiv(F.coalesce(log_x, F.lit(0.0)) - F.col("__lm"), "__ls"))),
        "expon": 1 - F.exp(-sdiv(x - F.col("__lo"), F.col("__m") - F.col("__lo"))),
    }
    p = Panel(fitted, keys, [c, *tie], **kw).positions("__i")
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    placed = attach(p.df.withColumns({f"__f_{k}": v for k, v in shapes.items()}), n, keys)
    high, low = F.col("__i") / F.col("__n"), (F.col("__i") - 1) / F.col("__n")
    gaps = placed.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(f"__f_{k}").isNotNull(), F.greatest(high - F.col(f"__f_{k}"), F.col(f"__f_{k}") - low))).alias(k)
            for k in shapes
        ]
    )
    long = gaps.unpivot(list(keys), list(shapes), "distribution", "distance").filter(F.col("distance").isNotNull())
    return long.groupBy(*keys).agg(
        F.min_by("distribution", F.struct("distance", "distribution")).alias("distribution"), F.min("distance").alias("distance")
    )


def hurst(panel: Panel, c: str, lags: Sequence[int] = HURST_LAGS) -> DataFrame:
    """Hurst exponent from how the deviation of differences grows with the lag."""
    names = {f"__d{k}": k for k in lags}
    p = panel.frames(lambda w: {n: F.col(c) - F.lag(c, k).over(w) for n, k in names.items()}, back=max(lags))
    wide = p.df.groupBy(*p.series).agg(*[F.sqrt(F.stddev_pop(n)).alias(n) for n in names])
    long = wide.unpivot(list(p.series), list(names), "__k", "tau")
    log_lag = F.log(F.substring("__k", 4, 10).cast("double"))
    tau = F.when(F.col("tau") > 0, F.log("tau"))
    return long.groupBy(*p.series).agg((2 * F.regr_slope(tau, log_lag)).alias("hurst"))


def autocorrelation(panel: Panel, c: str, max_lag: int) -> DataFrame:
    """Autocorrelation to ``max_lag``, one row per series and lag."""
    mean = panel.df.groupBy(*panel.series).agg(F.avg(c).alias("__mean"))
    p = panel.with_df(attach(panel.df, mean, panel.series))
    p = p.with_df(p.df.withColumn("__e", F.col(c) - F.col("__mean")))
    lags = range(0, max_lag + 1)
    p = p.frames(lambda w: {f"__p{k}": F.col("__e") * F.lag("__e", k).over(w) for k in lags}, back=max_lag)
    wide = p.df.groupBy(*p.series).agg(*[F.sum(f"__p{k}").alias(f"__s{k}") for k in lags])
    pairs = F.array(*[F.struct(F.lit(k).alias("lag"), sdiv(f"__s{k}", "__s0").alias("acf")) for k in lags])
    return wide.select(*p.series, F.explode(pairs).alias("__x")).select(*p.series, "__x.lag", "__x.acf")


def partial_from_auto(r: Sequence[float]) -> list[float]:
    """Partial autocorrelations from autocorrelations, lag 0 first (Durbin-Levinson)."""
    phi, out = np.zeros(0), [1.0]
    for k in range(1, len(r)):
        past = np.asarray(r[1:k])
        last = (r[k] - phi @ past[::-1]) / (1.0 - phi @ past) if k > 1 else r[1]
        phi = np.append(phi - last * phi[::-1], last)
        out.append(float(last))
    return out


def partial_autocorrelation(panel: Panel, c: str, max_lag: int) -> DataFrame:
    """Partial autocorrelation per series and lag; only max_lag + 1 numbers per series reach Python."""
    acf = autocorrelation(panel, c, max_lag).groupBy(*panel.series).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("lag", "acf"))), lambda x: x["acf"]).alias("__r")
    )

    @F.pandas_udf("array<double>")
    def solve(rs: pd.Series) -> pd.Series:
        return pd.Series([partial_from_auto(list(r)) for r in rs])

    return acf.select(*panel.series, F.posexplode(solve("__r")).alias("lag", "pacf"))


def decompose(panel: Panel, c: str, period: int) -> Panel:
    """Additive split into centred-average trend, phase means and residual."""
    half = period // 2
    p = panel.positions("__t")
    p = p.with_df(p.df.withColumn("__phase", F.pmod(F.col("__t") - 1, F.lit(period)).cast("int")))

    def trend(w) -> dict[str, Column]:
        frame = w.rowsBetween(-half, half)
        whole = F.count(c).over(frame) == 2 * half + 1
        if period % 2:
            return {"trend": F.when(whole, F.avg(c).over(frame))}
        ends = (F.lag(c, half).over(w) + F.lead(c, half).over(w)) / 2
        return {"trend": F.when(whole, (F.sum(c).over(frame) - ends) / period)}

    p = p.frames(trend, back=half, ahead=half)
    p = p.with_df(p.df.withColumn("detrended", F.col(c) - F.col("trend")))
    phases = p.df.groupBy(*p.series, "__phase").agg(F.avg("detrended").alias("__pm"))
    w = Window.partitionBy(*p.series)
    phases = phases.select(*p.series, "__phase", (F.col("__pm") - F.avg("__pm").over(w)).alias("seasonal"))
    df = matched(p.df, phases, [*p.series, "__phase"]).withColumns(
        {"resid": F.col("detrended") - F.col("seasonal"), "deseasonalised": F.col(c) - F.col("seasonal")}
    )
    return p.with_df(df.drop("__t", "__phase"))


def unit_root_test(panel: Panel, c: str, lags: int = 1) -> DataFrame:
    """Augmented Dickey-Fuller statistic with a constant and a fixed number of lagged changes."""
    names = [f"__dl{k}" for k in range(1, lags + 1)]
    p = panel.frames(
        lambda w: {"__level": F.lag(c, 1).over(w), "__change": F.col(c) - F.lag(c, 1).over(w)},
        lambda w: {n: F.lag("__change", k).over(w) for k, n in enumerate(names, 1)},
        back=lags + 1,
    )
    fit = least_squares(p.df, p.series, ["__level", *names], "__change")
    n = F.col(f"{FIT}.n").cast("double")
    out = {"statistic": sdiv(F.col(f"{FIT}.coefficients")[0], F.col(f"{FIT}.errors")[0])}
    for name, (b0, b1, b2, b3) in UNIT_ROOT_SURFACE.items():
        out[name] = b0 + b1 / n + b2 / (n * n) + b3 / (n * n * n)
    got = fit.select(*p.series, F.col(f"{FIT}.n").alias("n"), *[e.alias(k) for k, e in out.items()])
    return got.withColumn("stationary", F.col("statistic") < F.col("crit_5"))


def granger(panel: Panel, target: str, cause: str, max_lag: int, *, p_value: bool = True) -> DataFrame:
    """Does the past of ``cause`` help predict ``target``? F statistic per lag depth; a depth without enough rows has a null statistic.

    One aggregate gives the moments of all lags, apart for rows by how deep their lags are whole; the rows of a depth are those that reach it or more. The
    fits of all depths, with and without the cause, are solves on parts of these moments, so the rows are read once for any depth.
    """
    lags = range(1, max_lag + 1)
    p = panel.frames(
        lambda w: {f"__{v}{k}": F.lag(c, k).over(w) for v, c in (("y", target), ("x", cause)) for k in lags}, back=max_lag
    )
    names = [*[f"__y{k}" for k in lags], *[f"__x{k}" for k in lags], target]
    deep = F.lit(0)
    for k in reversed(lags):  # the first lag that is missing ends the depth
        deep = F.when(F.col(f"__y{k}").isNull() | F.col(f"__x{k}").isNull(), F.lit(k - 1)).otherwise(deep if k < max_lag else F.lit(max_lag))
    rows = p.df.withColumn("__depth", deep).filter(F.col(target).isNotNull() & (F.col("__depth") > 0))
    value = {n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names}  # lags beyond the depth are not read
    size = len(names)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    moments = rows.groupBy(*p.series, "__depth").agg(
        F.count(F.lit(1)).alias("__n"), F.array(*[F.avg(value[n]) for n in names]).alias("__means"),
        F.array(*[F.covar_pop(value[names[i]], value[names[j]]) for i, j in pairs]).alias("__cov"),
    )
    packed = moments.groupBy(*p.series).agg(F.collect_list(F.struct("__depth", "__n", "__means", "__cov")).alias("__all"))

    def fits(groups) -> list[dict]:
        out = []
        for depth in lags:
            use = [g for g in groups if g["__depth"] >= depth]
            n = sum(g["__n"] for g in use)
            pick = [*range(depth), *range(max_lag, max_lag + depth), size - 1]
            mean = sum((g["__n"] * np.asarray(g["__means"], float) for g in use), np.zeros(size)) / max(n, 1)
            cov = np.zeros((size, size))
            for g in use:
                own = np.zeros((size, size))
                for (i, j), v in zip(pairs, g["__cov"]):
                    own[i, j] = own[j, i] = v
                away = np.asarray(g["__means"], float) - mean
                cov += g["__n"] / n * (own + np.outer(away, away))
            rss = []
            for columns in (pick[:depth] + [size - 1], pick):
                rss.append(_solve(n, mean[columns], cov[np.ix_(columns, columns)], 0.0)["rss"])
            free = n - 2 * depth - 1
            stat = (rss[0] - rss[1]) / depth / (rss[1] / free) if n and free > 0 and rss[1] else None
            out.append({"lag": depth, "n": n, "f": stat, "free": free})
        return out

    @F.pandas_udf("array<struct<lag:int,n:bigint,f:double,free:bigint>>")
    def solve(groups: pd.Series) -> pd.Series:
        return groups.map(fits)

    out = packed.select(*p.series, F.explode(solve("__all")).alias("__f")).select(*p.series, "__f.*").filter("n > 0")
    return out.withColumn("p", ds.f_p(F.col("f"), F.col("lag"), F.col("free"))) if p_value else out

"""Statistics: X rows of the inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.catalog.base import (
    supplier_panel, using, weekly_panel,
    EVENTS_HOURLY, ORDER_ROWS, ORDERS_WEEKLY, SUPPLIER_MONTHLY, events_hourly_df, order_rows, order_rows_df, orders_weekly,
    over, query, round_to, supplier_monthly, table, with_,
)
from seriesloom.functions import distributions as ds
from seriesloom.operators import features as ft
from seriesloom.operators import regression as rg
from seriesloom.operators import spectrum as sp
from seriesloom.operators import statistics as st
from seriesloom.operators.panel import Panel

SM, OW = with_(SUPPLIER_MONTHLY), with_(ORDERS_WEEKLY)


query(
    "x01_correlations",
    f"""{SM}SELECT series, 'rev' AS column_name, round(corr(y, rev), 5) AS correlation FROM supplier_monthly GROUP BY 1
UNION ALL SELECT series, 'disc', round(corr(y, disc), 5) FROM supplier_monthly GROUP BY 1""",
)(using(supplier_panel, lambda p: round_to(st.correlations(p.df, ["series"], "y", ["rev", "disc"]), correlation=5)))
query(
    "x02_lagged_correlations",
    f"{SM}, l AS (SELECT series, y, " + ", ".join(f"lag(rev, {k}) {over()} AS l{k}" for k in range(1, 7)) + " FROM supplier_monthly) "
    + " UNION ALL ".join(f"SELECT series, 'rev_lag_{k}' AS column_name, round(corr(y, l{k}), 5) AS correlation FROM l GROUP BY 1" for k in range(1, 7)),
)(using(supplier_panel, lambda p: round_to(st.lagged_correlations(p, "y", "rev", 6), correlation=5)))
query(
    "x03_pearson",
    f"""{SM}, c AS (SELECT series, corr(y, disc) AS r, count(*) AS n FROM supplier_monthly GROUP BY 1)
SELECT series, round(r, 6) AS r, n, round(r * sqrt((n - 2) / (1 - r * r)), 4) AS t FROM c""",
)(using(supplier_panel, lambda p: round_to(st.pearson_test(p.df, ["series"], "y", "disc", p_value=False), r=6, t=4)))
query("x03_pearson_with_p")(using(supplier_panel, lambda p: st.pearson_test(p.df, ["series"], "y", "disc")))
_RANK = lambda key, c: f"rank() OVER (PARTITION BY {key} ORDER BY {c}) + (count(*) OVER (PARTITION BY {key}, {c}) - 1) / 2.0::DOUBLE"
query(
    "x04_spearman",
    f"""{SM}, k AS (SELECT series, {_RANK('series', 'y')} AS a, {_RANK('series', 'disc')} AS b FROM supplier_monthly),
c AS (SELECT series, corr(a, b) AS r, count(*) AS n FROM k GROUP BY 1)
SELECT series, round(r, 6) AS r, n, round(r * sqrt((n - 2) / (1 - r * r)), 4) AS t FROM c""",
)(using(supplier_panel, lambda p: round_to(st.spearman_test(p.df, ["series"], "y", "disc", p_value=False), r=6, t=4)))
query(
    "x04_spearman_rows",
    f"""WITH k AS (SELECT l_returnflag, {_RANK('l_returnflag', 'l_extendedprice')} AS a, {_RANK('l_returnflag', 'l_quantity')} AS b FROM lineitem),
c AS (SELECT l_returnflag, corr(a, b) AS r, count(*) AS n FROM k GROUP BY 1)
SELECT l_returnflag, round(r, 6) AS r, n, round(r * sqrt((n - 2) / (1 - r * r)), 3) AS t FROM c""",
)(
    lambda spark, sf: round_to(
        st.spearman_test(
            table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity", p_value=False, rows_per_task=5_000
        ),
        r=6, t=3,
    )
)


def _by_month(df):
    return df.withColumn("month", F.month("date"))


query(
    "x05_seasonality_tests",
    f"""{OW}, m AS (SELECT series, y, month(date) AS g, {_RANK('series', 'y')} AS r, count(*) OVER (PARTITION BY series, y) AS t FROM orders_weekly),
g AS (SELECT series, g, count(*) AS n, sum(r) AS rs, var_samp(y) AS v, sum(t * t - 1) AS ties FROM m GROUP BY 1, 2),
s AS (SELECT series, CAST(sum(n) AS DOUBLE) AS nn, count(*) AS k, sum(rs * rs / n) AS rr, sum(ties) AS ties, sum((n - 1) * v) / sum(n - 1) AS pooled,
  sum((n - 1) * ln(v)) AS logs, sum(1.0::DOUBLE / (n - 1)) AS inv FROM g GROUP BY 1)
SELECT series, CAST(nn AS BIGINT) AS n_rows, k AS groups, round((12 / (nn * (nn + 1)) * rr - 3 * (nn + 1)) / (1 - ties / (nn * nn * nn - nn)), 4) AS kruskal_h,
  round(((nn - k) * ln(pooled) - logs) / (1 + (inv - 1 / (nn - k)) / (3 * (k - 1))), 4) AS bartlett FROM s""",
)(
    using(weekly_panel, lambda p: round_to(
        st.seasonality_tests(_by_month(p.df), ["series"], "y", "month", p_value=False), kruskal_h=4, bartlett=4
    )))
query("x05_seasonality_tests_with_p")(using(weekly_panel, lambda p: st.seasonality_tests(_by_month(p.df), ["series"], "y", "month")))


def _k2_sql(source: str) -> str:
    """Normality statistic of ``y`` per series from central moments."""
    return f"""mean AS (SELECT series, y, avg(y) OVER (PARTITION BY series) AS mu FROM {source} WHERE y IS NOT NULL),
mo AS (SELECT series, CAST(count(*) AS DOUBLE) AS n, avg(pow(y - mu, 2)) AS m2, avg(pow(y - mu, 3)) AS m3, avg(pow(y - mu, 4)) AS m4 FROM mean GROUP BY 1),
sk AS (SELECT series, n, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2 FROM mo),
a AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS yy,
  sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
  (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS q FROM sk),
b AS (SELECT *, ln(yy / sqrt(2 / (w2 - 1)) + sqrt(pow(yy / sqrt(2 / (w2 - 1)), 2) + 1)) / sqrt(0.5 * ln(w2)) AS z1,
  6 + 8 / q * (2 / q + sqrt(1 + 4 / (q * q))) AS g FROM a),
c AS (SELECT *, (1 - 2 / (9 * g) - cbrt((1 - 2 / g) / (1 + x * sqrt(2 / (g - 4))))) / sqrt(2 / (9 * g)) AS z2 FROM b),
k2 AS (SELECT series, CAST(n AS BIGINT) AS n, round(z1, 4) AS z_skew, round(z2, 4) AS z_kurtosis, round(z1 * z1 + z2 * z2, 4) AS k2 FROM c)"""


query("x06_normality", f"{SM[:-1]},\n{_k2_sql('supplier_monthly')} SELECT * FROM k2")(
    using(supplier_panel, lambda p: round_to(st.normality(p.df, ["series"], "y", p_value=False), z_skew=4, z_kurtosis=4, k2=4)))


def _standardised(spark, sf):
    from seriesloom.operators.cleaning import scaled

    return scaled(order_rows_df(spark, sf), ["series"], "y", "standard")


def _normal_sql(x: str) -> str:
    """The library's fit of the normal distribution function; ``x`` is a column."""
    t = f"(1 / (1 + abs({x}) / sqrt(2.0::DOUBLE) / 2))"
    power = f"{ds.ERFC[-1]}::DOUBLE"
    for c in reversed(ds.ERFC[:-1]):
        power = f"({c}::DOUBLE + {t} * {power})"
    tail = f"({t} * exp({power} - {x} * {x} / 2) / 2)"
    return f"CASE WHEN {x} > 0 THEN 1 - {tail} ELSE {tail} END"


query(
    "x07_distance_from_normal",
    f"""{with_(ORDER_ROWS)}, z AS (SELECT series, date, id, (y - avg(y) OVER (PARTITION BY series)) / stddev_pop(y) OVER (PARTITION BY series) AS z FROM order_rows),
f AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY z, date, id) AS i, count(*) OVER (PARTITION BY series) AS n, {_normal_sql('z')} AS f FROM z)
SELECT series, round(max(greatest(i / n - f, f - (i - 1) / n)), 5) AS ks_distance, CAST(max(n) AS BIGINT) AS n FROM f GROUP BY 1""",
)(
    lambda spark, sf: round_to(st.ks_normal(_standardised(spark, sf), ["series"], "y_standard", ["date", "id"], rows_per_task=2_000), ks_distance=5)
)
query(
    "x08_likely_distribution",
    f"""WITH e AS (SELECT event_type AS series, event_id, value AS x FROM events WHERE value IS NOT NULL),
m AS (SELECT series, count(*) AS n, avg(x) AS m, stddev_pop(x) AS s, min(x) AS lo, CASE WHEN min(x) > 0 THEN avg(ln(x)) FILTER (x > 0) END AS lm,
  stddev_pop(ln(CASE WHEN x > 0 THEN x END)) AS ls FROM e GROUP BY 1),
f AS (SELECT series, n, row_number() OVER (PARTITION BY series ORDER BY x, event_id) AS i, (x - m) / nullif(s, 0) AS zn,
  CASE WHEN lm IS NOT NULL THEN (ln(x) - lm) / nullif(ls, 0) END AS zl, 1 - exp(-(x - lo) / nullif(m - lo, 0)) AS fe FROM e JOIN m USING (series)),
g AS (SELECT *, {_normal_sql('zn')} AS fn, CASE WHEN zl IS NOT NULL THEN {_normal_sql('zl')} END AS fl FROM f),
d AS (SELECT series, 'norm' AS distribution, max(greatest(i / n - fn, fn - (i - 1) / n)) AS distance FROM g GROUP BY 1
  UNION ALL SELECT series, 'lognorm', max(greatest(i / n - fl, fl - (i - 1) / n)) FROM g WHERE fl IS NOT NULL GROUP BY 1
  UNION ALL SELECT series, 'expon', max(greatest(i / n - fe, fe - (i - 1) / n)) FROM g GROUP BY 1)
SELECT series, arg_min(distribution, (distance, distribution)) AS distribution, round(min(distance), 5) AS distance FROM d GROUP BY 1""",
)(
    lambda spark, sf: round_to(
        st.likely_distribution(table(spark, sf, "events").withColumnRenamed("event_type", "series"), ["series"], "value", ["event_id"]), distance=5
    )
)
_HURST = range(4, 20)
query(
    "x09_hurst",
    f"{SM}, d AS (SELECT series, " + ", ".join(f"y - lag(y, {k}) {over()} AS d{k}" for k in _HURST) + " FROM supplier_monthly), u AS ("
    + " UNION ALL ".join(f"SELECT series, ln({k}) AS l, ln(sqrt(nullif(stddev_pop(d{k}), 0))) AS t FROM d GROUP BY 1" for k in _HURST)
    + ") SELECT series, round(2 * regr_slope(t, l), 5) AS hurst FROM u GROUP BY 1",
)(using(supplier_panel, lambda p: round_to(st.hurst(p, "y"), hurst=5)))


def _spectrum_sql(base: str, source: str, order: str) -> str:
    return f"""{with_(base)}, t AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY {order}) AS t FROM {source}),
f AS (SELECT series, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, count(*) AS n FROM t GROUP BY 1),
e AS (SELECT series, n, t - 1 AS j, y - (a + b * t) AS e FROM t JOIN f USING (series)),
k AS (SELECT series, n, unnest(range(1, n // 2)) AS k FROM f),
s AS (SELECT k.series, k.n, k.k, 2.0::DOUBLE / k.n * sqrt(pow(sum(e * cos(2 * pi() * k * j / k.n)), 2) + pow(sum(e * sin(2 * pi() * k * j / k.n)), 2)) AS amp
  FROM k JOIN e ON e.series = k.series GROUP BY 1, 2, 3)
SELECT series, arg_max(k, amp) AS k, max(n) AS n, round(max(amp), 2) AS amplitude, round(CAST(max(n) AS DOUBLE) / arg_max(k, amp), 5) AS cycle FROM s GROUP BY 1"""


query("x10_dominant_cycle", _spectrum_sql(ORDERS_WEEKLY, "orders_weekly", "date"))(
    using(weekly_panel, lambda p: round_to(sp.dominant_cycle(p, "y"), amplitude=2, cycle=5)))


def _split_hourly(spark, sf):
    return Panel(events_hourly_df(spark, sf), ["series"], ["ts_hour"], rows_per_task=200)


query("x10_dominant_cycle_split", _spectrum_sql(EVENTS_HOURLY, "events_hourly", "ts_hour"))(
    lambda spark, sf: round_to(sp.dominant_cycle(_split_hourly(spark, sf), "y"), amplitude=2, cycle=5)
)
def _acf_sql(base: str, source: str, y: str, k: int, by: str) -> str:
    lags = ", ".join(f"sum(e * l{i}) AS s{i}" for i in range(k + 1))
    return (
        f"{base}m AS (SELECT *, {y} - avg({y}) OVER (PARTITION BY series) AS e FROM {source}), "
        f"l AS (SELECT series, e, {', '.join(f'lag(e, {i}) OVER ({by}) AS l{i}' for i in range(k + 1))} FROM m), "
        f"s AS (SELECT series, {lags} FROM l GROUP BY 1) "
        + " UNION ALL ".join(f"SELECT series, {i} AS lag, round(s{i} / nullif(s0, 0), 5) AS acf FROM s" for i in range(k + 1))
    )


query("x11_autocorrelation", _acf_sql(f"{SM[:-1]}, ", "supplier_monthly", "y", 12, "PARTITION BY series ORDER BY date"))(
    using(supplier_panel, lambda p: round_to(st.autocorrelation(p, "y", 12), acf=5)))
query("x11_autocorrelation_rows", _acf_sql(f"{with_(ORDER_ROWS)[:-1]}, ", "order_rows", "y", 5, "PARTITION BY series ORDER BY date, id"))(
    lambda spark, sf: round_to(st.autocorrelation(order_rows(spark, sf), "y", 5), acf=5)
)
query(
    "x12_partial_autocorrelation",
    f"""{SM}, m AS (SELECT *, y - avg(y) OVER (PARTITION BY series) AS e FROM supplier_monthly),
l AS (SELECT series, e, lag(e) {over()} AS l1, lag(e, 2) {over()} AS l2 FROM m),
r AS (SELECT series, sum(e * l1) / sum(e * e) AS r1, sum(e * l2) / sum(e * e) AS r2 FROM l GROUP BY 1)
SELECT series, 0 AS lag, 1.0::DOUBLE AS pacf FROM r UNION ALL SELECT series, 1, round(r1, 5) FROM r
UNION ALL SELECT series, 2, round((r2 - r1 * r1) / (1 - r1 * r1), 5) FROM r""",
)(using(supplier_panel, lambda p: round_to(st.partial_autocorrelation(p, "y", 2), pacf=5)))
query(
    "x13_decompose",
    f"""{SM}, t AS (SELECT *, (row_number() {over()} - 1) % 12 AS ph FROM supplier_monthly),
c AS (SELECT *, CASE WHEN count(y) {over('ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING')} = 13 THEN
  (sum(y) {over('ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING')} - (lag(y, 6) {over()} + lead(y, 6) {over()}) / 2) / 12 END AS trend FROM t),
p AS (SELECT series, ph, avg(y - trend) AS pm FROM c GROUP BY 1, 2), q AS (SELECT series, ph, pm - avg(pm) OVER (PARTITION BY series) AS seasonal FROM p)
SELECT series, date, y, round(trend, 4) AS trend, round(y - trend, 4) AS detrended, round(seasonal, 4) AS seasonal,
  round(y - trend - seasonal, 4) AS resid, round(y - seasonal, 4) AS deseasonalised FROM c JOIN q USING (series, ph)""",
)(
    using(supplier_panel, lambda p: round_to(
        st.decompose(p, "y", 12).df.drop("rev", "disc"),
        trend=4, detrended=4, seasonal=4, resid=4, deseasonalised=4,
    )))


def _unit_root(spark, sf):
    got = st.unit_root_test(supplier_monthly(spark, sf), "y", 0)
    return round_to(got, statistic=4, crit_1=4, crit_5=4, crit_10=4)


query(
    "x14_unit_root",
    f"""{SM}, l AS (SELECT series, lag(y) {over()} AS x, y - lag(y) {over()} AS d FROM supplier_monthly),
f AS (SELECT series, regr_slope(d, x) AS b, regr_r2(d, x) AS r2, regr_syy(d, x) AS syy, regr_sxx(d, x) AS sxx, CAST(regr_count(d, x) AS DOUBLE) AS n FROM l GROUP BY 1),
s AS (SELECT series, n, b / sqrt((1 - r2) * syy / (n - 2) / sxx) AS t, -3.43035 - 6.5393 / n - 16.786 / (n * n) - 79.433 / (n * n * n) AS c1,
  -2.86154 - 2.8903 / n - 4.234 / (n * n) - 40.04 / (n * n * n) AS c5, -2.56677 - 1.5384 / n - 2.809 / (n * n) AS c10 FROM f)
SELECT series, CAST(n AS BIGINT) AS n, round(t, 4) AS statistic, round(c1, 4) AS crit_1, round(c5, 4) AS crit_5, round(c10, 4) AS crit_10, t < c5 AS stationary FROM s""",
)(_unit_root)
query("x14_unit_root_lagged")(using(supplier_panel, lambda p: st.unit_root_test(p, "y", 2)))
query("x15_granger")(using(supplier_panel, lambda p: st.granger(p, "y", "rev", 3)))
query(
    "x15_granger_one_lag",
    f"""{SM}, l AS (SELECT series, y, lag(y) {over()} AS a, lag(rev) {over()} AS b FROM supplier_monthly),
c AS (SELECT series, count(*) AS n, corr(y, a) AS ra, corr(y, b) AS rb, corr(a, b) AS rab, regr_syy(y, a) AS syy FROM l WHERE a IS NOT NULL GROUP BY 1),
r AS (SELECT series, n, syy * (1 - ra * ra) AS r0, syy * (1 - (ra * ra + rb * rb - 2 * ra * rb * rab) / (1 - rab * rab)) AS r1 FROM c)
SELECT series, 1 AS lag, n, round((r0 - r1) / (r1 / (n - 3)), 4) AS f, n - 3 AS free FROM r""",
)(using(supplier_panel, lambda p: round_to(st.granger(p, "y", "rev", 1, p_value=False), f=4)))
query(
    "x16_linear_fit",
    f"""{SM}SELECT series, round(regr_slope(y, rev), 8) AS slope, round(regr_intercept(y, rev), 4) AS intercept,
  round(regr_syy(y, rev) * (1 - regr_r2(y, rev)), 2) AS rss, count(*) AS n FROM supplier_monthly GROUP BY 1""",
)(
    using(supplier_panel, lambda p: round_to(
        rg.least_squares(p.df, ["series"], ["rev"], "y").select(
            "series", F.col("fit.coefficients")[0].alias("slope"), F.col("fit.intercept").alias("intercept"), F.col("fit.rss").alias("rss"), F.col("fit.n").alias("n")
        ),
        slope=8, intercept=4, rss=2,
    )))
query(
    "x17_coefficient_significance",
    f"""{SM}, f AS (SELECT series, regr_slope(y, rev) AS b, sqrt((1 - regr_r2(y, rev)) * regr_syy(y, rev) / (count(*) - 2) / regr_sxx(y, rev)) AS se FROM supplier_monthly GROUP BY 1)
SELECT series, 'rev' AS feature, round(b, 8) AS coefficient, round(b - 1.96::DOUBLE * se, 8) AS lower, round(b + 1.96::DOUBLE * se, 8) AS upper,
  CASE WHEN b - 1.96::DOUBLE * se < 0 AND b + 1.96::DOUBLE * se > 0 THEN 'not significant' ELSE 'significant' END AS significance FROM f""",
)(
    using(supplier_panel, lambda p: round_to(
        rg.coefficient_table(rg.least_squares(p.df, ["series"], ["rev"], "y"), ["series"], ["rev"]),
        coefficient=8, lower=8, upper=8,
    )))


def _residuals(spark, sf):
    p = ft.detrended(supplier_panel(spark, sf), "y", "residual")
    return p.with_df(p.df.select("series", "date", "residual"))


_RESIDUALS = f"""{SM}, t AS (SELECT *, row_number() {over()} AS t FROM supplier_monthly),
f AS (SELECT series, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM t GROUP BY 1),
res AS (SELECT series, date, y - (a + b * t) AS y FROM t JOIN f USING (series))"""
query("x18_residual_normality", f"{_RESIDUALS}, {_k2_sql('res').replace('a AS (SELECT *, g1', 'a2 AS (SELECT *, g1').replace('FROM a)', 'FROM a2)')} SELECT * FROM k2")(
    lambda spark, sf: round_to(st.normality(_residuals(spark, sf).df, ["series"], "residual", p_value=False), z_skew=4, z_kurtosis=4, k2=4)
)
query("x18_residual_autocorrelation", _acf_sql(f"{_RESIDUALS}, ", "res", "y", 6, "PARTITION BY series ORDER BY date"))(
    lambda spark, sf: round_to(st.autocorrelation(_residuals(spark, sf), "residual", 6), acf=5)
)

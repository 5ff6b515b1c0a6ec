"""Window features: W rows of the inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.catalog.base import (
    BY_DATE, OHLC_DAILY, ORDER_ROWS, ORDERS_WEEKLY, SUPPLIER_MONTHLY, ohlc_daily, order_rows, orders_weekly, over, query,
    round_half_up, rounded, sql_before, sql_bfill, sql_div, sql_ffill, sql_upto, supplier_monthly, supplier_panel, using, with_,
)
from seriesloom.operators import features as ft
from seriesloom.plans import config

KEY = ["series", "date"]
ROWKEY = ["series", "date", "id"]
BY_ROW = "PARTITION BY series ORDER BY date, id"


def _sm(ctes: str, select: str) -> str:
    return f"{with_(SUPPLIER_MONTHLY, *([ctes] if ctes else []))}{select}"


def _simple(feature_list, digits=4, panel=supplier_monthly, fill="bfill", leading=True, key=KEY):
    def run(spark, sf):
        names = [n for f in feature_list for n in f.names]
        return rounded(ft.add_features(panel(spark, sf), feature_list, fill=fill, leading=leading).df, key, names, digits)

    return run


def _filled_sql(cols: dict[str, str], digits: int = 4, by: str = BY_DATE, source: str = "supplier_monthly", base=SUPPLIER_MONTHLY, key="series, date") -> str:
    """Raw columns in one step, back-filled in the next."""
    raw = ", ".join(f"{e} AS {n}" for n, e in cols.items())
    out = ", ".join(f"round({sql_bfill(n, by)}, {digits}) AS {n}" for n in cols)
    return f"{with_(base, f'raw AS (SELECT *, {raw} FROM {source})')}SELECT {key}, {out} FROM raw"


query("w01_lags", _filled_sql({f"y_lag_{n}": f"lag(y, {n}) {over()}" for n in (1, 2, 6)}))(
    _simple([ft.lag("y", n) for n in (1, 2, 6)])
)

query(
    "w02_lag_matrix",
    _sm("", f"SELECT series, date, y, {', '.join(f'lag(rev, {i}) {over()} AS rev_lag_{i}' for i in range(1, 6))} FROM supplier_monthly"),
)(
    using(supplier_monthly, lambda p: ft.add_features(p, [ft.lag("rev", i) for i in range(1, 6)], fill=None).df.select(
        "series", "date", "y", *[f"rev_lag_{i}" for i in range(1, 6)]
    )))

query("w03_moving_average", _filled_sql({f"y_sma_{n}": sql_before("avg", "y", n) for n in (3, 12)}))(
    _simple([ft.moving_average("y", n) for n in (3, 12)])
)
query("w04_moving_max", _filled_sql({f"y_mm_{n}": sql_before("max", "y", n) for n in (3, 12)}))(
    _simple([ft.moving_max("y", n) for n in (3, 12)])
)
query("w05_moving_sum", _filled_sql({f"y_ms_{n}": sql_before("sum", "y", n) for n in (3, 12)}))(
    _simple([ft.moving_sum("y", n) for n in (3, 12)])
)

query(
    "w06_value_to_average",
    _sm(
        f"raw AS (SELECT *, {sql_before('avg', 'y', 4)} AS a FROM supplier_monthly)",
        f"SELECT series, date, round({sql_div('y', sql_bfill('a'))}, 4) AS comparison_y_sma_4 FROM raw",
    ),
)(_simple([ft.to_moving_average("y", 4)]))

query(
    "w07_lag_ratio",
    _sm(
        f"raw AS (SELECT *, lag(y, 4) {over()} AS a, lag(y, 5) {over()} AS b FROM supplier_monthly)",
        f"SELECT series, date, round(100 * {sql_div(sql_bfill('a'), sql_bfill('b'))}, 4) AS comparison_y_shift_4_5 FROM raw",
    ),
)(_simple([ft.lag_ratio("y", 4, 5)]))


def _ratio_sql(agg: str, name: str) -> str:
    return _sm(
        f"raw AS (SELECT *, {sql_before(agg, 'y', 6, 3)} AS a, {sql_before(agg, 'y', 12, 3)} AS b FROM supplier_monthly),\n"
        f"r AS (SELECT series, date, 100 * {sql_div(sql_bfill('a'), sql_bfill('b'))} AS v FROM raw),\n"
        f"f AS (SELECT series, date, {sql_bfill('v')} AS v FROM r)",
        f"SELECT series, date, round({sql_ffill('v')}, 4) AS {name} FROM f",
    )


query("w08_moving_sum_ratio", _ratio_sql("sum", "comparison_y_ms_6_12"))(_simple([ft.moving_sum_ratio("y", 6, 12)]))
query("w09_moving_average_ratio", _ratio_sql("avg", "comparison_y_sma_6_12"))(_simple([ft.moving_average_ratio("y", 6, 12)]))

query("w10_spread_lag", _filled_sql({"y_vs_disc_lag_6": f"lag(y - disc, 6) {over()}"}))(
    _simple([ft.spread("y", "disc", 6, "y_vs_disc")])
)
query("w11_band_spread", _filled_sql({f"bband_spread_{n}": f"4 * {sql_before('stddev_samp', 'y', n).replace('CASE', '(CASE')})" for n in (8, 20)}))(
    _simple([ft.band_spread("y", n) for n in (8, 20)])
)
query(
    "w12_band_lines",
    _sm(
        f"raw AS (SELECT *, {sql_before('avg', 'y', 8)} AS m, {sql_before('stddev_samp', 'y', 8)} AS s FROM supplier_monthly)",
        """SELECT series, date, round(m, 4) AS middle_bband_8, round(m + 2 * s, 4) AS upper_bband_8,
  round(m - 2 * s, 4) AS lower_bband_8, round(4 * s, 4) AS bband_spread_8 FROM raw""",
    ),
)(_simple([ft.band_lines("y", 8)], fill=None))

_CHANGES = f"""d AS (SELECT *, y - lag(y) {over()} AS d FROM supplier_monthly),
g AS (SELECT *, CASE WHEN d IS NOT NULL THEN greatest(d, 0) END AS gain, CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END AS loss FROM d)"""

_RSI_FRAME = over("ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING")
query(
    "w13_strength_index",
    _sm(
        f"{_CHANGES},\nr AS (SELECT series, date, 100 - 100 / (1 + avg(gain) {_RSI_FRAME} / nullif(avg(loss) {_RSI_FRAME}, 0)) AS v FROM g)",
        f"SELECT series, date, round({sql_bfill('v')}, 4) AS rsi_14 FROM r",
    ),
)(_simple([ft.strength_index("y", 14)], leading=False))

_RSI_IN = over("ROWS BETWEEN 13 PRECEDING AND CURRENT ROW")
query(
    "w14_strength_index_inclusive",
    _sm(
        f"{_CHANGES},\nr AS (SELECT series, date, avg(coalesce(gain, 0)) {_RSI_IN} AS g, avg(coalesce(loss, 0)) {_RSI_IN} AS l FROM g)",
        """SELECT series, date, round(CASE WHEN l = 0 AND g > 0 THEN 100 ELSE 100 - 100 / (1 + g / nullif(l, 0)) END, 4) AS rsi_incl_14
FROM r""",
    ),
)(_simple([ft.strength_index_inclusive("y", 14)], fill=None))


def _ema_sql(source: str, x: str, span: int, by: str) -> str:
    a = 2.0 / (span + 1)
    return f"""rn AS (SELECT series, date, {x} AS x, row_number() OVER ({by}) AS i FROM {source}),
e AS (
  SELECT series, date, i, x AS e FROM rn WHERE i = 1
  UNION ALL
  SELECT rn.series, rn.date, rn.i, (1 - CAST({a!r} AS DOUBLE)) * e.e + CAST({a!r} AS DOUBLE) * rn.x
  FROM e JOIN rn ON rn.series = e.series AND rn.i = e.i + 1)"""


query(
    "w15_strength_index_smoothed",
    "WITH RECURSIVE " + SUPPLIER_MONTHLY + f""",
{_CHANGES},
rn AS (SELECT series, date, gain, loss, row_number() {over()} AS i FROM g),
e AS (
  SELECT series, date, i, gain AS u, loss AS l FROM rn WHERE i = 2
  UNION ALL
  SELECT rn.series, rn.date, rn.i, e.u + (rn.gain - e.u) / 14, e.l + (rn.loss - e.l) / 14
  FROM e JOIN rn ON rn.series = e.series AND rn.i = e.i + 1)
SELECT rn.series, rn.date,
  round(CASE WHEN l = 0 AND u > 0 THEN 100 ELSE 100 - 100 / (1 + u / nullif(l, 0)) END, 4) AS rsi_wilder_14
FROM rn LEFT JOIN e ON rn.series = e.series AND rn.i = e.i""",
)(using(supplier_monthly, lambda p: rounded(ft.strength_index_smoothed(p, "y", 14).df, KEY, ["rsi_wilder_14"])))


def _runs_sql(source: str, base: str, by: str, key: str) -> str:
    return f"""{with_(base)[:-1]},
u AS (SELECT *, CAST(coalesce(y > lag(y) OVER ({by}), false) AS BIGINT) AS up FROM {source}),
c AS (SELECT *, sum(1 - up) OVER ({by} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) > 2 AS idle FROM u),
t AS (SELECT *, CASE WHEN idle IS NOT DISTINCT FROM lag(idle) OVER ({by}) THEN 0 ELSE 1 END AS turn FROM c),
r AS (SELECT *, sum(turn) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM t)
SELECT {key}, CAST(sum(up) OVER ({by.replace('PARTITION BY series', 'PARTITION BY series, run')}
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS consecutive_increases_2 FROM r"""


query("w16_increase_runs", _runs_sql("supplier_monthly", SUPPLIER_MONTHLY, BY_DATE, "series, date"))(
    using(supplier_monthly, lambda p: ft.increase_runs(p, "y", 2).df.select("series", "date", "consecutive_increases_2")))
query("w16_increase_runs_rows", _runs_sql("order_rows", ORDER_ROWS, BY_ROW, "series, date, id"))(
    lambda spark, sf: ft.increase_runs(order_rows(spark, sf), "y", 2).df.select("series", "date", "id", "consecutive_increases_2")
)

_SMOOTH = """s AS (SELECT series, date, {key}lag({x}, 3) OVER ({by}) AS x, row_number() OVER ({by}) AS i FROM {src}),
e AS (
  SELECT a.series, a.date, {akey}a.i,
         sum(b.x * pow(CAST(0.891 AS DOUBLE), a.i - b.i)) / sum(CASE WHEN b.x IS NOT NULL THEN pow(CAST(0.891 AS DOUBLE), a.i - b.i) END) AS v
  FROM s a JOIN s b ON a.series = b.series AND b.i <= a.i {near}
  GROUP BY ALL),
f AS (SELECT *, {bfill} AS w FROM e)
SELECT series, date, {key}round({ffill}, 3) AS smooth_3 FROM f"""
query(
    "w17_smoothed_lag",
    with_(SUPPLIER_MONTHLY)[:-1]
    + ",\n"
    + _SMOOTH.format(key="", akey="", x="y", by=BY_DATE, src="supplier_monthly", near="", bfill=sql_bfill("v"), ffill=sql_ffill("w")),
)(using(supplier_monthly, lambda p: rounded(ft.smoothed(p, "y", "smooth_3", 3).df, KEY, ["smooth_3"], 3)))

query(
    "w18_recursive_average",
    "WITH RECURSIVE " + SUPPLIER_MONTHLY + ",\n" + _ema_sql("supplier_monthly", "y", 12, BY_DATE) + "\nSELECT series, date, round(e, 4) AS y_ema_12 FROM e",
)(using(supplier_monthly, lambda p: rounded(ft.span_average(p, "y", 12).df, KEY, ["y_ema_12"])))

query(
    "w18_recursive_average_rows",
    "WITH RECURSIVE "
    + ORDER_ROWS
    + f""",
rn AS (SELECT series, date, id, y AS x, row_number() OVER ({BY_ROW}) AS i FROM order_rows),
e AS (
  SELECT series, date, id, i, x AS e FROM rn WHERE i = 1
  UNION ALL
  SELECT rn.series, rn.date, rn.id, rn.i, (1 - CAST({2.0 / 27!r} AS DOUBLE)) * e.e + CAST({2.0 / 27!r} AS DOUBLE) * rn.x
  FROM e JOIN rn ON rn.series = e.series AND rn.i = e.i + 1)
SELECT series, date, id, round(e, 3) AS y_ema_26 FROM e""",
)(lambda spark, sf: rounded(ft.span_average(order_rows(spark, sf), "y", 26).df, ROWKEY, ["y_ema_26"], 3))

query(
    "w19_detrended",
    _sm(
        f"t AS (SELECT *, row_number() {over()} AS t FROM supplier_monthly),\n"
        "f AS (SELECT series, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM t GROUP BY series)",
        "SELECT series, date, round(y - (a + b * t), 4) AS y_detrended FROM t JOIN f USING (series)",
    ),
)(using(supplier_panel, lambda p: rounded(ft.detrended(p, "y").df, KEY, ["y_detrended"])))
query(
    "w19_detrended_rows",
    f"""{with_(ORDER_ROWS, f"t AS (SELECT *, row_number() OVER ({BY_ROW}) AS t FROM order_rows)",
    "f AS (SELECT series, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM t GROUP BY series)")}
SELECT series, date, id, round(y - (a + b * t), 2) AS y_detrended FROM t JOIN f USING (series)""",
)(lambda spark, sf: rounded(ft.detrended(order_rows(spark, sf), "y").df, ROWKEY, ["y_detrended"], 2))


def _shifted(agg: str) -> str:
    f = over("ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING")
    return _sm("", f"SELECT series, date, round(CASE WHEN count(y) {f} >= 4 THEN {agg.format(f=f)} END, 4) AS v FROM supplier_monthly")


query("w20_shifted_mean", _shifted("avg(y) {f}"))(_simple([ft.shifted_window("y", 2, 5, "v")], fill=None))
query("w21_shifted_deviation", _shifted("stddev_samp(y) {f}"))(_simple([ft.shifted_window("y", 2, 5, "v", F.stddev_samp)], fill=None))
query("w22_shifted_quantile", _shifted("quantile_cont(y, 0.75) {f}"))(_simple([ft.shifted_quantile("y", 2, 5, 0.75, "v")], fill=None))

query(
    "w23_returns",
    _sm(
        f"""r AS (SELECT *, ln(y / lag(y) {over()}) AS r, {sql_upto('stddev_samp', 'y', 12)} AS sd, {sql_upto('avg', 'y', 12)} AS m
  FROM supplier_monthly)""",
        f"""SELECT series, date, round(r, 6) AS y_log_return, round(abs(r), 6) AS y_abs_return,
  round({sql_upto('stddev_samp', 'r', 12)}, 6) AS y_volatility_12, round(sd, 4) AS y_std_12, round(m, 4) AS y_avg_12,
  round(sd / nullif(m, 0), 6) AS y_cv_12 FROM r""",
    ),
)(
    using(supplier_monthly, lambda p: ft.add_features(p, [ft.returns("y", 12)], fill=None).df.select(
        *KEY,
        *[round_half_up(f"y_{x}", 6).alias(f"y_{x}") for x in ("log_return", "abs_return", "volatility_12", "cv_12")],
        *[round_half_up(f"y_{x}", 4).alias(f"y_{x}") for x in ("std_12", "avg_12")],
    )))
query(
    "w24_price_range",
    f"""{with_(OHLC_DAILY, f"r AS (SELECT *, {sql_before('max', 'close', 12, 2)} AS hi, {sql_before('min', 'close', 12, 2)} AS lo FROM ohlc_daily)")}
SELECT series, date, hi AS close_rmax_12, lo AS close_rmin_12, hi - lo AS close_amplitude_12,
  hi - lo - lag(hi - lo) {over()} AS close_amplitude_diff_12 FROM r""",
)(_simple([ft.price_range("close")], panel=ohlc_daily, fill=None))
query(
    "w25_stochastic",
    f"""{with_(OHLC_DAILY, f"r AS (SELECT *, {sql_upto('min', 'low', 14)} AS lo, {sql_upto('max', 'high', 14)} AS hi FROM ohlc_daily)",
    "k AS (SELECT series, date, 100 * (close - lo) / nullif(hi - lo, 0) AS k FROM r)")}
SELECT series, date, round(k, 4) AS stoch_k_14, round({sql_upto('avg', 'k', 3)}, 4) AS stoch_d_3 FROM k""",
)(_simple([ft.stochastic("low", "high", "close")], panel=ohlc_daily, fill=None))
query(
    "w26_differences",
    _sm("", f"SELECT series, date, y - lag(y) {over()} AS y_diff_1, y - lag(y, 12) {over()} AS y_diff_12 FROM supplier_monthly"),
)(_simple([ft.differences("y")], fill=None))
query(
    "w27_short_volatility",
    _sm("", f"SELECT series, date, round(stddev_samp(y) {over('ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING')}, 4) AS y_vol_3 FROM supplier_monthly"),
)(_simple([ft.short_volatility("y")], fill=None))
query(
    "w28_trailing_max",
    f"{with_(ORDERS_WEEKLY)}SELECT series, date, max(y) {over('ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING')} AS cum_max FROM orders_weekly",
)(_simple([ft.trailing_max("y")], panel=orders_weekly, fill=None))

_PACK = {"rev": [1, 3, 5], "disc": [2, 4]}
query(
    "w29_lag_pack",
    _sm(
        "p AS (SELECT series, date, y, "
        + ", ".join(f"lag({c}, {n}) {over()} AS {c}_lag_{n}" for c, ns in _PACK.items() for n in ns)
        + " FROM supplier_monthly)",
        "SELECT * FROM p WHERE " + " AND ".join(f"{c}_lag_{n} IS NOT NULL" for c, ns in _PACK.items() for n in ns),
    ),
)(using(supplier_monthly, lambda p: config.lag_pack(p, _PACK, keep=["series", "date", "y"]).df))

# The two ready feature sets.
_FLAVOR_COLS = {
    "y_lag_1": f"lag(y, 1) {over()}", "y_lag_2": f"lag(y, 2) {over()}",
    "y_sma_3": sql_before("avg", "y", 3), "y_sma_12": sql_before("avg", "y", 12), "y_ms_3": sql_before("sum", "y", 3),
    "a": f"lag(y, 4) {over()}", "b": f"lag(y, 5) {over()}",
    "bband_spread_8": f"4 * ({sql_before('stddev_samp', 'y', 8)})", "bband_spread_20": f"4 * ({sql_before('stddev_samp', 'y', 20)})",
}


def _flavor_sql(base: str, source: str, cols: dict[str, str], extra: dict[str, str], digits: int) -> str:
    raw = ", ".join(f"{e} AS {n}" for n, e in cols.items())
    plain = [n for n in cols if n not in ("a", "b")]
    out = ", ".join(f"round({sql_bfill(n)}, {digits}) AS {n}" for n in plain)
    tail = "".join(f", {e} AS {n}" for n, e in extra.items())
    return f"{with_(base, f'raw AS (SELECT *, {raw} FROM {source})')}SELECT series, date, {out}{tail} FROM raw"


_RATIO = {"comparison_y_shift_4_5": f"round(100 * {sql_div(sql_bfill('a'), sql_bfill('b'))}, 4)"}


def _feature_set(spark, sf, panel, flavor, digits):
    p = config.build(panel(spark, sf), flavor, leading=True)
    names = config.output_names(flavor)
    d = {n: 4 if n.startswith("comparison") else digits for n in names}
    return p.df.select(*KEY, *[round_half_up(n, d[n]).alias(n) for n in names])


query("w30_feature_set", _flavor_sql(ORDERS_WEEKLY, "orders_weekly", _FLAVOR_COLS, _RATIO, 2))(
    lambda spark, sf: _feature_set(spark, sf, orders_weekly, config.ENDOGENOUS, 2)
)
_MIX_COLS = {
    **{n: e for n, e in _FLAVOR_COLS.items() if n != "y_ms_3"},
    "y_vs_disc_lag_6": f"lag(y - disc, 6) {over()}", "rev_lag_6": f"lag(rev, 6) {over()}", "disc_lag_3": f"lag(disc, 3) {over()}",
    "disc_lag_14": f"lag(disc, 14) {over()}", "rev_sma_12": sql_before("avg", "rev", 12),
}
MIX = config.FeatureSet(
    target="y", lags=(1, 2), averages=(3, 12), lag_ratios=((4, 5),), bands=(8, 20),
    spreads={"y_vs_disc": ("y", "disc")}, exog_lags={"rev": (6,), "disc": (3, 14)}, exog_averages={"rev": (12,)},
)
query("w30_feature_set_mixed", _flavor_sql(SUPPLIER_MONTHLY, "supplier_monthly", _MIX_COLS, _RATIO, 2))(
    lambda spark, sf: _feature_set(spark, sf, supplier_monthly, MIX, 2)
)

_ROW_COLS = {
    "y_lag_2": f"lag(y, 2) OVER ({BY_ROW})", "y_sma_12": sql_before("avg", "y", 12, by=BY_ROW),
    "y_mm_20": sql_before("max", "y", 20, by=BY_ROW),
}
query("w30_feature_set_rows", _filled_sql(_ROW_COLS, 4, BY_ROW, "order_rows", ORDER_ROWS, "series, date, id"))(
    _simple([ft.lag("y", 2), ft.moving_average("y", 12), ft.moving_max("y", 20)], panel=order_rows, key=ROWKEY)
)
query(
    "w31_named_features",
    _filled_sql({"y_lag_1": f"lag(y, 1) {over()}", "y_lag_2": f"lag(y, 2) {over()}", "y_ma_3": sql_before("avg", "y", 3)}),
)(
    using(supplier_monthly, lambda p: rounded(
        config.from_names(p, "y", ["y_lag_1", "y_lag_2", "y_ma_3"]).df, KEY, ["y_lag_1", "y_lag_2", "y_ma_3"]
    )))
query(
    "w32_crossover_averages",
    f"{with_(ORDERS_WEEKLY)}SELECT series, date, y, round({sql_upto('avg', 'y', 7)}, 2) AS sma_7, round({sql_upto('avg', 'y', 30)}, 2) AS sma_30 FROM orders_weekly",
)(
    using(orders_weekly, lambda p: rounded(
        ft.add_features(p, [ft.crossover_averages("y", 7, 30)], fill=None).df,
        [*KEY, "y"], ["sma_7", "sma_30"], 2,
    )))

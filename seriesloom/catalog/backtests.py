"""Folds and deterministic forecasts: B rows and the exact F rows of the inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.catalog.base import (
    supplier_panel, using, weekly_panel,
    OHLC_DAILY, ORDERS_WEEKLY, SUPPLIER_MONTHLY, ohlc_daily, orders_weekly, over, query, round_half_up, round_to,
    supplier_monthly, with_,
)
from seriesloom.operators import folds as fd
from seriesloom.operators import forecast as fc
from seriesloom.plans import config

OW, SM = with_(ORDERS_WEEKLY), with_(SUPPLIER_MONTHLY)
_OW_POS = f"pos AS (SELECT *, row_number() {over()} - 1 AS row_no FROM orders_weekly), sz AS (SELECT series, count(*) AS n_rows, max(date) AS last FROM orders_weekly GROUP BY 1)"
_SM_POS = _OW_POS.replace("orders_weekly", "supplier_monthly")

_EXPANDING = f"""{_OW_POS},
st AS (SELECT pos.series, n_rows, last, row_no AS r0, unnest(range(row_no, n_rows, 4)) AS s FROM pos JOIN sz USING (series) WHERE date = DATE '2000-12-01'),
c AS (SELECT st.series, n_rows, last, s, (s - r0) // 4 + 1 AS fold, date + 42 AS reach FROM st JOIN pos ON pos.series = st.series AND pos.row_no = s),
stop AS (SELECT series, min(fold) AS stop FROM c WHERE fold > 1 AND reach >= last GROUP BY 1),
f AS (SELECT c.series, CAST(fold AS INTEGER) AS fold, s AS train_end, s AS test_start,
  CASE WHEN fold > 1 AND reach > last THEN n_rows ELSE least(s + 6, n_rows) END AS test_end
  FROM c LEFT JOIN stop USING (series) WHERE stop IS NULL OR fold <= stop)"""


def _expanding(p):
    return fd.expanding_folds(p, "date", "2000-12-01", 6, 4)


query("b01_expanding_folds", f"{OW[:-1]},\n{_EXPANDING} SELECT * FROM f")(using(weekly_panel, _expanding))
query(
    "b01_expanding_fold_rows",
    f"""{OW[:-1]},\n{_EXPANDING} SELECT pos.*, fold, CASE WHEN row_no < train_end THEN 'train' ELSE 'test' END AS part
FROM f JOIN pos ON pos.series = f.series AND row_no < test_end""",
)(using(weekly_panel, lambda p: fd.fold_rows(p, _expanding(p))))
query(
    "b02_calendar_folds",
    f"""{with_(OHLC_DAILY)}, m AS (SELECT series, max(date) AS last FROM ohlc_daily GROUP BY 1),
k AS (SELECT series, CAST(fold AS INTEGER) AS fold, last - CAST(10 * (4 - fold) AS INTEGER) AS cut FROM m, (SELECT unnest(range(0, 5)) AS fold)),
r AS (SELECT k.series, k.fold, d.date, d.close, row_number() OVER (PARTITION BY k.series, k.fold ORDER BY d.date DESC) AS back
  FROM k JOIN ohlc_daily d ON d.series = k.series AND d.date <= k.cut)
SELECT series, fold, date, close FROM r WHERE back <= 8""",
)(
    lambda spark, sf: fd.test_rows(
        ohlc_daily(spark, sf), fd.calendar_folds(ohlc_daily(spark, sf), "date", 4, 10, 10)
    ).select("series", "fold", "date", "close")
)
query(
    "b03_tail_split",
    f"""{SM}SELECT series, date, y, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY date DESC) <= 6 THEN 'test' ELSE 'train' END AS part
FROM supplier_monthly""",
)(
    using(supplier_panel, lambda p: fd.fold_rows(p, fd.tail_split(p, "date", 6)).select(
        "series", "date", "y", "part"
    )))
query(
    "b04_growing_folds",
    f"""{SM[:-1]},\n{_SM_POS}, f AS (SELECT series, CAST(unnest(range(0, (n_rows - 36 - 6) // 6)) AS INTEGER) AS fold FROM sz)
SELECT f.series, fold, date, y FROM f JOIN pos ON pos.series = f.series AND row_no >= 36 + fold * 6 AND row_no < 36 + fold * 6 + 12""",
)(
    using(supplier_panel, lambda p: fd.test_rows(
        p, fd.growing_folds(p, "date", 36, 6, 12)
    ).select("series", "fold", "date", "y")))
query(
    "b05_end_anchored_folds",
    f"""{SM[:-1]},\n{_SM_POS}, f AS (SELECT series, n_rows AS n, CAST(unnest(range(0, 5)) AS INTEGER) AS fold FROM sz WHERE n_rows > 30)
SELECT series, fold, n - (5 - fold) * 6 AS train_end, n - (5 - fold) * 6 AS test_start, n - (4 - fold) * 6 AS test_end FROM f""",
)(using(supplier_panel, lambda p: fd.end_anchored_folds(p, "date", 5, 6)))
query("b06_row_from_end", f"{SM}SELECT * FROM supplier_monthly QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) = 3")(
    using(supplier_panel, lambda p: fd.row_from_end(p, 3)))

# -- forecasts with exact answers ----------------------------------------------------------------

query(
    "f01_seasonal_naive",
    f"""{SM}, r AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
s AS (SELECT unnest(range(1, 19)) AS step)
SELECT series, CAST(step AS INTEGER) AS step, y AS prediction FROM s JOIN r ON back = 12 - (step - 1) % 12
WHERE series IN (SELECT series FROM r WHERE back = 12)""",
)(using(supplier_panel, lambda p: fc.seasonal_naive(p, "y", 12, 18)))
query("f01_seasonal_fitted", f"{SM}SELECT series, date, lag(y, 12) {over()} AS fitted FROM supplier_monthly")(
    using(supplier_panel, lambda p: fc.seasonal_fitted(p, "y", 12).df.select("series", "date", "fitted")))

FS = config.FeatureSet(target="y", lags=(1, 2), averages=(3,))
RICH = config.FeatureSet(
    target="y", lags=(1, 12), averages=(3, 12), sums=(3,), lag_ratios=((4, 5),), sum_ratios=((6, 12),), average_ratios=((6, 12),),
    bands=(8,), strength=(14,), trailing_max=True,
)
_LAST = lambda n: over(f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")
_RICH_SQL = f"""{SM}, d AS (SELECT *, y - lag(y) {over()} AS d, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
x AS (SELECT series, back, y AS y_lag_1, lag(y, 11) {over()} AS y_lag_12, avg(y) {_LAST(3)} AS y_sma_3, avg(y) {_LAST(12)} AS y_sma_12,
  sum(y) {_LAST(3)} AS y_ms_3, 100 * lag(y, 3) {over()} / nullif(lag(y, 4) {over()}, 0) AS comparison_y_shift_4_5,
  100 * sum(y) {_LAST(6)} / sum(y) {_LAST(12)} AS comparison_y_ms_6_12, 100 * avg(y) {_LAST(6)} / avg(y) {_LAST(12)} AS comparison_y_sma_6_12,
  4 * stddev_samp(y) {_LAST(8)} AS bband_spread_8,
  100 - 100 / (1 + sum(greatest(d, 0)) {_LAST(14)} / nullif(sum(greatest(-d, 0)) {_LAST(14)}, 0)) AS rsi_14,
  max(y) {_LAST(52)} AS cum_max FROM d)
SELECT * EXCLUDE (back) REPLACE ({', '.join(f'round({c}, 4) AS {c}' for c in ('y_sma_3', 'y_sma_12', 'comparison_y_shift_4_5', 'comparison_y_ms_6_12', 'comparison_y_sma_6_12', 'bband_spread_8', 'rsi_14'))})
FROM x WHERE back = 1"""
_RICH_ROUND = {c: 4 for c in ("y_sma_3", "y_sma_12", "comparison_y_shift_4_5", "comparison_y_ms_6_12", "comparison_y_sma_6_12", "bband_spread_8", "rsi_14")}
query("f02_first_future_features", _RICH_SQL)(
    using(supplier_panel, lambda p: round_to(fc.first_future_features(p, RICH), **_RICH_ROUND)))
query(
    "f03_future_frame",
    f"""{SM}, r AS (SELECT series, date, y, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
h AS (SELECT series, max(date) AS last, max(y) FILTER (back = 1) AS l1, max(y) FILTER (back = 2) AS l2, avg(y) FILTER (back <= 3) AS s3 FROM r GROUP BY 1),
d AS (SELECT series, l1, l2, s3, CAST(unnest(generate_series(last + 1, last + 8, INTERVAL 1 DAY)) AS DATE) AS date FROM h),
w AS (SELECT *, row_number() {over()} AS step FROM d WHERE isodow(date) < 6)
SELECT series, date, CAST(day(date) AS INTEGER) AS day_of_month, CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST((day(date) - 1) // 7 + 1 AS INTEGER) AS week_of_month, CAST(year(date) AS INTEGER) AS year,
  CASE WHEN step = 1 THEN l1 END AS y_lag_1, CASE WHEN step = 1 THEN l2 END AS y_lag_2, round(CASE WHEN step = 1 THEN s3 END, 4) AS y_sma_3 FROM w""",
)(using(supplier_panel, lambda p: round_to(fc.future_frame(p, FS, "date", 7), y_sma_3=4)))

_EXOG = config.FeatureSet(target="y", exog_lags={"rev": (6,), "disc": (7,)})


def _future_rows(spark, sf):
    p = supplier_panel(spark, sf)
    from seriesloom.operators import calendar as cal

    future = cal.future_months(p.df, ["series"], "date", 6).drop("step").withColumn("date", F.last_day("date"))
    made = fc.future_feature_rows(p.df, future, ["series"], "date", _EXOG, lambda q, fs: config.build(q, fs, fill=None))
    return made.select("series", "date", "rev_lag_6", "disc_lag_7")


query(
    "f04_future_feature_rows",
    f"""{SM}, r AS (SELECT series, date, rev, disc, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
m AS (SELECT series, max(date) AS last FROM supplier_monthly GROUP BY 1), s AS (SELECT unnest(range(1, 7)) AS step)
SELECT m.series, last_day(CAST(last + to_months(CAST(step AS INTEGER)) AS DATE)) AS date, a.rev AS rev_lag_6, b.disc AS disc_lag_7
FROM m CROSS JOIN s LEFT JOIN r a ON a.series = m.series AND a.back = 7 - step LEFT JOIN r b ON b.series = m.series AND b.back = 8 - step""",
)(_future_rows)

# Fixed linear model: prediction = 1 + 0.5 lag1 + 0.2 lag2 + 0.25 mean of the last three.
_MODEL = fc.linear_predictor({"y_lag_1": 0.5, "y_lag_2": 0.2, "y_sma_3": 0.25}, 1.0)
_RECURSION = f"""WITH RECURSIVE {SUPPLIER_MONTHLY},
r AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM supplier_monthly),
h AS (SELECT series, max(y) FILTER (back = 1) AS a, max(y) FILTER (back = 2) AS b, max(y) FILTER (back = 3) AS c FROM r GROUP BY 1),
s AS (
  SELECT series, 1 AS step, a AS l1, b AS l2, (a + b + c) / 3 AS s3, 1 + 0.5::DOUBLE * a + 0.2::DOUBLE * b + 0.25::DOUBLE * ((a + b + c) / 3) AS p FROM h
  UNION ALL
  SELECT series, step + 1, p, l1, (p + l1 + l2) / 3, 1 + 0.5::DOUBLE * p + 0.2::DOUBLE * l1 + 0.25::DOUBLE * ((p + l1 + l2) / 3) FROM s WHERE step < 8)"""


def _recursive(p, **kw):
    state = fc.series_state(p, "y", FS.memory())
    return fc.recursive_forecast(state, FS, _MODEL, 8, **kw)


query(
    "f05_refreshed_features",
    f"{_RECURSION} SELECT series, step, round(l1, 4) AS y_lag_1, round(l2, 4) AS y_lag_2, round(s3, 4) AS y_sma_3, round(p, 4) AS prediction FROM s",
)(using(supplier_monthly, lambda p: round_to(_recursive(p, keep_features=True), y_lag_1=4, y_lag_2=4, y_sma_3=4, prediction=4)))


def _known_path(spark, sf, cols):
    """Refresh features along a path whose next values are known, to compare with the window features."""
    p = supplier_panel(spark, sf)
    head = p.with_df(p.df.filter("date < '2001-03-01'"))
    state = fc.series_state(head, "y", RICH.memory())
    ahead = p.df.filter("date >= '2001-03-01' AND date < '2001-09-01'").groupBy("series").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("date", "y"))), lambda x: x["y"]).alias("path")
    )
    state = state.join(ahead.filter(F.size("path") == 6), "series")
    follow = lambda f: f["truth"]
    got = fc.recursive_forecast(state, RICH, follow, 6, exogenous={"truth": "path"}, keep_features=True)
    return got.select("series", "step", *[round_half_up(c, 4).alias(c) for c in cols])


def _path_sql(cols: dict[str, str]) -> str:
    """Window features of the rows the path covers."""
    sel = ", ".join(f"{e} AS {c}" for c, e in cols.items())
    out = ", ".join(f"round({c}, 4) AS {c}" for c in cols)
    return f"""{SM}, d AS (SELECT *, y - lag(y) {over()} AS d FROM supplier_monthly), x AS (SELECT series, date, {sel} FROM d),
k AS (SELECT *, CAST(row_number() {over()} AS INTEGER) AS step, count(*) OVER (PARTITION BY series) AS n FROM x WHERE date >= DATE '2001-03-01' AND date < DATE '2001-09-01')
SELECT series, step, {out} FROM k WHERE n = 6"""


_B = lambda agg, n: f"{agg}(y) {over(f'ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING')}"
_D = over("ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING")
_F6 = {
    "cum_max": _B("max", 52), "comparison_y_shift_4_5": f"100 * lag(y, 4) {over()} / nullif(lag(y, 5) {over()}, 0)",
    "comparison_y_ms_6_12": f"100 * {_B('sum', 6)} / {_B('sum', 12)}", "comparison_y_sma_6_12": f"100 * {_B('avg', 6)} / {_B('avg', 12)}",
}
_F7 = {
    "bband_spread_8": f"4 * {_B('stddev_samp', 8)}",
    "rsi_14": f"100 - 100 / (1 + sum(greatest(d, 0)) {_D} / nullif(sum(greatest(-d, 0)) {_D}, 0))",
}
query("f06_refreshed_ratios", _path_sql(_F6))(lambda spark, sf: _known_path(spark, sf, list(_F6)))
query("f07_refreshed_bands", _path_sql(_F7))(lambda spark, sf: _known_path(spark, sf, list(_F7)))
query("f08_recursive_forecast", f"{_RECURSION} SELECT series, step, round(p, 4) AS prediction FROM s")(
    using(supplier_monthly, lambda p: round_to(_recursive(p), prediction=4))
)
_KNOWN = {"rev": [3, 8], "disc": [2]}


def _known_sql(diff: bool) -> str:
    src = f"(SELECT series, date, rev - lag(rev) {over()} AS rev, disc - lag(disc) {over()} AS disc FROM supplier_monthly)" if diff else "supplier_monthly"
    cols = ", ".join(
        f"max(CASE WHEN back = {n} - step + 1 THEN {c} END) AS {c}_lag_{n}" for c, ns in _KNOWN.items() for n in ns
    )
    return f"""{SM}, r AS (SELECT series, rev, disc, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM {src}),
s AS (SELECT unnest(range(1, 7)) AS step) SELECT series, CAST(step AS INTEGER) AS step, {cols} FROM r, s GROUP BY 1, 2"""


query("f12_known_lags", _known_sql(False))(using(supplier_panel, lambda p: fc.known_lag_columns(p, _KNOWN, 6)))
query("f12_known_lags_differenced", _known_sql(True))(
    using(supplier_panel, lambda p: fc.known_lag_columns(p, _KNOWN, 6, differenced=True)))
query(
    "f16_voting_mean",
    f"""{_RECURSION}, n AS (SELECT series, CAST(13 - back AS INTEGER) AS step, y FROM r WHERE back BETWEEN 5 AND 12)
SELECT series, step, round((p + y) / 2, 4) AS prediction FROM s JOIN n USING (series, step)""",
)(
    using(
        supplier_panel,
        lambda p: round_to(fc.voting_mean(_recursive(p).unionByName(fc.seasonal_naive(p, "y", 12, 8)), ["series", "step"]), prediction=4),
    )
)

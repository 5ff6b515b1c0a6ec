"""Sources, sinks, cleaning, calendar and joins: IO, P, T and J rows of the inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.catalog.base import (
    BY_DATE, EVENTS_HOURLY, FLAG_MONTHLY, NATION_MONTHLY, OHLC_DAILY, ORDER_ROWS, ORDERS_WEEKLY, SUPPLIER_MONTHLY,
    events_hourly_df, flag_monthly_df, nation_monthly_df, ohlc_daily_df, order_rows, order_rows_df,
    orders_weekly_df, over, query, round_half_up, round_to, sql_bfill, sql_ffill, supplier_monthly, supplier_monthly_df,
    supplier_panel, table, weekly_panel, with_,
)
from seriesloom.catalog.reports import FORECAST_REPORT, forecast_report
from seriesloom.operators import calendar as cal
from seriesloom.operators import cleaning as cl
from seriesloom.operators import joins as jn
from seriesloom.operators.panel import CALENDAR_ROWS, Panel
from seriesloom.sources import readers, sinks

# -- sources and sinks -----------------------------------------------------------------------

PANEL_SCHEMA = "series string, date date, y double, n bigint"
FACT_SCHEMA = {"series": "bigint", "date": "date", "model_type": "string", "forecast": "double", "run_date": "date"}
_OW = with_(ORDERS_WEEKLY)


def _csv_round_trip(spark, sf):
    folder = sinks.scratch_folder(spark)
    path = sinks.write_dataset(orders_weekly_df(spark, sf), folder, "panel", "csv")
    return readers.read_panel(spark, path, PANEL_SCHEMA, ["date"])


query("io01_read_panel", f"{_OW}SELECT * FROM orders_weekly")(_csv_round_trip)


def _table_except(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("loom_customer")
    return readers.read_table_except(spark, "loom_customer", ["c_name", "c_acctbal"])


query("io02_table_except", "SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")(_table_except)


def _ohlc_history(spark, sf):
    raw = ohlc_daily_df(spark, sf).withColumn("stamp", F.col("date").cast("timestamp_ntz")).drop("date")
    return readers.stack_histories(raw, "stamp", "series")


query(
    "io03_stack_histories",
    f'{with_(OHLC_DAILY)}SELECT open AS "OPEN", high AS "HIGH", low AS "LOW", close AS "CLOSE", series AS "TICKER", date AS "DATE" FROM ohlc_daily',
)(_ohlc_history)


def _append_latest(spark, sf):
    df = orders_weekly_df(spark, sf)
    # The last week is news; the last two come again with other values.
    last = cl.last_rows(df, ["series"], ["date"], 2)
    history = df.join(last.filter("from_end = 1").select("series", "date"), ["series", "date"], "left_anti")
    return readers.append_latest(history, last.select("series", "date", (F.col("y") + F.col("from_end")).alias("y"), "n"), ["series"], "date")


query(
    "io04_append_latest",
    f"""{_OW}, r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM orders_weekly)
SELECT series, date, CASE WHEN back <= 2 THEN y + back ELSE y END AS y, n FROM r""",
)(_append_latest)


def _cleaned(spark, sf):
    raw = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey").toDF("Customer Key (ID)", "C Name/Label", "Nation__Key $T")
    return cl.clean_column_names(raw)


query("io05_clean_names", "SELECT c_custkey AS customer_key_id, c_name AS c_namelabel, c_nationkey AS nation_key_usdt FROM customer")(_cleaned)


def _two_tables(spark, sf):
    frames = {"orders": orders_weekly_df(spark, sf), "nations": nation_monthly_df(spark, sf)}
    paths = sinks.write_datasets(frames, sinks.scratch_folder(spark), "report", "parquet")
    return spark.read.parquet(paths[0]).select("series", "date", "y").unionByName(spark.read.parquet(paths[1]))


query("io06_named_tables", f"{with_(ORDERS_WEEKLY, NATION_MONTHLY)}SELECT series, date, y FROM orders_weekly UNION ALL SELECT * FROM nation_monthly")(
    _two_tables
)


def _appended(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/forecasts"
    r = forecast_report(spark, sf).withColumn("run_date", F.to_date(F.lit("2001-01-01")))
    sinks.append_facts(r.filter("model_type = 'sma_3'"), path, FACT_SCHEMA)
    sinks.append_facts(r.filter("model_type = 'last_value'").drop("actual"), path, FACT_SCHEMA)
    return round_to(spark.read.parquet(path), forecast=4)


query(
    "io07_append_facts",
    f"""{with_(FORECAST_REPORT)}SELECT series, date, model_type, round(forecast, 4) AS forecast, DATE '2001-01-01' AS run_date
FROM report WHERE model_type IN ('sma_3', 'last_value')""",
)(_appended)


def _quoted(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/export"
    weekly = orders_weekly_df(spark, sf).withColumn("note", F.concat(F.lit('said "'), F.col("series"), F.lit('", twice\nover')))
    sinks.export_csv(weekly, path, single_file=True)
    opts = {"header": True, "quote": '"', "escape": '"', "multiLine": True}
    return spark.read.schema(f"{PANEL_SCHEMA}, note string").options(**opts).csv(path)


query("io08_quoted_csv", f"""{_OW}SELECT *, 'said "' || series || '", twice' || chr(10) || 'over' AS note FROM orders_weekly""")(_quoted)


def _replaced(spark, sf):
    name = sinks.month_table_name(spark, "loom_monthly")
    sinks.replace_table(supplier_monthly_df(spark, sf), name, f"{sinks.scratch_folder(spark)}/t", bucket=(8, ["series"]))
    return spark.table(name)


query("io09_replace_table", f"{with_(SUPPLIER_MONTHLY)}SELECT * FROM supplier_monthly")(_replaced)

# -- projection, filters, cleaning ------------------------------------------------------------

query("p01_select_renamed", "SELECT o_orderkey AS id, o_totalprice AS price, o_orderpriority AS series FROM orders")(
    lambda spark, sf: cl.select_renamed(table(spark, sf, "orders"), {"o_orderkey": "id", "o_totalprice": "price", "o_orderpriority": "series"})
)
query("p02_only_series", f"{_OW}SELECT * FROM orders_weekly WHERE series IN ('1-URGENT', '5-LOW')")(
    lambda spark, sf: cl.only_series(orders_weekly_df(spark, sf), "series", ["1-URGENT", "5-LOW"])
)
query(
    "p03_holdout",
    f"""{with_(SUPPLIER_MONTHLY)}SELECT *, CASE WHEN date < max(date) OVER (PARTITION BY series) - 180 THEN 'train' ELSE 'validation' END AS part
FROM supplier_monthly""",
)(lambda spark, sf: cl.holdout(supplier_panel(spark, sf).df, ["series"], "date", 180))
query("p04_drop_present", f"{with_(SUPPLIER_MONTHLY)}SELECT series, date, y FROM supplier_monthly")(
    lambda spark, sf: cl.drop_present(supplier_monthly_df(spark, sf), ["rev", "disc", "not_there"])
)
query(
    "p05_infinite_to_null",
    "SELECT event_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE value END AS v FROM events",
)(
    lambda spark, sf: cl.infinite_to_null(
        table(spark, sf, "events").select(
            "event_id",
            F.when(F.pmod("user_id", F.lit(10)) == 0, F.lit(float("inf")))
            .when(F.pmod("user_id", F.lit(5)) == 0, F.lit(float("-inf")))
            .otherwise(F.col("value"))
            .alias("v"),
        )
    )
)
query("p06_drop_null_rows", f"{with_(ORDER_ROWS)}SELECT * FROM order_rows WHERE gappy IS NOT NULL")(
    lambda spark, sf: order_rows_df(spark, sf).na.drop(subset=["gappy"])
)
query("p07_sorted_columns", f"{with_(SUPPLIER_MONTHLY)}SELECT date, disc, rev, series, y FROM supplier_monthly")(
    lambda spark, sf: cl.sorted_columns(supplier_monthly_df(spark, sf))[0]
)
query(
    "p08_first_per_key",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
)(
    lambda spark, sf: cl.first_per_key(
        table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"),
        ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")],
    ).drop("o_orderdate")
)
query("p09_drop_weekends", f"{with_(OHLC_DAILY)}SELECT * FROM ohlc_daily WHERE isodow(date) < 6")(
    lambda spark, sf: cal.drop_weekends(ohlc_daily_df(spark, sf), "date")
)
query(
    "p10_duplicate_share",
    """WITH g AS (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT round(100.0 * sum(c - 1) / sum(c), 6) AS duplicate_pct FROM g""",
)(lambda spark, sf: round_to(cl.duplicate_share(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]), duplicate_pct=6))
query(
    "p11_missing_share",
    f"""{with_(ORDER_ROWS)}SELECT 'y' AS column_name, round(100.0 * count(*) FILTER (y IS NULL) / count(*), 6) AS missing_pct FROM order_rows
UNION ALL SELECT 'gappy', round(100.0 * count(*) FILTER (gappy IS NULL) / count(*), 6) FROM order_rows""",
)(lambda spark, sf: round_to(cl.missing_share(order_rows_df(spark, sf), ["y", "gappy"]), missing_pct=6))


def _profile_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER ({c} = 0) AS zeros, count(*) FILTER ({c} IS NULL) AS nulls,
  round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""


query("p12_profile", " UNION ALL ".join(_profile_sql(c) for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")))(
    lambda spark, sf: round_to(
        cl.profile(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_linenumber"]), mean=4, std=4
    )
)
query(
    "p13_outliers",
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem GROUP BY 1)
SELECT l_returnflag, l_extendedprice, round(lo, 3) AS lower_limit, round(hi, 3) AS upper_limit,
  l_extendedprice < lo OR l_extendedprice > hi AS is_outlier FROM lineitem JOIN q USING (l_returnflag)""",
)(
    lambda spark, sf: round_to(
        cl.flag_outliers(
            table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice", rows_per_task=5_000
        ),
        lower_limit=3, upper_limit=3,
    )
)
query("p14_features_and_target", f"{with_(SUPPLIER_MONTHLY)}SELECT series, date, y AS label, rev AS f0, disc AS f1 FROM supplier_monthly")(
    lambda spark, sf: cl.features_and_target(supplier_monthly_df(spark, sf), ["rev", "disc"], "y")
    .withColumn("f", vector_to_array("features"))
    .select("series", "date", "label", F.col("f")[0].alias("f0"), F.col("f")[1].alias("f1"))
)
query(
    "p15_history_and_forecast",
    f"""{with_(FORECAST_REPORT)}
SELECT series, date, y AS close, NULL::DOUBLE AS forecast, 'Historical' AS class, y AS price FROM supplier_monthly
UNION ALL SELECT series, date, NULL, round(forecast, 4), 'Forecast', round(forecast, 4) FROM report WHERE model_type = 'sma_3'""",
)(
    lambda spark, sf: cl.history_and_forecast(
        supplier_monthly_df(spark, sf).select("series", "date", F.col("y").alias("close")),
        forecast_report(spark, sf).filter("model_type = 'sma_3'").select("series", "date", round_half_up("forecast", 4).alias("forecast")),
        "close", "forecast",
    )
)
query(
    "p16_corrected",
    f"""{_OW}, f AS (SELECT series, date, y * 2 AS fix FROM orders_weekly WHERE n = 1)
SELECT series, date, n, coalesce(fix, y) AS y FROM orders_weekly LEFT JOIN f USING (series, date)""",
)(
    lambda spark, sf: (
        lambda df: cl.corrected(df, df.filter("n = 1").withColumn("y", F.col("y") * 2), ["series", "date"], "y")
    )(weekly_panel(spark, sf).df)
)
for _kind, _expr in (
    ("minmax", "(y - min(y) OVER p) / nullif(max(y) OVER p - min(y) OVER p, 0)"),
    ("standard", "(y - avg(y) OVER p) / nullif(stddev_pop(y) OVER p, 0)"),
    ("robust", "(y - quantile_cont(y, 0.5) OVER p) / nullif(quantile_cont(y, 0.75) OVER p - quantile_cont(y, 0.25) OVER p, 0)"),
):
    query(
        f"p17_scaled_{_kind}",
        f"{with_(SUPPLIER_MONTHLY)}SELECT series, date, y, round({_expr}, 6) AS y_{_kind} FROM supplier_monthly WINDOW p AS (PARTITION BY series)",
        kind=_kind,
    )(
        lambda spark, sf, kind: round_to(
            cl.scaled(supplier_panel(spark, sf).df.select("series", "date", "y"), ["series"], "y", kind), **{f"y_{kind}": 6}
        )
    )
query("p18_year_flag", f"{_OW}SELECT series, date, CAST(year(date) = 1998 AS INTEGER) AS flag FROM orders_weekly")(
    lambda spark, sf: orders_weekly_df(spark, sf).select("series", "date", cl.year_flag("date", 1998).alias("flag"))
)
query(
    "p19_forecast_card",
    f"""{with_(FORECAST_REPORT)}SELECT series, round(min(forecast), 4) AS lowest, round(max(forecast), 4) AS highest,
  round(max(forecast) - min(forecast), 4) AS amplitude, round(100 * (max(forecast) - min(forecast)) / nullif(min(forecast), 0), 4) AS amplitude_pct
FROM report WHERE model_type = 'sma_3' GROUP BY 1""",
)(
    lambda spark, sf: round_to(
        cl.forecast_card(forecast_report(spark, sf).filter("model_type = 'sma_3'"), ["series"], "forecast"),
        lowest=4, highest=4, amplitude=4, amplitude_pct=4,
    )
)

# -- calendar --------------------------------------------------------------------------------

_SPINE_WEEK = """spine AS (SELECT series, CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE) AS date FROM {src} GROUP BY 1)"""
# Days with gaps: the values of most orders are taken as missing, every order's day is there.
_GAP_DAYS = f"""gap AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date, min(CASE WHEN o_orderkey % 11 = 0 THEN floor(o_totalprice) END) AS lo,
  sum(CASE WHEN o_orderkey % 33 = 0 THEN floor(o_totalprice) END) AS third
  FROM orders GROUP BY 1, 2)"""


def _gap_days(spark, sf):
    o = table(spark, sf, "orders")
    price = F.floor("o_totalprice").cast("double")
    every = lambda n: F.when(F.pmod("o_orderkey", F.lit(n)) == 0, price)
    return o.groupBy(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("date")).agg(
        F.min(every(11)).alias("lo"), F.sum(every(33)).alias("third")
    )


_WEEK = "date + CAST((12 - isodow(date)) % 7 AS INTEGER)"
query(
    "t01_align_to_weekday",
    f"""{with_(_GAP_DAYS, f"w AS (SELECT series, {_WEEK} AS date, min(date) AS original_date, arg_min(lo, date) FILTER (lo IS NOT NULL) AS lo, arg_min(third, date) FILTER (third IS NOT NULL) AS third FROM gap GROUP BY 1, 2)", _SPINE_WEEK.format(src="w"))}
SELECT * FROM spine LEFT JOIN w USING (series, date)""",
)(lambda spark, sf: cal.align_to_weekday(_gap_days(spark, sf), ["series"], "date", ["lo", "third"]))
query("t02_friday_of_week", "SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(5 - isodow(o_orderdate) AS INTEGER) AS friday FROM orders")(
    lambda spark, sf: table(spark, sf, "orders").select("o_orderkey", cal.friday_of_week("o_orderdate").alias("friday"))
)
query(
    "t03_nearest_month_start",
    """SELECT o_orderkey, CAST(CASE WHEN day(o_orderdate) <= 15 THEN date_trunc('month', o_orderdate)
  ELSE date_trunc('month', o_orderdate) + INTERVAL 1 MONTH END AS DATE) AS month_start FROM orders""",
)(lambda spark, sf: table(spark, sf, "orders").select("o_orderkey", cal.nearest_month_start("o_orderdate").alias("month_start")))
query("t04_serial_day", "SELECT o_orderkey, DATE '1899-12-30' + CAST(35000 + o_custkey AS INTEGER) AS date FROM orders")(
    lambda spark, sf: table(spark, sf, "orders").select("o_orderkey", cal.from_serial_day(F.col("o_custkey") + 35000).alias("date"))
)


def _interpolated_sql(source: str, c: str, by: str = BY_DATE) -> str:
    """Steps that fill ``c`` linearly by position; result table ``filled`` with the column ``v``."""
    prev = lambda e: f"last_value(CASE WHEN {c} IS NOT NULL THEN {e} END IGNORE NULLS) {over('ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW', by)}"
    nxt = lambda e: f"first_value(CASE WHEN {c} IS NOT NULL THEN {e} END IGNORE NULLS) {over('ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING', by)}"
    return f"""pos AS (SELECT *, row_number() OVER ({by}) AS i FROM {source}),
near AS (SELECT *, {prev(c)} AS p, {prev('i')} AS pi, {nxt(c)} AS n, {nxt('i')} AS ni FROM pos),
filled AS (SELECT *, CASE WHEN {c} IS NOT NULL THEN {c} WHEN n IS NULL THEN p ELSE p + (n - p) * (i - pi) / nullif(ni - pi, 0) END AS v FROM near)"""


query(
    "t05_monthly_to_weekly",
    f"""{with_(SUPPLIER_MONTHLY, f"w AS (SELECT series, {_WEEK} AS date, avg(y) AS y FROM supplier_monthly GROUP BY 1, 2)", _SPINE_WEEK.format(src="w"),
    "full_weeks AS (SELECT * FROM spine LEFT JOIN w USING (series, date))", _interpolated_sql("full_weeks", "y"))}
SELECT series, date, round(v, 4) AS y FROM filled""",
)(lambda spark, sf: round_to(cal.to_weekly(supplier_monthly_df(spark, sf), ["series"], "date", ["y"]).select("series", "date", "y"), y=4))
query(
    "t06_month_end_grid",
    f"""{with_(OHLC_DAILY, "spine AS (SELECT series, last_day(CAST(unnest(generate_series(date_trunc('month', min(date)), max(date), INTERVAL 1 MONTH)) AS DATE)) AS date FROM ohlc_daily GROUP BY 1)",
    "m AS (SELECT * FROM spine LEFT JOIN (SELECT series, date, CASE WHEN date_part('day', date) <> 30 THEN close END AS close FROM ohlc_daily) USING (series, date))", _interpolated_sql("m", "close"))}
SELECT series, date, round(v, 4) AS close FROM filled""",
)(
    lambda spark, sf: round_to(
        cal.to_month_ends(
            ohlc_daily_df(spark, sf).withColumn("close", F.when(F.dayofmonth("date") != 30, F.col("close"))), ["series"], "date", ["close"]
        ).select("series", "date", "close"), close=4
    )
)
query("t07_interpolate", f"{with_(_GAP_DAYS, _interpolated_sql('gap', 'third'))}SELECT series, date, round(v, 4) AS third FROM filled")(
    lambda spark, sf: round_to(
        cal.interpolate(Panel.calendar(_gap_days(spark, sf), ["series"], "date"), ["third"]).df.select("series", "date", "third"), third=4
    )
)
_BY_ROW = "PARTITION BY series ORDER BY date, id"
query(
    "t07_interpolate_rows",
    f"{with_(ORDER_ROWS, _interpolated_sql('order_rows', 'gappy', _BY_ROW))}SELECT series, date, id, round(v, 3) AS gappy FROM filled",
)(
    lambda spark, sf: round_to(
        cal.interpolate(order_rows(spark, sf), ["gappy"]).df.select("series", "date", "id", "gappy"), gappy=3
    )
)
query(
    "t08_fill_edges",
    f"""{with_(_GAP_DAYS, f"b AS (SELECT series, date, {sql_bfill('third')} AS third FROM gap)")}
SELECT series, date, {sql_ffill('third')} AS third FROM b""",
)(
    lambda spark, sf: cal.fill_edges(Panel.calendar(_gap_days(spark, sf), ["series"], "date"), ["third"]).df.select("series", "date", "third")
)
query(
    "t09_date_parts",
    """SELECT o_orderkey, CAST(day(d) AS INTEGER) AS day_of_month, CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, CAST((day(d) - 1) // 7 + 1 AS INTEGER) AS week_of_month, CAST(year(d) AS INTEGER) AS year,
  dayname(d) AS weekday_name FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)(
    lambda spark, sf: table(spark, sf, "orders")
    .select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    .withColumns(cal.date_parts("d"))
    .drop("d")
)
query(
    "t10_future_days",
    f"""{with_(SUPPLIER_MONTHLY)}SELECT series, date FROM (
  SELECT series, CAST(unnest(generate_series(max(date) + 1, max(date) + 8, INTERVAL 1 DAY)) AS DATE) AS date FROM supplier_monthly GROUP BY 1)
WHERE isodow(date) < 6""",
)(lambda spark, sf: cal.drop_weekends(cal.future_days(supplier_monthly_df(spark, sf), ["series"], "date", 7), "date"))
query(
    "t11_future_weeks",
    f"""{with_(SUPPLIER_MONTHLY)}, m AS (SELECT series, max(date) AS d FROM supplier_monthly GROUP BY 1), s AS (SELECT unnest(range(1, 7)) AS step)
SELECT series, CAST(step AS INTEGER) AS step, d + CAST((11 - isodow(d)) % 7 + 1 AS INTEGER) + CAST(7 * (step - 1) AS INTEGER) AS date FROM m, s""",
)(lambda spark, sf: cal.future_weeks(supplier_monthly_df(spark, sf), ["series"], "date", 6))
query(
    "t11_future_months",
    f"""{with_(SUPPLIER_MONTHLY)}, m AS (SELECT series, max(date) AS d FROM supplier_monthly GROUP BY 1), s AS (SELECT unnest(range(1, 7)) AS step)
SELECT series, CAST(step AS INTEGER) AS step, CAST(d + to_months(CAST(step AS INTEGER)) AS DATE) AS date FROM m, s""",
)(lambda spark, sf: cal.future_months(supplier_monthly_df(spark, sf), ["series"], "date", 6))
query(
    "t12_calendar_spine",
    f"""{with_(EVENTS_HOURLY)}, s AS (SELECT series, unnest(generate_series(min(ts_hour), max(ts_hour), INTERVAL 1 HOUR)) AS ts_hour FROM events_hourly GROUP BY 1)
SELECT * FROM s LEFT JOIN events_hourly USING (series, ts_hour)""",
)(lambda spark, sf: cal.complete(events_hourly_df(spark, sf), ["series"], "ts_hour", "hour"))
query("t13_working_horizon", "SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_quantity - floor(l_quantity * 2 / 7) AS INTEGER) AS horizon FROM lineitem")(
    lambda spark, sf: table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", cal.working_horizon("l_quantity").alias("horizon"))
)
query(
    "t14_infer_step",
    f"""{with_(NATION_MONTHLY)}, g AS (SELECT series, date - lag(date) {over()} AS gap FROM nation_monthly),
c AS (SELECT series, gap, count(*) AS c FROM g WHERE gap IS NOT NULL GROUP BY 1, 2)
SELECT series, CAST(arg_max(gap, (c, -gap)) AS INTEGER) AS step_days, count(*) = 1 AS regular,
  CASE WHEN arg_max(gap, (c, -gap)) <= 1 THEN 'D' WHEN arg_max(gap, (c, -gap)) <= 7 THEN 'W' WHEN arg_max(gap, (c, -gap)) <= 31 THEN 'M'
  WHEN arg_max(gap, (c, -gap)) <= 92 THEN 'Q' ELSE 'A' END AS frequency FROM c GROUP BY 1""",
)(lambda spark, sf: cal.infer_step(Panel.calendar(nation_monthly_df(spark, sf), ["series"], "date"), "date"))
query(
    "t15_number_labels",
    f'{with_(FORECAST_REPORT)}SELECT series, date, model_type, "window", CAST(dense_rank() OVER (ORDER BY "window") AS INTEGER) AS window_id FROM report',
)(
    lambda spark, sf: cal.number_labels(forecast_report(spark, sf).select("series", "date", "model_type", "window"), "window", "window_id")
)

# -- joins -----------------------------------------------------------------------------------

_SM_TABLES = """a AS (SELECT date, sum(y) AS qty FROM supplier_monthly GROUP BY 1),
b AS (SELECT date, sum(y) AS nation_sales FROM (SELECT series, last_day(date) AS date, y FROM nation_monthly) GROUP BY 1),
c AS (SELECT date, sum(disc) AS disc FROM flag_monthly GROUP BY 1),
d AS (SELECT last_day(date) AS date, avg(close) AS close FROM ohlc_daily GROUP BY 1)"""


def _month_sources(spark, sf):
    return {
        "qty": supplier_monthly_df(spark, sf).groupBy("date").agg(F.sum("y").alias("qty")),
        "sales": nation_monthly_df(spark, sf).groupBy(F.last_day("date").alias("date")).agg(F.sum("y").alias("nation_sales")),
        "disc": flag_monthly_df(spark, sf).groupBy("date").agg(F.sum("disc").alias("disc")),
        "close": ohlc_daily_df(spark, sf).groupBy(F.last_day("date").alias("date")).agg(F.avg("close").alias("close")),
    }


def _weekly_sources(spark, sf):
    ow = weekly_panel(spark, sf).df
    wide = {
        "urgent": ow.filter("series = '1-URGENT'").select("date", F.col("y").alias("urgent")),
        "low": ow.filter("series = '5-LOW'").select("date", F.col("y").alias("low")),
        "medium": ow.filter("series = '3-MEDIUM'").select("date", F.col("y").alias("medium")),
    }
    e = ohlc_daily_df(spark, sf).groupBy(cal.week_ending("date", "FRI").alias("date")).agg(F.max("high").alias("high"))
    return ow.groupBy("date").agg(F.sum("y").alias("total")), {**wide, "high": e}


def _weekly_star(spark, sf):
    base, tables = _weekly_sources(spark, sf)
    sets = {"short": ["urgent", "low"], "all": list(tables)}
    return jn.star_joins(base, tables, sets, ["date"])["all"].orderBy("date")


query(
    "j01_star_join_weekly",
    f"""{with_(ORDERS_WEEKLY, OHLC_DAILY)}, t AS (SELECT date, sum(y) AS total FROM orders_weekly GROUP BY 1),
h AS (SELECT {_WEEK} AS date, max(high) AS high FROM ohlc_daily GROUP BY 1)
SELECT t.date, total, u.y AS urgent, l.y AS low, m.y AS medium, h.high FROM t
LEFT JOIN orders_weekly u ON u.date = t.date AND u.series = '1-URGENT' LEFT JOIN orders_weekly l ON l.date = t.date AND l.series = '5-LOW'
LEFT JOIN orders_weekly m ON m.date = t.date AND m.series = '3-MEDIUM' LEFT JOIN h ON h.date = t.date""",
)(_weekly_star)


# The tables of the wide stars: name -> (source, rows, measure); measures are whole numbers, so that sums do not hang on their order.
_GRAINS = {
    "o": ("orders", "o_orderdate", ["o_orderpriority", "o_orderstatus"], {"n": "count(*)", "price": "sum(floor(o_totalprice))"}),
    "l": ("lineitem", "l_shipdate", ["l_returnflag", "l_linestatus"], {"qty": "sum(l_quantity)", "price": "sum(floor(l_extendedprice))", "disc": "sum(round(l_discount * 100))", "tax": "sum(round(l_tax * 100))"}),
}
_WIDE = {f"{m}_{p[2:].split()[0].lower()}": ("o", f"o_orderpriority = '{p}'", m) for m in ("n", "price") for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")}
_WIDE |= {f"price_{x.lower()}": ("o", f"o_orderstatus = '{x}'", "price") for x in "FOP"} | {f"qty_{x.lower()}": ("l", f"l_returnflag = '{x}'", "qty") for x in "RAN"}
_WIDE |= {"sales_f": ("l", "l_linestatus = 'F'", "price"), "sales_o": ("l", "l_linestatus = 'O'", "price"), "disc": ("l", "true", "disc"), "tax": ("l", "true", "tax")}
# Tables of each set, the base included.
_WIDE_SETS = {name: list(_WIDE)[: n - 1] for name, n in (("quarter", 9), ("weeks", 13), ("elasticity", 17), ("all", 21))}


def _wide_stars(spark, sf):
    """Four sets over one weekly base: every source is aggregated in one scan, every table is bucketed once."""
    grains = {}
    for g, (source, date, keys, measures) in _GRAINS.items():
        week = F.next_day(F.date_sub(F.to_date(date), 1), "Fri").alias("date")
        grains[g] = session.cut(table(spark, sf, source).groupBy(week, *keys).agg(*[F.expr(e).cast("double").alias(m) for m, e in measures.items()]))
    tables = {name: grains[g].filter(rows).groupBy("date").agg(F.sum(m).alias(name)) for name, (g, rows, m) in _WIDE.items()}
    made = jn.bucketed({"base": grains["o"].groupBy("date").agg(F.sum("n").alias("total")), **tables}, ["date"], rows_bound=CALENDAR_ROWS)
    return jn.star_joins(made["base"], made, _WIDE_SETS, ["date"])


_WIDE_SQL = [
    f"{g}_grain AS (SELECT {_WEEK.replace('date', f'CAST({date} AS DATE)', 1).replace('isodow(date)', f'isodow({date})')} AS date, {', '.join(keys)}, {', '.join(f'CAST({e} AS DOUBLE) AS {m}' for m, e in measures.items())} FROM {source} GROUP BY ALL)"
    for g, (source, date, keys, measures) in _GRAINS.items()
] + ["base AS (SELECT date, sum(n) AS total FROM o_grain GROUP BY 1)"] + [f"t_{name} AS (SELECT date, sum({m}) AS {name} FROM {g}_grain WHERE {rows} GROUP BY 1)" for name, (g, rows, m) in _WIDE.items()]


def _wide_sql(members, select):
    return f"SELECT {select} FROM base " + " ".join(f"LEFT JOIN t_{m} USING (date)" for m in members)


query("j01_star_join_wide", with_(*_WIDE_SQL) + _wide_sql(_WIDE, "date, total, " + ", ".join(_WIDE)))(lambda spark, sf: _wide_stars(spark, sf)["all"].orderBy("date"))
query(
    "j01_star_sets",
    with_(*_WIDE_SQL) + " UNION ALL ".join(
        _wide_sql(members, f"'{name}' AS star, date, " + " + ".join(f"CASE WHEN {m} IS NULL THEN 0 ELSE 1 END" for m in members) + " AS n_values, " + " + ".join(f"coalesce({m}, 0)" for m in members) + " AS total")
        for name, members in _WIDE_SETS.items()
    ),
)(
    lambda spark, sf: reduce(
        DataFrame.unionByName,
        [
            df.select(
                F.lit(name).alias("star"), "date", sum((F.col(m).isNotNull().cast("int") for m in _WIDE_SETS[name]), F.lit(0)).alias("n_values"),
                sum((F.coalesce(m, F.lit(0.0)) for m in _WIDE_SETS[name]), F.lit(0.0)).alias("total"),
            )
            for name, df in _wide_stars(spark, sf).items()
        ],
    )
)


def _monthly_star(spark, sf):
    t = _month_sources(spark, sf)
    return jn.star_join(t["qty"], [t["sales"], t["disc"], t["close"]], ["date"])


query(
    "j02_star_join_monthly",
    f"""{with_(SUPPLIER_MONTHLY, NATION_MONTHLY, FLAG_MONTHLY, OHLC_DAILY, _SM_TABLES)}
SELECT date, qty, nation_sales, disc, round(close, 4) AS close FROM a LEFT JOIN b USING (date) LEFT JOIN c USING (date) LEFT JOIN d USING (date)""",
)(lambda spark, sf: round_to(_monthly_star(spark, sf), close=4))
query(
    "j03_features_with_target",
    f"""{with_(SUPPLIER_MONTHLY)}SELECT x.series, x.date, x.rev, x.disc, t.y FROM supplier_monthly x
LEFT JOIN (SELECT series, date, y FROM supplier_monthly WHERE date < DATE '2001-01-01') t ON x.series = t.series AND x.date = t.date""",
)(
    lambda spark, sf: (
        lambda df: jn.features_with_target(df.drop("y"), df.filter("date < '2001-01-01'").select("series", "date", "y"), ["series", "date"])
    )(supplier_panel(spark, sf).df)
)
query(
    "j04_group_value_on_rows",
    f'{with_(FORECAST_REPORT)}SELECT series, date, model_type, round(avg(abs((actual - forecast) / actual)) OVER (PARTITION BY model_type, "window"), 5) AS window_mape FROM report',
)(
    lambda spark, sf: jn.with_group_value(
        forecast_report(spark, sf), ["model_type", "window"], F.avg(F.abs((F.col("actual") - F.col("forecast")) / F.col("actual"))), "window_mape"
    ).select("series", "date", "model_type", round_half_up("window_mape", 5).alias("window_mape"))
)
query(
    "j05_quarter_join",
    f"""{with_(NATION_MONTHLY)}, q AS (SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q, count(*) AS orders_in_quarter FROM orders GROUP BY 1)
SELECT series, date, y, orders_in_quarter FROM nation_monthly LEFT JOIN q ON date_trunc('quarter', date) = q""",
)(
    lambda spark, sf: jn.with_quarterly(
        nation_monthly_df(spark, sf),
        table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", "quarter").alias("q")).agg(F.count("*").alias("orders_in_quarter")),
        "date", "q", "orders_in_quarter",
    )
)
_RUNS = """runs AS (SELECT series, date, model_type, forecast, date - CAST(u.back AS INTEGER) AS run_date FROM report,
  (SELECT unnest([7, 14]) AS back) u)"""


def _runs(spark, sf):
    r = forecast_report(spark, sf).select("series", "date", "model_type", "forecast")
    return r.withColumn("run_date", F.explode(F.array(F.date_sub("date", 7), F.date_sub("date", 14))))


query(
    "j06_forecast_vs_actual",
    f"""{with_(FORECAST_REPORT, _RUNS)}, a AS (SELECT series, max(date) AS date, arg_max(y, date) AS actual FROM supplier_monthly GROUP BY 1),
n AS (SELECT series, max(run_date) AS run_date FROM runs GROUP BY 1)
SELECT series, date, run_date, model_type, round(forecast, 4) AS forecast, actual FROM runs JOIN n USING (series, run_date) JOIN a USING (series, date)""",
)(
    lambda spark, sf: round_to(
        jn.latest_forecast_with_actual(
            _runs(spark, sf), supplier_monthly_df(spark, sf).select("series", "date", F.col("y").alias("actual")), ["series"], "date", "run_date"
        ),
        forecast=4,
    )
)
query(
    "j06_missing_forecasts",
    f"{with_(SUPPLIER_MONTHLY)}SELECT series, max(date) AS date FROM supplier_monthly WHERE series % 7 = 0 GROUP BY 1",
)(lambda spark, sf: jn.without_forecast(_runs(spark, sf).filter("series % 7 <> 0"), supplier_monthly_df(spark, sf), ["series"], "date"))
query(
    "j07_interval_by_date",
    f"""{with_(FORECAST_REPORT)}, i AS (SELECT series, date, min(forecast) AS lower, max(forecast) AS upper FROM report GROUP BY 1, 2)
SELECT series, date, round(forecast, 4) AS forecast, round(lower, 4) AS lower, round(upper, 4) AS upper
FROM report LEFT JOIN i USING (series, date) WHERE model_type = 'sma_3'""",
)(
    lambda spark, sf: (
        lambda r: round_to(
            jn.with_interval(
                r.filter("model_type = 'sma_3'").select("series", "date", "forecast"),
                r.groupBy("series", "date").agg(F.min("forecast").alias("lower"), F.max("forecast").alias("upper")),
                ["series", "date"],
            ),
            forecast=4, lower=4, upper=4,
        )
    )(forecast_report(spark, sf))
)
query(
    "j08_actual_on_features",
    f"""{with_(SUPPLIER_MONTHLY, ORDERS_WEEKLY)}SELECT x.series, x.date, x.rev_lag_1, s.y AS actual
FROM (SELECT series, date, lag(rev) {over()} AS rev_lag_1 FROM supplier_monthly) x LEFT JOIN supplier_monthly s ON x.series = s.series AND x.date = s.date""",
)(
    lambda spark, sf: (
        lambda p: jn.features_with_target(
            p.frames(lambda w: {"rev_lag_1": F.lag("rev", 1).over(w)}, back=1).df.select("series", "date", "rev_lag_1"),
            p.df.select("series", "date", F.col("y").alias("actual")), ["series", "date"],
        )
    )(supplier_panel(spark, sf))
)

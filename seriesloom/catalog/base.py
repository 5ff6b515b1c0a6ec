"""The registry of named queries and the derived panels they run on.

Each panel exists twice, once as a DataFrame and once as SQL text for the check engine. Values
are whole numbers where they can be, so sums and averages are the same bits in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.functions.columns import rounded as round_half_up
from seriesloom.operators import calendar as cal
from seriesloom.operators.panel import Panel

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **params) -> Callable[[Query], Query]:
    """Register a query, with the equivalent SQL where there is one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = partial(fn, **params) if params else fn
        if sql is not None:
            ORACLES[name] = decimal_rounds(sql)
        return fn

    return add


def decimal_rounds(sql: str) -> str:
    """Make every ``round(x, n)`` round in decimal, as the library does, so that ties agree."""
    out, i = [], 0
    while (j := sql.find("round(", i)) >= 0:
        depth, k, comma = 0, j + 5, None
        while True:
            ch = sql[k]
            depth += (ch == "(") - (ch == ")")
            if depth == 0:
                break
            if ch == "," and depth == 1:
                comma = k
            k += 1
        out.append(sql[i:j])
        if comma is None:
            out.append("round(" + decimal_rounds(sql[j + 6 : k]) + ")")
        else:
            n = int(sql[comma + 1 : k])
            out.append(f"CAST(round(CAST({decimal_rounds(sql[j + 6 : comma])} AS DECIMAL(38, {n + 3})), {n}) AS DOUBLE)")
        i = k + 1
    return "".join(out) + sql[i:]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    session.ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- derived panels: DataFrame form ----------------------------------------------------------


def orders_weekly_df(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.groupBy(
        F.col("o_orderpriority").alias("series"), cal.week_ending(F.to_date("o_orderdate"), "FRI").alias("date")
    ).agg(F.sum(F.floor("o_totalprice").cast("double")).alias("y"), F.count("*").alias("n"))


def orders_weekly(spark: SparkSession, sf: str) -> Panel:
    return Panel.calendar(orders_weekly_df(spark, sf), ["series"], "date")


def supplier_monthly_df(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("series"), F.last_day("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("y"),
        F.sum(F.floor("l_extendedprice").cast("double")).alias("rev"),
        F.sum(F.round(F.col("l_discount") * 100)).alias("disc"),
    )


def supplier_monthly(spark: SparkSession, sf: str) -> Panel:
    return Panel.calendar(supplier_monthly_df(spark, sf), ["series"], "date")


# Operators that read their panel more than once get it written: the raw table is scanned once,
# and what is read again is the panel, smaller by the rows per series and date.


def supplier_panel(spark: SparkSession, sf: str) -> Panel:
    return Panel.calendar(session.cut(supplier_monthly_df(spark, sf)), ["series"], "date")


def weekly_panel(spark: SparkSession, sf: str) -> Panel:
    return Panel.calendar(session.cut(orders_weekly_df(spark, sf)), ["series"], "date")


def using(build: Callable[[SparkSession, str], Panel], fn: Callable[[Panel], DataFrame]) -> Query:
    return lambda spark, sf: fn(build(spark, sf))


def flag_monthly_df(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_returnflag").alias("series"), F.last_day("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("y"),
        F.sum(F.round(F.col("l_discount") * 100)).alias("disc"),
        F.sum(F.floor("l_extendedprice").cast("double")).alias("rev"),
    )


def ohlc_daily_df(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    rank = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    price = F.floor("l_extendedprice").cast("double")
    return li.groupBy(F.col("l_linestatus").alias("series"), F.to_date("l_shipdate").alias("date")).agg(
        F.min_by(price, rank).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, rank).alias("close"),
    )


def ohlc_daily(spark: SparkSession, sf: str) -> Panel:
    return Panel.calendar(ohlc_daily_df(spark, sf), ["series"], "date")


def events_hourly_df(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts_hour")).agg(
        F.sum(F.floor(F.col("value")).cast("double")).alias("y"), F.count("*").alias("n")
    )


def nation_monthly_df(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .groupBy(F.col("n_name").alias("series"), F.trunc("o_orderdate", "MM").alias("date"))
        .agg(F.sum(F.floor("o_totalprice").cast("double")).alias("y"))
    )


# Rows of one series a task may hold in the row-level queries. Low, so that the split plan
# is the one the small check tables exercise; chunks grow with the data (see Panel).
ROW_LEVEL_LIMIT = 2_000


def order_rows_df(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as one row of three very long series."""
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderstatus").alias("series"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderkey").alias("id"),
        F.floor("o_totalprice").cast("double").alias("y"),
        F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.floor("o_totalprice").cast("double")).alias("gappy"),
    )


def order_rows(spark: SparkSession, sf: str) -> Panel:
    return Panel(order_rows_df(spark, sf), ["series"], ["date", "id"], rows_per_task=ROW_LEVEL_LIMIT)


# -- derived panels: SQL form ----------------------------------------------------------------

ORDERS_WEEKLY = """orders_weekly AS (
  SELECT o_orderpriority AS series,
         CAST(o_orderdate AS DATE) + CAST((12 - isodow(o_orderdate)) % 7 AS INTEGER) AS date,
         sum(floor(o_totalprice)) AS y, count(*) AS n
  FROM orders GROUP BY 1, 2)"""
SUPPLIER_MONTHLY = """supplier_monthly AS (
  SELECT l_suppkey AS series, last_day(CAST(l_shipdate AS DATE)) AS date, sum(l_quantity) AS y,
         sum(floor(l_extendedprice)) AS rev, sum(round(l_discount * 100)) AS disc
  FROM lineitem GROUP BY 1, 2)"""
FLAG_MONTHLY = """flag_monthly AS (
  SELECT l_returnflag AS series, last_day(CAST(l_shipdate AS DATE)) AS date, sum(l_quantity) AS y,
         sum(round(l_discount * 100)) AS disc, sum(floor(l_extendedprice)) AS rev
  FROM lineitem GROUP BY 1, 2)"""
OHLC_DAILY = """ohlc_daily AS (
  SELECT l_linestatus AS series, CAST(l_shipdate AS DATE) AS date,
         arg_min(floor(l_extendedprice), (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS open,
         max(floor(l_extendedprice)) AS high, min(floor(l_extendedprice)) AS low,
         arg_max(floor(l_extendedprice), (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS close
  FROM lineitem GROUP BY 1, 2)"""
EVENTS_HOURLY = """events_hourly AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS ts_hour, sum(floor(value)) AS y, count(*) AS n
  FROM events GROUP BY 1, 2)"""
NATION_MONTHLY = """nation_monthly AS (
  SELECT n_name AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, sum(floor(o_totalprice)) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""
ORDER_ROWS = """order_rows AS (
  SELECT o_orderstatus AS series, CAST(o_orderdate AS DATE) AS date, o_orderkey AS id, floor(o_totalprice) AS y,
         CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice) END AS gappy
  FROM orders)"""

BY_DATE = "PARTITION BY series ORDER BY date"


def over(frame: str = "", by: str = BY_DATE) -> str:
    return f"OVER ({by} {frame})"


def sql_before(agg: str, c: str, n: int, least: int | None = None, by: str = BY_DATE) -> str:
    """SQL for ``agg`` over the n rows before, null under ``least`` values."""
    f = over(f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING", by)
    return f"CASE WHEN count({c}) {f} >= {n if least is None else least} THEN {agg}({c}) {f} END"


def sql_upto(agg: str, c: str, n: int, by: str = BY_DATE) -> str:
    f = over(f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW", by)
    return f"CASE WHEN count({c}) {f} >= {n} THEN {agg}({c}) {f} END"


def sql_bfill(c: str, by: str = BY_DATE) -> str:
    return f"first_value({c} IGNORE NULLS) {over('ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING', by)}"


def sql_ffill(c: str, by: str = BY_DATE) -> str:
    return f"last_value({c} IGNORE NULLS) {over('ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW', by)}"


def sql_div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def rounded(df: DataFrame, keep, cols, d: int = 4) -> DataFrame:
    """``keep`` columns as they are, ``cols`` rounded."""
    return df.select(*keep, *[round_half_up(c, d).alias(c) for c in cols])


def round_to(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns in place."""
    return df.withColumns({c: round_half_up(c, d) for c, d in digits.items()})

"""Projection, filters, cleaning, profiling and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.functions.columns import finite_or_null, sdiv
from seriesloom.operators.features import attach
from seriesloom.operators.panel import Panel, matched

# --- fixed values: column-name clean-up, applied in this order after lower-casing ---
NAME_REPLACEMENTS = ((" ", "_"), ("(", ""), (")", ""), ("/", ""), ("__", "_"), ("$t", "usdt"))
OUTLIER_QUANTILES = (0.01, 0.99)
FLAGGED_YEAR = 2020
# ------------------------------------------------------------------------------------


def clean_name(name: str) -> str:
    out = name.lower()
    for old, new in NAME_REPLACEMENTS:
        out = out.replace(old, new)
    return out


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def select_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in mapping.items()])


def only_series(df: DataFrame, key: str, wanted: Sequence) -> DataFrame:
    return df.filter(F.col(key).isin(*wanted))


def holdout(df: DataFrame, series: Sequence[str], date: str, days: int) -> DataFrame:
    """Mark rows as train or validation: validation is the last ``days`` days of each series."""
    last = df.groupBy(*series).agg(F.max(date).alias("__last"))
    cut = F.date_sub("__last", days)
    return attach(df, last, series).withColumn("part", F.when(F.col(date) < cut, "train").otherwise("validation")).drop("__last")


def drop_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def infinite_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: finite_or_null(f.name) for f in df.schema.fields if f.dataType.typeName() in ("double", "float")})


def sorted_columns(df: DataFrame, not_features: Sequence[str] = ("y", "Key", "ds")) -> tuple[DataFrame, list[str]]:
    """Columns in name order, and the feature names among them."""
    names = sorted(df.columns)
    return df.select(*names), [n for n in names if n not in not_features]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key. The rank filter is pushed below the shuffle, so a hot key stays small."""


    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).drop("__rank")


# Spark prunes ranked filters before the shuffle up to this rank (its default threshold).
PRUNED_RANK = 1000


def last_rows(df: DataFrame, series: Sequence[str], order: Sequence[str], n: int, rank: str = "from_end") -> DataFrame:
    """The last ``n`` rows of each series, numbered from the end.

    A small ``n`` is a ranked filter, pruned before the shuffle. A larger one counts from exact positions.
    """
    if n > PRUNED_RANK:
        rows = Panel(df, series, order).positions("__pos_here").unsplit()
        size = rows.groupBy(*series).agg(F.count(F.lit(1)).alias("__size"))
        back = (F.col("__size") - F.col("__pos_here") + 1).cast("int")
        return attach(rows, size, series).withColumn(rank, back).filter(F.col(rank) <= n).drop("__size", "__pos_here")
    w = Window.partitionBy(*series).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def duplicate_share(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Percent of rows beyond the first of their group."""
    g = df.groupBy(*subset).count()
    return g.agg((100.0 * F.sum(F.col("count") - 1) / F.sum("count")).alias("duplicate_pct"))


def missing_share(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Percent of nulls per column, one pass."""
    cols = list(cols or df.columns)
    one = df.agg(*[(100 * F.avg(F.col(c).isNull().cast("double"))).alias(c) for c in cols])
    return one.unpivot([], cols, "column_name", "missing_pct")


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per numeric column: rows, zeros, nulls and the usual moments."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(x == 0).alias("zeros"),
                F.count_if(x.isNull()).alias("nulls"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            ).alias(f"s_{c}")
        )
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[f"s_{c}" for c in cols])).alias("s")).select("s.*")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], c: str, qs: Mapping[str, float], rows_per_task: int | None = None
) -> DataFrame:
    """Exact linear-interpolated quantiles of ``c`` per key.

    The rows are read once, to count each distinct value; all else works on the counts. Keys with few distinct values go to the
    built-in exact percentile with frequencies; when one has more than a task should hold, ranks come from split running
    counts and the two bracketing values are picked by a plain aggregate.
    """
    limit = rows_per_task or session.rows_per_task(df.sparkSession)
    counted = session.cut(df.filter(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count("*").alias("__n")))
    largest = counted.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest <= limit:
        return counted.groupBy(*keys).agg(*[F.percentile(c, F.lit(q), F.col("__n")).alias(n) for n, q in qs.items()])
    ranked = Panel(counted, keys, [c], rows_per_task=limit).running_sums({"__upto": F.col("__n")}).df
    totals = counted.groupBy(*keys).agg(F.sum("__n").alias("__total"))
    ranked = attach(ranked, totals, keys)
    aggs = []
    for n, q in qs.items():
        at = (F.col("__total") - 1) * F.lit(q)
        lo, hi = F.floor(at), F.ceil(at)
        aggs += [
            F.min(F.when(F.col("__upto") > lo, F.col(c))).alias(f"__lo_{n}"),
            F.min(F.when(F.col("__upto") > hi, F.col(c))).alias(f"__hi_{n}"),
            F.max(at - lo).alias(f"__part_{n}"),
        ]
    found = ranked.groupBy(*keys).agg(*aggs)
    return found.select(
        *keys,
        *[(F.col(f"__lo_{n}") + F.col(f"__part_{n}") * (F.col(f"__hi_{n}") - F.col(f"__lo_{n}"))).alias(n) for n in qs],
    )


def flag_outliers(df: DataFrame, series: Sequence[str], c: str, quantiles: tuple[float, float] = OUTLIER_QUANTILES, **kw) -> DataFrame:
    """Mark values outside the two quantiles of their series and add the limits."""
    limits = exact_quantiles(df, series, c, {"lower_limit": quantiles[0], "upper_limit": quantiles[1]}, **kw)
    x = F.col(c)
    return attach(df, limits, series).withColumn("is_outlier", (x < F.col("lower_limit")) | (x > F.col("upper_limit")))


def scaled(df: DataFrame, series: Sequence[str], c: str, kind: str, **kw) -> DataFrame:
    """Scale a column per series: ``minmax``, ``standard`` (population) or ``robust`` (median and quartile range)."""
    x = F.col(c)
    if kind == "robust":
        stats = exact_quantiles(df, series, c, {"__q1": 0.25, "__q2": 0.5, "__q3": 0.75}, **kw)
        value = sdiv(x - F.col("__q2"), F.nullif(F.col("__q3") - F.col("__q1"), F.lit(0.0)))
    elif kind == "minmax":
        stats = df.groupBy(*series).agg(F.min(c).alias("__lo"), F.max(c).alias("__hi"))
        value = sdiv(x - F.col("__lo"), F.col("__hi") - F.col("__lo"))
    else:
        stats = df.groupBy(*series).agg(F.avg(c).alias("__m"), F.stddev_pop(c).alias("__s"))
        value = sdiv(x - F.col("__m"), "__s")
    out = attach(df, stats, series).withColumn(f"{c}_{kind}", value)
    return out.drop(*[n for n in stats.columns if n.startswith("__")])


def features_and_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Feature vector and label, rows with gaps dropped."""
    from pyspark.ml.feature import VectorAssembler

    rows = df.na.drop(subset=[*features, target])
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(rows).withColumn("label", F.col(target).cast("double"))


def history_and_forecast(history: DataFrame, forecast: DataFrame, price: str, predicted: str) -> DataFrame:
    """One series of past prices and predictions, labelled by class."""
    both = history.withColumn("class", F.lit("Historical")).unionByName(
        forecast.withColumn("class", F.lit("Forecast")), allowMissingColumns=True
    )
    zero = F.lit(0.0)
    return both.withColumn("price", F.coalesce(F.col(price), zero) + F.coalesce(F.col(predicted), zero))


def corrected(df: DataFrame, fixes: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """Replace ``c`` where ``fixes`` (keys, c) has a value."""
    new = fixes.select(*keys, F.col(c).alias("__fix"))
    return matched(df, new, keys).withColumn(c, F.coalesce("__fix", c)).drop("__fix")


def year_flag(date: str, year: int = FLAGGED_YEAR) -> Column:
    return (F.year(date) == year).cast("int")


def forecast_card(df: DataFrame, series: Sequence[str], c: str) -> DataFrame:
    """Lowest and highest forecast, their distance, and that distance in percent of the lowest."""
    lo, hi = F.min(c), F.max(c)
    return df.groupBy(*series).agg(
        lo.alias("lowest"), hi.alias("highest"), (hi - lo).alias("amplitude"), (100 * sdiv(hi - lo, lo)).alias("amplitude_pct")
    )



"""Readers of panels: files, tables, stacked histories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.operators.cleaning import first_per_key


def read_panel(spark: SparkSession, path: str, schema: T.StructType | str, dates: Sequence[str] = (), fmt: str = "csv") -> DataFrame:
    """Read a panel with a stated schema; ``dates`` are cut to the day."""
    reader = spark.read.schema(schema)
    df = reader.csv(path, header=True) if fmt == "csv" else reader.format(fmt).load(path)
    return df.withColumns({c: F.to_date(c) for c in dates})


def read_table_except(spark: SparkSession, table: str, cols: Sequence[str]) -> DataFrame:
    """A table without the named columns; they are pruned at the scan."""
    return spark.table(table).drop(*cols)


def stack_histories(df: DataFrame, timestamp: str, series: str | Column, name: str = "TICKER") -> DataFrame:
    """History rows of many series: day dates, a series column, upper-case names.

    ``series`` may be a column of the files' own or come from their path.
    """
    key = F.col(series) if isinstance(series, str) else series
    out = df.withColumn(name, key).withColumn("DATE", F.to_date(timestamp))
    drop = [c for c in (timestamp, series if isinstance(series, str) else None) if c and c.upper() not in ("DATE", name)]
    out = out.drop(*drop)
    return out.toDF(*[c.upper() for c in out.columns])


def series_from_path(pattern: str = r"([^/]+)\.[^./]+$") -> Column:
    """Series name taken from the file each row came from."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def append_latest(history: DataFrame, latest: DataFrame, series: Sequence[str], date: str) -> DataFrame:
    """Add the newest row per series; a row already in the history for that date is replaced."""
    both = history.withColumn("__age", F.lit(1)).unionByName(latest.withColumn("__age", F.lit(0)), allowMissingColumns=True)
    return first_per_key(both, [*series, date], [F.col("__age")]).drop("__age")


def read_params(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tuned parameters stored as one JSON object per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def conform(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly the stated columns and types; absent columns become null."""
    have = set(df.columns)
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in schema.items()])

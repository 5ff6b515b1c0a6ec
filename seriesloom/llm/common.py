"""What the corpus operators share: code shipping, shared folders, word columns, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom import session

#: The white space that separates words, as a class for regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


#: Rows of an Arrow batch, where the session has not chosen: texts are long, and a batch is held on both sides at once.
BATCH_KEY, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", 1_000


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers, and keep Arrow batches of texts small."""
    session.ship(spark)
    if spark.conf.get(BATCH_KEY, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, BATCH_ROWS)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of the data folder, with the session prepared."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that every executor reaches: below spark.checkpoint.dir, else below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/seriesloom-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, and lost executors cost nothing."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body names it in a lambda."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def column_rows(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``rows`` rows."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def binomial_upto(n: int, m: int, p: float) -> float:
    """P(X <= m) for X binomial(n, p)."""
    term, total = (1 - p) ** n, 0.0
    for k in range(m + 1):
        total += term
        term *= (n - k) / (k + 1) * p / (1 - p)
    return min(1.0, total)

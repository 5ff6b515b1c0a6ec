"""Sinks with fixed schemas."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.sources.readers import conform


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    session._ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/out-{uuid.uuid4().hex}"


def write_dataset(df: DataFrame, folder: str, name: str, fmt: str = "parquet") -> str:
    path = f"{folder}/{name}"
    df.write.mode("overwrite").format(fmt).option("header", True).save(path)
    return path


def write_datasets(frames: Mapping[str, DataFrame], folder: str, prefix: str, fmt: str = "csv") -> list[str]:
    """Several named tables, each overwritten."""
    return [write_dataset(df, folder, f"{prefix}_{name}", fmt) for name, df in frames.items()]


def append_facts(df: DataFrame, path: str, schema: Mapping[str, str], partition: str = "run_date") -> None:
    """Append rows of a fact table, created on first use; the schema never drifts."""
    conform(df, schema).write.mode("append").partitionBy(partition).parquet(path)


def replace_run(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Write the rows of a run, each combination of ``partitions`` (run date, and model where models run apart) in its own place.

    What is already there under the same values is replaced, all else stays. So a job that is run again, or retried after it was cut short,
    never doubles its rows, as a plain append would.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_params(best: DataFrame, folder: str) -> None:
    """One JSON object per kind of model: its best parameters, in a folder named by the kind."""
    best.select("kind", "params", "mape").write.mode("overwrite").partitionBy("kind").json(folder)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Quoted CSV with a header, one file per partition or, for tables known to be small, a single file."""
    (
        (df.coalesce(1) if single_file else df)
        .write.mode("overwrite")
        .option("header", True)
        .option("sep", ",")
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def month_table_name(spark: SparkSession, base: str) -> str:
    """``base`` with the short name of the current month."""
    return f"{base}_{spark.range(1).select(F.lower(F.date_format(F.current_date(), 'MMM'))).first()[0]}"


def replace_table(df: DataFrame, name: str, path: str | None = None, bucket: tuple[int, Sequence[str]] | None = None) -> str:
    """Create or replace a table. Bucketing on the join key lets later joins skip the exchange."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    if bucket:
        w = w.bucketBy(bucket[0], *bucket[1])
    w.saveAsTable(name)
    return name

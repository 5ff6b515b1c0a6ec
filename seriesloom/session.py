"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK_KEY = "spark.seriesloom.rowsPerTask"
DEFAULT_ROWS_PER_TASK = 1_000_000


def rows_per_task(spark: SparkSession) -> int:
    """Most rows of one series a single window task may hold before the series is split."""
    return int(spark.conf.get(ROWS_PER_TASK_KEY, str(DEFAULT_ROWS_PER_TASK)))


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/seriesloom-checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    The folder is ``spark.checkpoint.dir``, else below the warehouse; both are shared on a cluster. Set
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` at the start of the session to have it cleaned.

    The result no longer depends on shuffle files, so it outlives lost executors, and its
    rows are frozen: two readers see the same partition layout.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash rows over all shuffle partitions before grouped Python work.

    Adaptive execution merges partitions that are small in bytes; Python groups are dear in time
    instead, and an explicit count is left alone. The grouping reuses this exchange.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys) if keys else df


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application.

    Not needed when it is installed on the executors or passed with ``--py-files``.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="seriesloom-py-"), "seriesloom")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, "seriesloom"))
    _shipped.add(app)

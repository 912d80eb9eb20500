"""Intermediate tables that are read several times."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a lookup table that are sent to every task; larger ones are joined by shuffle.
MOST_BROADCAST_ROWS = 1_000_000

_PERSISTED: weakref.WeakSet = weakref.WeakSet()


def stage(df: DataFrame) -> DataFrame:
    """``df`` for several readers.

    Where the session names a checkpoint folder, the table is written there, which cuts its lineage
    and survives lost executors. Elsewhere it is kept by the executors; every draw is hashed from
    row keys, so a part that is lost is recomputed to the same rows.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir():
        return df.checkpoint()
    kept = df.persist()
    _PERSISTED.add(kept)
    return kept


def release() -> None:
    """Let go of what :func:`stage` had the executors keep. Checkpoints are Spark's to clean."""
    for df in list(_PERSISTED):
        df.unpersist()
    _PERSISTED.clear()


def lookup(df: DataFrame) -> DataFrame:
    """``df`` staged, and marked for broadcast if its counted rows are few."""
    staged = stage(df)
    return F.broadcast(staged) if staged.count() <= MOST_BROADCAST_ROWS else staged


UNITS_PER_TASK = 1_000_000
_LEAST_UNITS_PER_TASK = 50_000


def work_width(spark: SparkSession, units: int) -> int:
    """Partitions for rows that stand for ``units`` rows in all, which their bytes do not show."""
    spread = min(spark.sparkContext.defaultParallelism, -(-units // _LEAST_UNITS_PER_TASK))
    return max(1, spread, -(-units // UNITS_PER_TASK))


def shared_folder(spark: SparkSession) -> str:
    """Where all machines can read what one has written: the checkpoint folder, else the warehouse."""
    return spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")

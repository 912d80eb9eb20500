"""What the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that are sent to Python at once at most. Texts are long, and a worker holds a batch several times.
ROWS_A_BATCH = 500


def bounded_batches(spark: SparkSession) -> None:
    """Have the session send smaller Arrow batches; called by the queries and the pipeline."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_A_BATCH:
        spark.conf.set(name, str(ROWS_A_BATCH))


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Where it names none, a local session gets one of its own; a cluster must name one that all
    machines share.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
            folder = tempfile.mkdtemp(prefix="surgecast-llm-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept as a checkpoint, so that it survives executors; for small tables."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Narrow rows that one task works on; larger tables are spread over the shuffle partitions.
ROWS_A_TASK = 250_000


def sized(df: DataFrame) -> DataFrame:
    """``df`` as by :func:`cut`; if one task can work on its counted rows, as one partition, which needs no shuffles."""
    kept = cut(df)
    rows, last = kept.select(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)), F.max("part")).first()
    if rows > ROWS_A_TASK:
        return kept
    return (cut(kept.repartition(1)) if last else kept).coalesce(1)


#: Has Spark delete the shuffle files of a query when it ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept as a Parquet table in the checkpoint folder; for larger ones.

    What was shuffled for it is not needed again and leaves the disk at once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def unit_bits(*key: Column) -> Column:
    """52 bits of the MD5 of the key's parts, null as the word null, joined by colons."""
    parts = [F.coalesce(k.cast("string"), F.lit("null")) for k in key]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def row_pairs(starts: np.ndarray, ends: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of the same group, in blocks of about ``most``; ``ends`` are those of each row's group."""
    left = ends - starts - 1
    upto = np.cumsum(left)
    first = 0
    while first < len(starts):
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + most, side="right")))
        some = left[first:last]
        i = np.repeat(starts[first:last], some)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(some) - some, some)
        if len(i):
            yield i, j
        first = last

"""Stored results: single scenarios replaced, and a manifest that tells a whole run from a broken one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest"
_SCHEMA = "name string, scenario_label string, n long, content string"


def replace_scenarios(df: DataFrame, path: str) -> None:
    """Write a table of scenarios, one directory each; scenarios that ``df`` does not hold stay as they are.

    A scenario without any row would leave its old rows behind, so check what ``df`` holds before.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scenario_label").parquet(path)


def _contents(df: DataFrame, name: str) -> DataFrame:
    """(name, scenario_label, n, content): rows and a checksum of each scenario, in any order of rows."""
    label = F.col("scenario_label").cast("string") if "scenario_label" in df.columns else F.lit(None).cast("string")
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)")
    return df.groupBy(label.alias("scenario_label")).agg(F.count(F.lit(1)).alias("n"), F.sum(row).cast("string").alias("content")).select(F.lit(name).alias("name"), "scenario_label", "n", "content")


def _stored(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [_contents(spark.read.parquet(f"{folder}/{name}"), name) for name in names])


def open_run(spark: SparkSession, folder: str) -> None:
    """From now on the folder counts as unfinished."""
    spark.createDataFrame([], _SCHEMA).write.mode("overwrite").parquet(f"{folder}/{MANIFEST}")


def seal_run(spark: SparkSession, folder: str, names: Sequence[str]) -> None:
    """Write the manifest: what every table holds, as read back. It is the last thing that a run writes."""
    _stored(spark, folder, names).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{MANIFEST}")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(f"{folder}/{MANIFEST}")


def broken_tables(spark: SparkSession, folder: str) -> DataFrame:
    """(name, scenario_label): scenarios of tables that hold something else than the manifest says.

    Raises if the last run did not finish.
    """
    told = manifest(spark, folder)
    names = [r["name"] for r in told.select("name").distinct().collect()]  # the tables of a study
    if not names:
        raise ValueError(f"the last run into {folder!r} did not finish")
    held, columns = _stored(spark, folder, sorted(names)), ["name", "scenario_label"]
    return told.exceptAll(held).select(*columns).union(held.exceptAll(told).select(*columns)).distinct()

"""Line lists stored by person, so that what a study finds per person needs no exchange.

A stored line list is a Parquet folder of buckets hashed by ``person_id``, the rows of each file in
order of onset: all rows of a person are in one file, and a window of onsets skips most row groups.
A person with more than ``most_rows`` rows would make one bucket large; such persons are kept in a
folder beside it, unbucketed, and worked on by partial aggregation as any other table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.operators.staging import MOST_BROADCAST_ROWS, stage

#: Rows of one person that a bucket may hold.
MOST_ROWS = 100_000
CROWDED = "_crowded"


@dataclass(frozen=True)
class PersonRows:
    """A line list by person: ``regular`` is bucketed by person_id, ``crowded`` has the persons with most rows, or is None."""

    regular: DataFrame
    crowded: DataFrame | None
    name: str  # of the bucketed table in the session's catalog

    def all(self) -> DataFrame:
        return self.regular if self.crowded is None else self.regular.unionByName(self.crowded)


LineList = DataFrame | PersonRows


def per_person(rows: LineList, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` of all rows, where it treats each person by itself."""
    if isinstance(rows, DataFrame):
        return work(rows)
    done = work(rows.regular)
    return done if rows.crowded is None else done.unionByName(work(rows.crowded))


def all_rows(rows: LineList) -> DataFrame:
    return rows if isinstance(rows, DataFrame) else rows.all()


def _declare(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> str:
    """A table of the session's catalog over a folder of buckets."""
    name = f"surgecast_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (person_id) SORTED BY (date_onset) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return name


def store_by_person(rows: DataFrame, path: str, buckets: int, most_rows: int = MOST_ROWS) -> PersonRows:
    """Write a line list by person and read it back.

    The rows are computed once. Persons are counted by partial aggregation; those beyond
    ``most_rows`` are at most rows / most_rows.
    """
    spark = rows.sparkSession
    staged = stage(rows)
    count = staged.groupBy("person_id").agg(F.count(F.lit(1)).alias("rows"))
    crowded = stage(count.where(F.col("rows") > most_rows).select("person_id"))
    n_crowded = crowded.count()
    regular, beside = staged, staged.limit(0)
    if n_crowded:
        ids = crowded.select(F.col("person_id").alias("_person"))
        ids = F.broadcast(ids) if n_crowded <= MOST_BROADCAST_ROWS else ids
        same = F.col("person_id").eqNullSafe(F.col("_person"))
        regular, beside = staged.join(ids, same, "left_anti"), staged.join(ids, same, "left_semi")
    name = _declare(spark, path, rows.schema, buckets)
    regular.repartition(buckets, "person_id").write.insertInto(name, overwrite=True)
    beside.write.mode("overwrite").parquet(path + CROWDED)
    return PersonRows(spark.table(name), spark.read.schema(rows.schema).parquet(path + CROWDED) if n_crowded else None, name)


def read_by_person(spark: SparkSession, path: str, buckets: int) -> PersonRows:
    """A stored line list, in any session; ``buckets`` as it was stored."""
    schema = spark.read.parquet(path).schema
    crowded = spark.read.schema(schema).parquet(path + CROWDED)
    name = _declare(spark, path, schema, buckets)
    return PersonRows(spark.table(name), None if crowded.isEmpty() else crowded, name)


def forget(rows: PersonRows) -> None:
    """Take the table out of the session's catalog; its files stay."""
    rows.regular.sparkSession.sql(f"DROP TABLE IF EXISTS {rows.name}")

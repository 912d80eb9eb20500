"""Unions of intervals of days, and how many cover a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Tasks of a union for each shuffle partition: they hold and order all their intervals, so each gets few.
TASKS_A_PARTITION = 4


def interval_union(df: DataFrame, keys: Sequence[str], first: str, last: str, *, spread: bool = True) -> DataFrame:
    """(keys.., first, last): the days covered per key as disjoint intervals, ends included.

    Intervals of any length; those that touch or overlap become one. NULL ends and reversed
    intervals cover nothing. Intervals are dealt by key and first day and merged there, so a key
    sends a task that orders it at most one row per day, however many intervals it has. Without ``spread``
    they stay where they are, for a table that is stored by key.
    """
    known = df.where(F.col(last) >= F.col(first))
    tasks = TASKS_A_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if spread:
        known = known.repartition(tasks, *keys, first)
    longest = known.groupBy(*keys, first).agg(F.max(last).alias(last))
    if spread:
        longest = longest.repartition(tasks, *keys)
    order = Window.partitionBy(*keys).orderBy(first)
    reached = F.max(last).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col(first) > F.date_add(reached, 1)), 1).otherwise(0)
    islands = longest.withColumn("_new", begins).withColumn("_island", F.sum("_new").over(order))
    return islands.groupBy(*keys, "_island").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("_island")


def daily_cover(spans: DataFrame, first: str, last: str, series: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(by.., date, next, series..): how many intervals cover the days from ``date`` to before ``next``.

    ``series`` counts the intervals for which its condition holds. Each interval adds one on its first day and takes it
    off after its last; these changes are summed per day before the running sum, so what is ordered
    is one row per day of change. The last row of a series has no ``next``, and covers nothing.
    """
    marks = F.array(
        F.struct(F.col(first).alias("date"), F.lit(1).alias("sign")), F.struct(F.date_add(last, 1).alias("date"), F.lit(-1).alias("sign"))
    )
    flags = [c.cast("int").alias(n) for n, c in series.items()]
    changes = spans.select(*by, *flags, F.explode(marks).alias("m")).select(*by, *series, "m.*")
    daily = changes.groupBy(*by, "date").agg(*[F.sum(F.col(n) * F.col("sign")).cast("bigint").alias(n) for n in series])
    running = Window.partitionBy(*by).orderBy("date")
    return daily.select(*by, "date", F.lead("date").over(running).alias("next"), *[F.sum(n).over(running).alias(n) for n in series])

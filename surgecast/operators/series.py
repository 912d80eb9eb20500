"""Ordered operators on partitioned series: rolling windows, filling, interpolation, first rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rows(partition: Sequence[str], *order: Column):
    return Window.partitionBy(*partition).orderBy(*order)


def rolling_extend(
    df: DataFrame,
    values: Mapping[str, str],
    width: int,
    how: str,
    partition: Sequence[str],
    order: str,
) -> DataFrame:
    """Centred rolling ``sum`` or ``mean`` over ``width`` rows; ``values`` maps output to input.

    The first and last rows, whose window is incomplete, take the nearest full-window value. A
    series shorter than ``width`` has no full window and is NULL throughout.
    """
    half = width // 2
    ordered = _rows(partition, F.col(order))
    frame = ordered.rowsBetween(-half, half)
    whole = Window.partitionBy(*partition)
    agg = {"sum": F.sum, "mean": F.avg}[how]

    raw = {f"_w_{out}": agg(F.col(col)).over(frame) for out, col in values.items()}
    step = df.withColumns({**raw, "_rn": F.row_number().over(ordered), "_len": F.count(F.lit(1)).over(whole)})
    rn, length = F.col("_rn"), F.col("_len")
    extended = {}
    for out in values:
        full = F.col(f"_w_{out}")
        head = F.max(F.when(rn == half + 1, full)).over(whole)
        tail = F.max(F.when(rn == length - half, full)).over(whole)
        extended[out] = F.when(
            length >= width, F.when(rn <= half, head).when(rn > length - half, tail).otherwise(full)
        )
    return step.withColumns(extended).drop("_rn", "_len", *raw)


def rolling_mean_full(value: str, width: int, partition: Sequence[str], order: str) -> Column:
    """Centred rolling mean by row position; NULL where the window is incomplete."""
    half = width // 2
    frame = _rows(partition, F.col(order)).rowsBetween(-half, half)
    return F.when(F.count(value).over(frame) == width, F.avg(value).over(frame))


def fill_downup(df: DataFrame, values: Sequence[str], partition: Sequence[str], order: str) -> DataFrame:
    """Replace NULLs by the last known value, and leading NULLs by the first known one."""
    down = _rows(partition, F.col(order)).rowsBetween(Window.unboundedPreceding, 0)
    up = _rows(partition, F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns(
        {
            v: F.coalesce(F.last(v, ignorenulls=True).over(down), F.last(v, ignorenulls=True).over(up))
            for v in values
        }
    )


def interpolate(
    df: DataFrame,
    values: Sequence[str],
    partition: Sequence[str],
    order: str,
    *,
    by_date: bool = False,
    extend_ends: bool = False,
) -> DataFrame:
    """Linear interpolation of NULLs between known neighbours.

    Distance is counted in rows, or in days of ``order`` with ``by_date``. Beyond the first and
    last known value the result is NULL, or that value with ``extend_ends``. Both neighbours come
    from running windows (one ascending, one descending), so the cost is linear in the series.
    """
    ascending = _rows(partition, F.col(order))
    down = ascending.rowsBetween(Window.unboundedPreceding, 0)
    up = _rows(partition, F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    position = F.unix_date(F.col(order)) if by_date else F.row_number().over(ascending)

    df = df.withColumn("_pos", position)
    known = {v: F.when(F.col(v).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(v).alias("v"))) for v in values}
    df = df.withColumns({f"_prev_{v}": F.last(known[v], ignorenulls=True).over(down) for v in values})
    df = df.withColumns({f"_next_{v}": F.last(known[v], ignorenulls=True).over(up) for v in values})

    filled = {}
    for v in values:
        before, after = F.col(f"_prev_{v}"), F.col(f"_next_{v}")
        share = (F.col("_pos") - before["p"]) / (after["p"] - before["p"])
        line = F.when(before.isNotNull() & after.isNotNull(), before["v"] + (after["v"] - before["v"]) * share)
        if extend_ends:
            line = F.coalesce(line, before["v"], after["v"])
        filled[v] = F.when(F.col(v).isNotNull(), F.col(v)).otherwise(line)
    return df.withColumns(filled).drop("_pos", *[f"_prev_{v}" for v in values], *[f"_next_{v}" for v in values])


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in the given total order.

    Spark plans ``row_number() == 1`` as a group limit on both sides of the exchange, so a key
    holding a large share of the rows sends one row per task, not all of them.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")

"""Ordered operators on one series that is too long for a task.

Rows are sorted into ranges and numbered; blocks of consecutive numbers are then worked on by
themselves. A rolling window needs some rows of the neighbouring blocks, which are copied as a
halo. Filling and interpolation carry the last known value over from the blocks before, and the first known one back
from those behind: the driver sees one row a block, of which there are at most MOST_BLOCKS.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.operators.staging import stage

ROWS_A_BLOCK = 100_000
MOST_BLOCKS = 4096


@dataclass(frozen=True)
class LongSeries:
    """A numbered series: ``rows`` has ``_rn`` (from 0) beside its columns; ``block`` rows belong together."""

    rows: DataFrame
    n: int
    block: int

    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c != "_rn"]

    def blocked(self) -> DataFrame:
        return self.rows.withColumn("_block", F.expr(f"_rn div {self.block}"))


def long_series(df: DataFrame, order: Sequence[str], rows_a_block: int = ROWS_A_BLOCK) -> LongSeries:
    """Sort and number ``df`` by ``order``, which tells all rows apart. The table is kept, as several readers follow."""
    ranged = stage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranged.select("*", F.spark_partition_id().alias("_task"), in_task.alias("_at"))
    counts = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).orderBy("_task").collect()  # one row a task
    starts, n = [], 0
    for r in counts:
        starts.append((r["_task"], n))
        n += r["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_task int, _start long")
    numbered = placed.join(F.broadcast(offsets), "_task").withColumn("_rn", F.col("_start") + F.col("_at"))
    return LongSeries(numbered.drop("_task", "_at", "_start"), n, max(rows_a_block, -(-n // MOST_BLOCKS)))


def _windowed(series: LongSeries, values: Mapping[str, str], width: int, how: str) -> DataFrame:
    """The rows with a count and an aggregate of the rows up to half a width away, for each value."""
    half = width // 2
    if series.block < half:
        raise ValueError("a block must hold the rows that a window reaches over")
    at, block = F.expr(f"_rn % {series.block}"), F.col("_block")
    homes = F.array_compact(F.array(block, F.when(at < half, block - 1), F.when(at >= series.block - half, block + 1)))
    spread = series.blocked().withColumn("_home", F.explode(homes))
    frame = Window.partitionBy("_home").orderBy("_rn").rowsBetween(-half, half)
    agg = {"sum": F.sum, "mean": F.avg}[how]
    rolled = spread.withColumns({out: agg(col).over(frame) for out, col in values.items()} | {"_reach": F.count(F.lit(1)).over(frame)})
    return rolled.where(F.col("_home") == F.col("_block"))


def rolling_mean_full_long(series: LongSeries, values: Mapping[str, str], width: int) -> DataFrame:
    """Centred rolling mean; NULL where the window is incomplete or holds a NULL."""
    marks = {f"_known_{out}": F.col(col).isNotNull().cast("int") for out, col in values.items()}
    marked = LongSeries(series.rows.withColumns(marks), series.n, series.block)
    rolled = _windowed(marked, {**values, **{f"_n_{out}": f"_known_{out}" for out in values}}, width, "mean")
    full = {out: F.when((F.col("_reach") == width) & (F.col(f"_n_{out}") == 1), F.col(out)) for out in values}
    return rolled.withColumns(full).select(*series.columns(), *values)


def rolling_extend_long(series: LongSeries, values: Mapping[str, str], width: int, how: str) -> DataFrame:
    """As :func:`rolling_extend` on a series without partition: rows with an incomplete window take the nearest full one's value."""
    half = width // 2
    rolled = _windowed(series, values, width, how)
    if series.n < width:
        return rolled.withColumns({out: F.lit(None).cast(rolled.schema[out].dataType) for out in values}).select(*series.columns(), *values)
    agg = {"sum": F.sum, "mean": F.avg}[how]
    ends = []
    for first in (0, series.n - width):  # of each end, one window
        window = series.rows.where((F.col("_rn") >= first) & (F.col("_rn") < first + width))
        ends.append(window.agg(*[agg(col).alias(out) for out, col in values.items()]).first())
    kinds = {out: rolled.schema[out].dataType for out in values}
    edge = {
        out: F.when(F.col("_rn") < half, F.lit(ends[0][out]).cast(kinds[out])).when(F.col("_rn") >= series.n - half, F.lit(ends[1][out]).cast(kinds[out])).otherwise(F.col(out))
        for out in values
    }
    return rolled.withColumns(edge).select(*series.columns(), *values)


def _with_neighbours(series: LongSeries, values: Sequence[str]) -> DataFrame:
    """The rows with ``_prev_v`` and ``_next_v``: (p, v) of the last known value up to a row, and of the first from it on."""
    rows = series.blocked()
    known = {v: F.when(F.col(v).isNotNull(), F.struct(F.col("_rn").alias("p"), F.col(v).alias("v"))) for v in values}
    ends = rows.groupBy("_block").agg(*[f(known[v]).alias(f"{name}_{v}") for v in values for name, f in (("first", F.min), ("last", F.max))])
    ends = ends.orderBy("_block").collect()  # at most MOST_BLOCKS rows
    carried: list[dict] = [{"_block": r["_block"]} for r in ends]
    for v in values:
        seen = None
        for r, c in zip(ends, carried, strict=True):
            c[f"_before_{v}"] = seen
            seen = r[f"last_{v}"] or seen
        seen = None
        for r, c in zip(reversed(ends), reversed(carried), strict=True):
            c[f"_behind_{v}"] = seen
            seen = r[f"first_{v}"] or seen
    pair = {v: T.StructType([T.StructField("p", T.LongType()), T.StructField("v", rows.schema[v].dataType)]) for v in values}
    schema = T.StructType([T.StructField("_block", T.LongType())] + [T.StructField(f"_{s}_{v}", pair[v]) for v in values for s in ("before", "behind")])
    names = [f.name for f in schema]
    carry = series.rows.sparkSession.createDataFrame([tuple(c[n] for n in names) for c in carried], schema)
    down = Window.partitionBy("_block").orderBy("_rn").rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("_block").orderBy(F.col("_rn").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(F.broadcast(carry), "_block")
    near: dict[str, Column] = {}
    for v in values:
        near[f"_prev_{v}"] = F.coalesce(F.last(known[v], ignorenulls=True).over(down), F.col(f"_before_{v}"))
        near[f"_next_{v}"] = F.coalesce(F.last(known[v], ignorenulls=True).over(up), F.col(f"_behind_{v}"))
    return rows.withColumns(near)


def fill_downup_long(series: LongSeries, values: Sequence[str]) -> DataFrame:
    """Replace NULLs by the last known value, and leading NULLs by the first known one."""
    filled = {v: F.coalesce(F.col(f"_prev_{v}.v"), F.col(f"_next_{v}.v")) for v in values}
    return _with_neighbours(series, values).withColumns(filled).select(*series.columns())


def interpolate_long(series: LongSeries, values: Sequence[str], *, extend_ends: bool = False) -> DataFrame:
    """Linear interpolation of NULLs between known neighbours, counted in rows; beyond the ends NULL, or the end's value."""
    filled = {}
    for v in values:
        before, after = F.col(f"_prev_{v}"), F.col(f"_next_{v}")
        share = (F.col("_rn") - before["p"]) / (after["p"] - before["p"])
        line = F.when(before.isNotNull() & after.isNotNull(), before["v"] + (after["v"] - before["v"]) * share)
        if extend_ends:
            line = F.coalesce(line, before["v"], after["v"])
        filled[v] = F.when(F.col(v).isNotNull(), F.col(v)).otherwise(line)
    return _with_neighbours(series, values).withColumns(filled).select(*series.columns())

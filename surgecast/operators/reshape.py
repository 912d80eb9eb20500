"""Row expansion, interval expansion and gap filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgecast.operators.staging import work_width

ROWS_PER_CHUNK = 10_000
CHUNKS_PER_BLOCK = 1_000


def chunk_rows(df: DataFrame, n: Column, keys: Sequence[str]) -> DataFrame:
    """Cut rows that stand for ``n`` units each into chunks ``_chunk`` = 0, 1, ... of ``_size`` units.

    The counts may be very uneven (one row can hold a third of everything), so the chunks, not the
    rows, are spread over the tasks, by (``keys``, chunk). They are numbered in blocks, so that no
    row holds more than a block's numbers, after the rows are spread by ``keys``. The number of tasks follows
    the total, which is summed first: ``df`` is read twice. None for ``n`` < 1 or NULL.
    """
    counted = df.withColumn("_n", n.cast("bigint")).where(F.col("_n") >= 1)
    units = counted.agg(F.sum("_n")).first()[0] or 0
    width = work_width(df.sparkSession, units)
    chunks = F.expr(f"(_n - 1L) div {ROWS_PER_CHUNK}L")
    blocks = (
        counted.withColumn("_last", chunks)
        .repartition(*keys)
        .withColumn("_block", F.explode(F.expr(f"sequence(0L, _last div {CHUNKS_PER_BLOCK}L)")))
    )
    inside = f"sequence(_block * {CHUNKS_PER_BLOCK}L, least(_last, _block * {CHUNKS_PER_BLOCK}L + {CHUNKS_PER_BLOCK - 1}L))"
    return (
        blocks.withColumn("_chunk", F.explode(F.expr(inside)))
        .withColumn("_size", F.expr(f"least(_n - _chunk * {ROWS_PER_CHUNK}L, {ROWS_PER_CHUNK}L)"))
        .drop("_n", "_last", "_block")
        .repartition(width, *keys, "_chunk")
    )


def number_chunks(chunks: DataFrame, out: str) -> DataFrame:
    """Multiply chunks out to one row per unit, numbered 1.._size within its chunk."""
    return chunks.withColumn(out, F.explode(F.expr("sequence(1L, _size)"))).drop("_size")


def expand_counts(df: DataFrame, count: str, *, corrected: bool = False) -> DataFrame:
    """One row per counted unit.

    A count of zero yields two rows (it runs 1, 0) and a negative count runs down to it; with
    ``corrected`` both yield none. NULL counts yield none.
    """
    c = F.col(count).cast("bigint")
    n = F.when(c >= 1, c)
    if not corrected:
        n = n.otherwise(F.lit(2) - c)
    keys = [c for c in df.columns if c != count]
    return number_chunks(chunk_rows(df, n, keys), "_unit").select(*keys)


def stay_days(df: DataFrame, start: Column, end: Column, out: str = "date") -> DataFrame:
    """One row per day of the inclusive interval; empty or unknown intervals vanish."""
    return df.where(end >= start).withColumn(out, F.explode(F.sequence(start, end, F.expr("interval 1 day"))))


def complete_daily(
    df: DataFrame,
    date: str,
    keys: Sequence[str],
    fill: Mapping[str, object] | None = None,
    *,
    within: Sequence[str] = (),
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Make every combination of the distinct ``keys`` values and every day explicit.

    ``df`` has one row per (within, date, keys), as counts do. Days run from the first to the last
    in ``df`` per ``within`` group, or from ``start`` to ``end``, which are expressions over the
    ``within`` columns. Rows outside the grid are kept. ``fill`` also overwrites NULLs that were
    there before.

    ``keys`` are dimension columns (age band, bootstrap): their distinct values are gathered per
    ``within`` group by a partially aggregated ``collect_set`` and multiplied out by ``explode``,
    so nothing pairs rows. The grid is merged by union and aggregation on one exchange by
    (within, keys), the partitioning that series windows on the result need next. ``df`` is read
    twice: stage it if it is expensive.
    """
    within, keys = list(within), list(keys)
    first = F.min(date) if start is None else F.lit(None)
    last = F.max(date) if end is None else F.lit(None)
    dims = df.groupBy(*within).agg(
        first.alias("_start"), last.alias("_end"), *[F.collect_set(k).alias(k) for k in keys]
    )
    days = F.sequence(
        F.col("_start") if start is None else start,
        F.col("_end") if end is None else end,
        F.expr("interval 1 day"),
    )
    ordered = (F.col("_start") if start is None else start) <= (F.col("_end") if end is None else end)
    grid = dims.where(ordered).withColumn(date, F.explode(days))
    for k in keys:
        grid = grid.withColumn(k, F.explode(k))
    cell = [*within, date, *keys]
    values = [c for c in df.columns if c not in cell]
    merged = df.unionByName(grid.select(cell), allowMissingColumns=True)
    if within or keys:
        merged = merged.repartition(*within, *keys)
    out = merged.groupBy(*cell).agg(*[F.max(v).alias(v) for v in values])
    if fill:
        out = out.fillna(dict(fill))
    return out.select(df.columns)


def fill_daily_gaps(
    daily: DataFrame,
    date: str,
    values: Sequence[str],
    partition: Sequence[str] = (),
    *,
    fill: object = 0,
    drop_last: bool = False,
) -> DataFrame:
    """Insert a row for each missing day between the rows of a daily series.

    ``daily`` has one row per (partition, day); inserted rows have ``fill`` in ``values``, and so do
    NULLs that were there before. Without ``partition`` the table is one series of a few thousand
    days at most, where a single ordered window is cheap and saves a second pass for the bounds.
    """
    following = F.lead(date).over(Window.partitionBy(*partition).orderBy(date))
    until = F.date_sub("_next", 1)
    if not drop_last:
        until = F.coalesce(until, F.col(date))
    gaps = daily.withColumn("_next", following).withColumn("_until", until)
    gaps = gaps.where(F.col("_until").isNotNull()).withColumn(
        "_day", F.explode(F.sequence(F.col(date), F.col("_until"), F.expr("interval 1 day")))
    )
    own = F.col("_day") == F.col(date)
    filled = {v: F.coalesce(F.when(own, F.col(v)), F.lit(fill)) for v in values}
    return gaps.withColumns(filled).withColumn(date, F.col("_day")).select(daily.columns)

"""Interval tables over an ensemble kept in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default interval levels in percent.
DEFAULT_LEVELS = (20, 30, 40, 50, 60, 70, 80, 90)


def central_intervals(
    df: DataFrame,
    ids: Sequence[str],
    value: str,
    levels: Sequence[int] = DEFAULT_LEVELS,
    *,
    frequency: str | None = None,
    ignore_nulls: bool = True,
    median: bool = False,
) -> DataFrame:
    """Central intervals of ``value`` per ``ids`` group: one row per (ids, quant, lower, upper).

    A group is one ensemble: it has at most as many rows as there are bootstraps, so the exact
    quantile, which holds a group's values, is cheap. Sum line-list rows per member first.

    Quantiles interpolate linearly between order statistics. NULL members are ignored, or make the
    whole group NULL with ``ignore_nulls=False``. ``frequency`` names an integer column that says
    how many members a row stands for.
    """
    points = sorted({p for level in levels for p in _tails(level)} | ({0.5} if median else set()))
    args = [F.col(value), F.array(*[F.lit(p) for p in points])]
    if frequency:
        args.append(F.col(frequency))
    q: Column = F.percentile(*args)
    if not ignore_nulls:
        q = F.when(F.count(value) == F.count(F.lit(1)), q)
    at = {p: i for i, p in enumerate(points)}
    rows = F.array(
        *[
            F.struct(
                F.lit(level).alias("quant"),
                F.col("_q")[at[_tails(level)[0]]].alias("lower"),
                F.col("_q")[at[_tails(level)[1]]].alias("upper"),
            )
            for level in levels
        ]
    )
    out = df.groupBy(*ids).agg(q.alias("_q"))
    picked = [*ids, F.explode(rows).alias("_r")]
    if median:
        picked.insert(len(ids), F.col("_q")[at[0.5]].alias("median"))
    out = out.select(*picked)
    return out.select(*[c for c in out.columns if c != "_r"], "_r.quant", "_r.lower", "_r.upper")


def _tails(level: int) -> tuple[float, float]:
    return (100 - level) / 200, (100 + level) / 200


def median_band(df: DataFrame, ids: Sequence[str], value: str, *, null_band: bool = False, lenient: bool = False) -> DataFrame:
    """Median and 5 % / 95 % quantiles of ``value`` per group.

    The median is NULL when any member is NULL; the band ignores NULL members, or is NULL too with
    ``null_band``. ``lenient`` ignores NULL members everywhere.
    """
    points = F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95))
    all_known = F.lit(True) if lenient else F.count(value) == F.count(F.lit(1))
    out = df.groupBy(*ids).agg(F.percentile(F.col(value), points).alias("_q"), all_known.alias("_known"))
    q = F.col("_q")
    band = F.col("_known") if null_band else F.lit(True)
    return out.select(
        *ids,
        F.when(F.col("_known"), q[1]).alias("median"),
        F.when(band, q[0]).alias("lower_90"),
        F.when(band, q[2]).alias("upper_90"),
    )

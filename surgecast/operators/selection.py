"""Exact quantiles of groups of any size, by narrowing ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgecast.operators.staging import lookup, stage

#: Parts into which a range is cut in one pass.
WAYS = 1024


def _part(x: Column) -> Column:
    """The part of [lo, hi] that a value lies in; halves keep the widest range finite."""
    lo, hi = F.col("_lo") / 2, F.col("_hi") / 2
    return F.least(F.floor((x / 2 - lo) / (hi - lo) * WAYS), F.lit(WAYS - 1)).cast("int")


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, points: Sequence[float]) -> DataFrame:
    """(group.., p, n, quantile): quantiles that interpolate linearly between order statistics.

    Each order statistic that a quantile needs is sought in a range of values, at first from the
    least to the greatest of its group. A pass counts the values in WAYS parts of every range and goes
    on with the part that holds the rank, cut down to the least and greatest value in it, until one
    value is left. Counts combine before the shuffle, so no task ever holds a group, and a pass
    cuts a range to a thousandth: few passes are needed. Values are compared as doubles; NULL, NaN and infinite
    ones are left out, and a group without any other has no row. The table is kept and read once a
    pass; the driver sees one count a pass.
    """
    group = list(group)
    x = F.col("_x")
    usable = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = stage(df.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col(value).cast("double").alias("_x")).where(usable))
    keys = [f"_g{i}" for i in range(len(group))]
    place = F.col("p") * (F.col("n") - 1)
    about = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    asked = stage(about.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in points]))))
    ranks = F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place))))
    ranges = stage(asked.withColumn("_rank", ranks).select(*keys, "_rank", "_lo", "_hi", F.lit(0).cast("long").alias("_below")).distinct())
    done = ranges.where("_lo = _hi")
    ranges = ranges.where("_lo < _hi")

    while not ranges.isEmpty():
        small = lookup(ranges.select(*[F.col(k).alias(f"{k}_") for k in keys], "_rank", "_lo", "_hi", "_below"))
        met = rows.join(small, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys] or F.lit(True)).where(x.between(F.col("_lo"), F.col("_hi")))
        by = [*keys, "_rank", "_below"]
        counts = met.groupBy(*by, _part(x).alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        upto = F.sum("_n").over(Window.partitionBy(*keys, "_rank").orderBy("_part"))
        counts = counts.withColumn("_upto", F.col("_below") + upto)
        holds = (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n"))
        narrowed = stage(counts.where(holds).select(*keys, "_rank", "_lo", "_hi", (F.col("_upto") - F.col("_n")).alias("_below")))
        done = done.unionByName(narrowed.where("_lo = _hi"))
        ranges = narrowed.where("_lo < _hi")
    found = stage(done.select(*[F.col(k).alias(f"{k}_") for k in keys], "_rank", F.col("_lo").alias("_v")))

    def at(name: str) -> DataFrame:
        return found.select(*[F.col(f"{k}_").alias(f"{k}_{name}") for k in keys], F.col("_rank").alias(f"_rank_{name}"), F.col("_v").alias(name))

    out = asked.select(*keys, "p", "n", F.floor(place).alias("_low"), F.ceil(place).alias("_high"), (place - F.floor(place)).alias("_share"))
    for name in ("_low", "_high"):
        other = at(f"{name}_v")
        on = [F.col(k).eqNullSafe(F.col(f"{k}_{name}_v")) for k in keys] + [F.col(name) == F.col(f"_rank_{name}_v")]
        out = out.join(other, on)
    quantile = F.col("_low_v") + (F.col("_high_v") - F.col("_low_v")) * F.col("_share")
    return out.select(*[F.col(k).alias(g) for k, g in zip(keys, group, strict=True)], "p", "n", quantile.alias("quantile"))

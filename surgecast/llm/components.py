"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgecast.llm.common import sized


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link to another; component is its smallest node.

    Each round hangs every node's larger neighbours under its smallest one, then its smaller ones,
    until every node hangs directly under its component's smallest: a number of rounds that grows
    with the logarithm of the longest chain. Rounds are kept in the checkpoint folder. The driver
    sees one row count and checksum a round; no node's links are gathered in one task, since minima
    combine before the shuffle and the joins have one row per node on their other side.
    """
    pairs = sized(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    seen = None
    while True:
        both = pairs.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")).select("x.*")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        hung = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = hung.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        pairs = sized(small.select("x.*").filter("u <> v").distinct())
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen = now
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node"), F.col("v").alias("component"))
    return nodes.distinct()


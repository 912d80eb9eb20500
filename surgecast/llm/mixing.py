"""Mixing sources to target weights by hierarchical budgeting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgecast.llm.common import cut, unit_bits

#: Leaves whose budgets may be broadcast; more are joined by shuffle.
BROADCAST_LEAVES = 100_000
#: Bits of the 52 of a seeded rank that name its part; token sums run over parts first, then within.
PART_BITS = 12


@dataclass(frozen=True)
class Mix:
    """What to mix. ``share``: budget as a part of all tokens. ``weights``: target weight of a node by
    its path ("web", "web/en", "web/en/src0"); other nodes weigh 1. ``epochs``: how often a leaf's
    documents may be taken at most. ``seed``: of the order within an epoch."""

    share: float = 0.75
    weights: Mapping[str, int] = field(default_factory=dict)
    epochs: int = 2
    seed: int = 7


def token_count(text: Column) -> Column:
    """Runs of characters that are not ASCII white space; 0 for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+", -1))).cast("long")


def budgets(leaves: DataFrame, levels: Sequence[str], mix: Mix) -> DataFrame:
    """Tokens to take of every leaf. ``leaves``: one row a leaf, with the levels and its ``tokens``.

    Every node can give its tokens times ``mix.epochs``. From the root down, a node's budget goes to
    its children by weight; children that cannot fill their part give what they have, and what is
    missing goes to their siblings by weight. A node is given no more than its subtree holds, so a
    shortage passes to the siblings of an ancestor only when the whole subtree is used up.
    """
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    tree = leaves.withColumn("capacity", F.col("tokens") * mix.epochs).withColumn("budget", F.lit(int(total * mix.share)).cast("long"))
    weights = F.create_map(*(F.lit(x) for pair in mix.weights.items() for x in pair)) if mix.weights else None
    for depth in range(1, len(levels) + 1):
        node = list(levels[:depth])
        weight = F.coalesce(weights[F.concat_ws("/", *node)].cast("double"), F.lit(1.0)) if weights is not None else F.lit(1.0)
        nodes = tree.groupBy(*node).agg(F.sum("capacity").alias("room"), F.max("budget").alias("whole")).withColumn("weight", weight)
        # In the order in which a common level fills them, children are full up to some child.
        siblings = Window.partitionBy(*(levels[: depth - 1] or [F.lit(0)]))
        filling = siblings.orderBy(F.col("room") / F.col("weight"), levels[depth - 1])
        filled = F.coalesce(F.sum("room").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        open_weight = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
        nodes = nodes.withColumn("full", (F.col("whole") - filled) * F.col("weight") >= F.col("room") * open_weight)
        left = F.col("whole") - F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(siblings)
        sharing = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(siblings)
        given = F.when(F.col("full"), F.col("room")).otherwise(F.floor(left * F.col("weight") / sharing)).cast("long")
        tree = tree.drop("budget").join(nodes.select(*node, given.alias("budget")), node)
    return tree


def mix_sources(df: DataFrame, key: str, text: str, levels: Mapping[str, Column], mix: Mix) -> DataFrame:
    """How often each document is taken (``copies``, 0 if never), with its leaf and tokens.

    ``levels``: the tree from the root down, as columns of ``df``; null counts as the word none.
    An epoch is all documents of a leaf in an order hashed from seed, epoch and key. A leaf with
    budget B and T tokens gives every document B div T times, and once more the first ones of the next
    epoch, up to the remaining B mod T tokens; the document in which they end is taken if at least
    half of it lies before. A document without tokens is taken if those before it leave room. Rows that repeat a key are ordered by tokens. Columns that
    are not named are not read; an empty table gives no rows.

    A leaf with a third of all rows is ordered in 2^PART_BITS parts, whose sums come first.
    """
    names = list(levels)
    docs = cut(
        df.select(
            F.col(key).alias("k"),
            token_count(F.col(text)).alias("tokens"),
            *(F.coalesce(c.cast("string"), F.lit("none")).alias(n) for n, c in levels.items()),
        )
    )
    leaves = docs.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    plan = budgets(leaves, names, mix).select(
        *names,
        F.col("budget").alias("leaf_budget"),
        F.col("tokens").alias("leaf_tokens"),
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).cast("long").alias("whole"),
    )
    plan = cut(plan.withColumn("rest", F.col("leaf_budget") - F.col("whole") * F.col("leaf_tokens")))
    ranked = docs.join(F.broadcast(plan) if plan.count() <= BROADCAST_LEAVES else plan, names).withColumn("rank", unit_bits(F.lit(mix.seed), F.col("whole"), F.col("k")))
    # Rows joined by leaf would be ordered by leaf: the parts are dealt out anew.
    ranked = ranked.withColumn("part", F.shiftright("rank", 52 - PART_BITS)).repartition(*names, "part")
    sums = ranked.groupBy(*names, "part").agg(F.sum("tokens").alias("n"))
    starts = sums.select(
        *names,
        "part",
        F.coalesce(F.sum("n").over(Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
    )
    within = Window.partitionBy(*names, "part").orderBy("rank", "k", "tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranked.withColumn("upto", F.sum("tokens").over(within)).join(starts, [*names, "part"])
    first = F.col("start") + F.col("upto") - F.col("tokens")
    return placed.select(
        F.col("k").alias(key),
        *names,
        "tokens",
        "leaf_budget",
        (F.col("whole") + (2 * first + F.col("tokens") <= 2 * F.col("rest")).cast("long")).alias("copies"),
    )

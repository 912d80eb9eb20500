"""Sharding by weighted rendezvous hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgecast.llm.common import unit_bits

#: Parts into which the rows of one shard are numbered independently.
SLOT_PARTS = 1024


def rendezvous_score(key: Column, shard: int, weight: float) -> Column:
    """The bid of a shard for a key: -weight / ln(u), u uniform in (0, 1) and fixed by key and shard."""
    u = (unit_bits(key, F.lit(shard)) + 0.5) / float(2**52)
    return F.lit(-float(weight)) / F.ln(u)


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest bid; the lowest number of equal ones.

    Bids of a shard do not depend on the other shards, so a further shard takes rows only into
    itself, and about its share of the weight.
    """
    bids = F.array(*(F.struct(rendezvous_score(key, i, w).alias("bid"), F.lit(-i).alias("order")) for i, w in enumerate(weights)))
    return (-F.array_max(bids)["order"]).cast("int")


def assign_shards(df: DataFrame, key: str, text: str, weights: Sequence[float], grown_weight: float = 1.0) -> DataFrame:
    """Shard, place within the shard and shard after growth by one, for every row.

    Columns: the key, size (UTF-8 bytes of the text plus 1; null: 1), text_crc32, law, shard, slot,
    grown_shard. A null key is hashed as the word null; rows that repeat a key share its shard and
    get slots of their own, in any order if they are equal; a null text has the checksum of the empty
    text. Other columns of ``df`` are not read. An empty table gives no rows.

    Only key, size and checksum are shuffled. Slots are numbered in SLOT_PARTS parts of each shard by
    key hash, moved up by the rows of the parts before, so that no task numbers a whole shard.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = df.select(
        F.col(key).alias("k"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
    )
    placed = keyed.withColumn("shard", rendezvous_shard(F.col("k"), weights)).withColumn(
        "part", F.pmod(unit_bits(F.col("k"), F.lit("slot")), F.lit(SLOT_PARTS))
    )
    sizes = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("k", "size", "text_crc32")
    numbered = placed.withColumn("place", F.row_number().over(within) - 1).join(starts, ["shard", "part"])
    old = F.array_max(F.array(*(rendezvous_score(F.col("k"), i, w) for i, w in enumerate(weights))))
    new = rendezvous_score(F.col("k"), len(weights), grown_weight)
    return numbered.select(
        F.col("k").alias(key),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("start") + F.col("place")).cast("long").alias("slot"),
        F.when(new > old, F.lit(len(weights))).otherwise(F.col("shard")).cast("int").alias("grown_shard"),
    )

"""Random operators, driven by hashed uniforms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgecast.functions.hashing import hashed_uniform, key_text, sequence_seeds, sequence_uniform
from surgecast.operators.reshape import ROWS_PER_CHUNK, chunk_rows, number_chunks
from surgecast.operators.staging import MOST_BROADCAST_ROWS, lookup, stage

INDEX_BUCKETS = 1024
#: Levels of a multinomial's tree after which its nodes are spread anew.
NODE_LEVELS = 4


def randomised_round(x: Column, u: Column, *, by_fraction: bool, corrected: bool = False) -> Column:
    """Round ``x`` up or down at random, half-to-even after moving by a half.

    It moves up when ``u`` does not exceed the fraction of ``x`` (``by_fraction``), or ``x`` itself;
    the latter rounds every value of one or more up. ``corrected`` is floor plus a Bernoulli draw
    on the fraction.
    """
    fraction = x - F.floor(x)
    if corrected:
        return (F.floor(x) + F.when(fraction > u, 1).otherwise(0)).cast("bigint")
    up = (fraction if by_fraction else x) >= u
    return F.rint(F.when(up, x + 0.5).when(x.isNotNull(), x - 0.5)).cast("bigint")


def strata(cells: DataFrame, group: Sequence[str], weight: str) -> DataFrame:
    """(group.., _total, _stratum): the weight of each group and a number for it, one row per group."""
    totals = cells.where(F.col(weight) > 0).groupBy(*group).agg(F.sum(weight).alias("_total"))
    return totals.withColumn("_stratum", F.row_number().over(Window.orderBy(*group)).cast("bigint"))


def weighted_index(
    cells: DataFrame, group: Sequence[str], order: Sequence[str], weight: str, *, buckets: int = INDEX_BUCKETS
) -> DataFrame:
    """Lookup table for drawing cells in proportion to integer weights, by equi-join.

    Each cell owns the positions ``[_lo, _hi)`` of its group's 0.._total-1, in ``order``. The
    positions are cut into ``buckets`` equal parts, and a cell is listed under the ``_slot`` of each
    part it touches, so a draw joins on one integer and keeps the one cell whose range holds its
    position. The table has at most cells + buckets rows per group. ``cells`` must be a small
    domain (distinct patterns, age-by-day cells), never line-list rows.
    """
    upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranged = (
        cells.where(F.col(weight) > 0)
        .withColumn("_hi", F.sum(weight).over(upto))
        .withColumn("_lo", F.col("_hi") - F.col(weight))
        .join(strata(cells, group, weight), list(group))
    )
    parts = F.expr(f"sequence((_lo * {buckets}L) div _total, ((_hi - 1L) * {buckets}L) div _total)")
    slot = F.col("_stratum") * buckets + F.col("_part")
    listed = ranged.withColumn("_part", F.explode(parts)).withColumn("_slot", slot)
    return listed.drop(*group, weight, "_part", "_total", "_stratum")


def draw_cells(units: DataFrame, index: DataFrame, u: Column, *, buckets: int = INDEX_BUCKETS) -> DataFrame:
    """Give every unit (with its group's ``_total`` and ``_stratum``) one cell, by the weights.

    ``index`` is joined as it comes: if it is marked for broadcast (see :func:`lookup`), units are
    never shuffled, however many fall into one group.
    """
    # Coalesced only to be visibly non-null: otherwise the join adds a null filter that draws again.
    position = F.least(F.floor(u * F.col("_total")).cast("bigint"), F.col("_total") - 1)
    slot = F.expr(f"coalesce(_stratum * {buckets}L + (_at * {buckets}L) div _total, 0L)")
    placed = units.withColumn("_at", F.coalesce(position, F.lit(0).cast("bigint"))).withColumn("_unit_slot", slot)
    inside = [F.col("_unit_slot") == F.col("_slot"), F.col("_at") >= F.col("_lo"), F.col("_at") < F.col("_hi")]
    joined = placed.join(index, inside)
    return joined.drop("_at", "_unit_slot", "_slot", "_lo", "_hi", "_total", "_stratum")


def draw_units(cells: DataFrame, n: Column, keys: Sequence[str], index: DataFrame, seed: int, purpose: str) -> DataFrame:
    """One row per unit behind ``cells`` (with ``_total`` and ``_stratum``), with a drawn index cell.

    Units are known by (``keys``, ``_chunk``, ``_number``), and rows are partitioned by
    (``keys``, ``_chunk``).
    """
    chunks = chunk_rows(cells, n, keys)
    key = key_text(seed, purpose, *[F.col(k) for k in keys], F.col("_chunk"))
    units = number_chunks(chunks.withColumns(sequence_seeds(key)), "_number")
    return draw_cells(units, index, sequence_uniform("_number", ROWS_PER_CHUNK + 1)).drop(*[f"_c{k}" for k in range(8)])


def bootstrap_counts(
    cells: DataFrame,
    group: Sequence[str],
    cell: Sequence[str],
    weight: str,
    n_bootstraps: int,
    seed: int,
) -> DataFrame:
    """Cell counts of ``n_bootstraps`` resamples with replacement of the units behind ``cells``.

    Each group is resampled separately to exactly its own total. Only (group, bootstrap, number)
    triples are generated, spread over all tasks; they are counted map-side per cell and only the
    counts are shuffled. Zero counts have no row.
    """
    replicate = F.explode(F.sequence(F.lit(1), F.lit(n_bootstraps)))
    # strata() numbers its few rows in one task; from here on they are spread
    runs = strata(cells, group, weight).repartition(*group).withColumn("bootstrap", replicate)
    index = lookup(weighted_index(cells, group, cell, weight))
    drawn = draw_units(runs, F.col("_total"), [*group, "bootstrap"], index, seed, "boot")
    return drawn.groupBy(*group, "bootstrap", *cell).agg(F.count(F.lit(1)).alias(weight))


#: Binomials of a smaller mean are found by summing their distribution from 0; others from a normal draw.
MOST_SUMMED = 32


def binomial(n: Column, part: Column, whole: Column, u: Column, v: Column) -> Column:
    """A binomial draw: how many of ``n`` units fall into ``part`` of ``whole`` equal shares.

    ``u`` and ``v`` are uniform. Up to a mean of MOST_SUMMED of the rarer side the distribution
    function is inverted at ``u``; beyond, a normal draw from both is corrected for skewness and
    rounded, which differs from the binomial by less than its own step.
    """
    rarer = F.least(part, whole - part)
    p = rarer.cast("double") / whole.cast("double")
    mean = n * p
    most = F.least(n, F.ceil(mean + 12 * F.sqrt(mean) + 24)).cast("int")
    start = F.struct(F.exp(n * F.log1p(-p)).alias("f"), F.exp(n * F.log1p(-p)).alias("upto"), F.lit(0).cast("bigint").alias("k"))

    def step(s: Column, i: Column) -> Column:
        f = s["f"] * ((n - i + 1) / i) * (p / (1 - p))
        return F.when(s["upto"] >= u, s).otherwise(F.struct(f.alias("f"), (s["upto"] + f).alias("upto"), i.cast("bigint").alias("k")))

    summed = F.aggregate(F.sequence(F.lit(1), most), start, step, lambda s: s["k"])
    z = F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * v)
    skewed = F.floor(mean + F.sqrt(mean * (1 - p)) * z + (1 - 2 * p) * (z * z - 1) / 6 + 0.5)
    few = F.when((n < 1) | (rarer < 1), F.lit(0).cast("bigint")).when(mean <= MOST_SUMMED, summed).otherwise(F.least(F.greatest(skewed, F.lit(0)), n).cast("bigint"))
    return F.when(2 * part > whole, n - few).otherwise(few)


def multinomial_counts(
    cells: DataFrame, group: Sequence[str], cell: Sequence[str], weight: str, n_bootstraps: int, seed: int
) -> DataFrame:
    """Same distribution as :func:`bootstrap_counts`, at a cost of cells times replicates.

    Resampling n units with replacement and counting cells is one multinomial draw. It is made by
    splitting: the cells of a group are the leaves of a binary tree, and from the root down a node's
    count is split between its children by a binomial of their weights, hashed from group,
    replicate and node. A level is one lookup of the node's weights; nothing is shuffled but for
    spreading the nodes over the tasks. ``cells`` must be a small domain.
    """
    order = Window.partitionBy(*group).orderBy(*cell)
    leaves = stage(cells.where(F.col(weight) > 0).withColumn("_node", F.row_number().over(order).cast("bigint") - 1))
    last = leaves.agg(F.max("_node")).first()[0]
    height = max(last or 0, 0).bit_length()
    each = leaves.withColumn("_height", F.explode(F.sequence(F.lit(1), F.lit(height)))) if height else leaves.withColumn("_height", F.lit(0)).limit(0)
    on_left = F.expr("shiftright(_node, _height - 1) & 1") == 0
    nodes = each.select(*group, "_height", F.expr("shiftright(_node, _height)").alias("_node"), F.col(weight).alias("_w"), on_left.alias("_left"))
    splits = stage(nodes.groupBy(*group, "_height", "_node").agg(F.sum("_w").alias("_whole"), F.sum(F.when(F.col("_left"), F.col("_w")).otherwise(0)).alias("_part")))
    few = splits.count() <= MOST_BROADCAST_ROWS

    replicate = F.explode(F.sequence(F.lit(1), F.lit(n_bootstraps)))
    rows = leaves.groupBy(*group).agg(F.sum(weight).cast("bigint").alias("_n")).withColumn("bootstrap", replicate)
    rows = rows.withColumn("_node", F.lit(0).cast("bigint"))
    for level in range(height, 0, -1):
        if (height - level) % NODE_LEVELS == 0:
            rows = rows.repartition(*group, "bootstrap", "_node")
        split = splits.where(F.col("_height") == level).drop("_height")
        joined = rows.join(F.broadcast(split) if few else split, [*group, "_node"])
        key = [*(F.col(g) for g in group), F.col("bootstrap"), F.lit(level), F.col("_node")]
        left = binomial(F.col("_n"), F.col("_part"), F.col("_whole"), hashed_uniform(seed, "split", *key), hashed_uniform(seed, "split2", *key))
        drawn = joined.withColumn("_drawn", left)
        children = F.array(
            F.struct((F.col("_node") * 2).alias("_node"), F.col("_drawn").alias("_n")),
            F.struct((F.col("_node") * 2 + 1).alias("_node"), (F.col("_n") - F.col("_drawn")).alias("_n")),
        )
        rows = drawn.select(*group, "bootstrap", F.explode(children).alias("_child")).select(*group, "bootstrap", "_child.*").where("_n > 0")
    named = leaves.drop(weight)
    found = rows.join(F.broadcast(named) if few else named, [*group, "_node"])
    return found.select(*group, "bootstrap", *cell, F.col("_n").alias(weight))


# --- alias tables -------------------------------------------------------------------------------


def alias_slots(cells: DataFrame, group: Sequence[str], order: Sequence[str], weight: str) -> DataFrame:
    """``cells`` with ``_slot``, ``_limit``, ``_alias``, ``_slots`` and ``_total``: an alias table of each group.

    A group of k cells and total weight t has k slots of t positions each. In the slot of a cell the
    positions below ``_limit`` are its own, the others those of the cell in slot ``_alias``, and
    every cell owns k times its weight in all.

    Cells lighter than a slot are filled up by heavier ones, both in ``order``: a light cell by the first
    heavy one whose surplus, summed up, exceeds the deficits before it, and a heavy cell, once the deficits
    have used up its surplus and more, by the next heavy one. So the table follows from running sums.
    ``cells`` must be a small domain, as for :func:`weighted_index`.
    """
    whole = Window.partitionBy(*group)
    ordered = whole.orderBy(*order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    rows = cells.where(F.col(weight) > 0).withColumns(
        {
            "_slot": F.row_number().over(ordered).cast("bigint") - 1,
            "_slots": F.count(F.lit(1)).over(whole),
            "_total": F.sum(weight).over(whole).cast("bigint"),
        }
    )
    over = F.col(weight) * F.col("_slots") - F.col("_total")
    rows = rows.withColumn("_over", over)
    rows = rows.withColumns(
        {
            "_surplus": F.sum(F.greatest("_over", F.lit(0))).over(upto),
            "_deficit": F.sum(F.greatest(-F.col("_over"), F.lit(0))).over(upto),
        }
    )
    heavy = F.col("_over") > 0
    before = F.col("_deficit") + F.col("_over")  # of a light cell: the deficits before it

    def following(value: Column, key: Column, *tie: Column) -> Column:
        """The next known value in ascending order of the key."""
        back = whole.orderBy(key.desc(), *tie).rowsBetween(Window.unboundedPreceding, 0)
        return F.last(value, ignorenulls=True).over(back)

    heavy_slot = F.when(heavy, F.col("_slot"))
    payer = following(heavy_slot, F.when(heavy, F.col("_surplus")).otherwise(before), heavy.asc(), F.col("_slot").desc())
    spent = following(F.when(~heavy, F.col("_deficit")), F.when(heavy, F.col("_surplus")).otherwise(F.col("_deficit")), heavy.asc(), F.col("_slot").desc())
    next_heavy = F.last(heavy_slot, ignorenulls=True).over(whole.orderBy(F.col("_slot").desc()).rowsBetween(Window.unboundedPreceding, -1))
    own = F.col("_slot")
    return rows.withColumns(
        {
            "_limit": F.when(heavy, F.col("_total") + F.col("_surplus") - F.coalesce(spent, F.col("_surplus"))).otherwise(F.col(weight) * F.col("_slots")),
            "_alias": F.coalesce(F.when(heavy, next_heavy).otherwise(payer), own),
        }
    ).drop("_over", "_surplus", "_deficit")


def alias_arrays(cells: DataFrame, group: Sequence[str], order: Sequence[str], weight: str) -> DataFrame:
    """One row per group: ``_slots``, ``_total``, and ``_limit``, ``_alias`` and every further column of ``cells`` as arrays by slot.

    Groups are small domains, so an array holds at most as many elements as there are distinct cells.
    """
    values = [c for c in cells.columns if c not in (*group, weight)]
    slots = alias_slots(cells, group, order, weight)
    listed = F.sort_array(F.collect_list(F.struct("_slot", "_limit", F.col("_alias").cast("int").alias("_alias"), *values)))
    gathered = slots.groupBy(*group).agg(F.max("_slots").alias("_slots"), F.max("_total").alias("_total"), listed.alias("_listed"))
    return gathered.select(*group, "_slots", "_total", *(F.col(f"_listed.{c}").alias(c) for c in ("_limit", "_alias", *values)))


def draw_aliased(cells: DataFrame, n: Column, keys: Sequence[str], table: DataFrame, group: Sequence[str], seed: int, purpose: str) -> DataFrame:
    """One row per unit behind ``cells``, with the values of a cell drawn from its group's alias table.

    ``table`` is as from :func:`alias_arrays`. Units are known by (``keys``, ``_chunk``, ``_number``), and rows
    are partitioned by (``keys``, ``_chunk``). A draw is one element of an array and one comparison;
    units are never joined or shuffled.
    """
    values = [c for c in table.columns if c not in (*group, "_slots", "_total", "_limit", "_alias")]
    chunks = chunk_rows(cells, n, keys)
    key = key_text(seed, purpose, *[F.col(k) for k in keys], F.col("_chunk"))
    placed = chunks.join(lookup(table), list(group)).withColumns(sequence_seeds(key))
    units = number_chunks(placed, "_number")
    positions = F.col("_slots") * F.col("_total")
    units = units.withColumn("_at", F.least(F.floor(sequence_uniform("_number", ROWS_PER_CHUNK + 1) * positions).cast("bigint"), positions - 1))
    units = units.withColumn("_place", F.expr("int(_at div _total)"))
    chosen = F.expr("if(_at % _total < _limit[_place], _place, _alias[_place])")
    units = units.withColumn("_place", chosen)
    drawn = {v: F.expr(f"`{v}`[_place]") for v in values}
    return units.withColumns(drawn).drop(*[f"_c{k}" for k in range(8)], "_at", "_place", "_slots", "_total", "_limit", "_alias")

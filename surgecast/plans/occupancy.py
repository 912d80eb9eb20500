"""Observed daily ward and ICU occupancy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgecast.config import StudyConfig
from surgecast.functions import AGE_BANDS, INVALID_AGE, counted_days
from surgecast.operators.intervals import daily_cover, interval_union
from surgecast.operators.reshape import fill_daily_gaps
from surgecast.sources.persons import LineList, PersonRows, per_person

_BLOCK = 32  # days per bit mask
_MASK_CAP = 15  # a stay capped so touches two blocks at most, and its mask can be moved into them
_AGE_LABELS = [*AGE_BANDS, INVALID_AGE]  # in text order, which is also age order


def _counted(stays: DataFrame, cfg: StudyConfig, *columns: Column | str) -> DataFrame:
    """The days of each stay that count, as offsets from onset in bit masks ``h`` and ``i`` (ICU)."""
    cap = cfg.stay_cap_days
    icu = counted_days("date_ICU_admit", "date_ICU_discharge", "date_onset", cap)
    return stays.select(
        "person_id",
        F.unix_date("date_onset").alias("onset"),
        counted_days("date_admit", "date_discharge", "date_onset", cap).alias("h"),
        F.when(F.col("date_ICU_admit").isNotNull(), icu).otherwise(0).alias("i"),
        *columns,
    )


def _block_bits(mask: str) -> Column:
    """An onset-based mask moved to its place in a 32-day block, cut at the block's ends."""
    shift = f"onset - block * {_BLOCK} + 16"
    return F.expr(f"shiftright(shiftleft(bigint({mask}), {shift}), 16) & {(1 << _BLOCK) - 1}L").alias(mask)


def _days_in_block(first: Column, last: Column) -> Column:
    """The days of an interval (both ends as day numbers) inside a block, as its bits; 0 for none or unknown ends."""
    low = F.greatest(first - F.col("block") * _BLOCK, F.lit(0))
    high = F.least(last - F.col("block") * _BLOCK, F.lit(_BLOCK - 1))
    inside = first.isNotNull() & last.isNotNull() & (low <= high)
    one = F.lit(1).cast("bigint")
    bits = F.call_function("shiftleft", one, (high + 1).cast("int")) - F.call_function("shiftleft", one, low.cast("int"))
    return F.when(inside, bits).otherwise(F.lit(0).cast("bigint"))


def _long_masks(stays: DataFrame, cfg: StudyConfig, *columns: Column) -> DataFrame:
    """As :func:`_block_masks` of :func:`_counted`, for any cap: a row for each block that a stay touches."""
    onset, cap = F.unix_date("date_onset"), cfg.stay_cap_days
    ends = {}
    for k, first, last in (("h", "date_admit", "date_discharge"), ("i", "date_ICU_admit", "date_ICU_discharge")):
        ends[f"{k}0"] = F.when(F.col(first).isNotNull() & F.col(last).isNotNull(), F.greatest(F.unix_date(first), onset))
        ends[f"{k}1"] = F.when(F.col(first).isNotNull() & F.col(last).isNotNull(), F.least(F.unix_date(last), onset + cap))
    rows = stays.select("person_id", *(c.alias(n) for n, c in ends.items()), *columns)
    names = [c for c in rows.columns if c not in ("person_id", *ends)]
    low, high = F.least("h0", "i0"), F.greatest("h1", "i1")
    blocks = F.explode(F.sequence(F.floor(low / _BLOCK).cast("int"), F.floor(high / _BLOCK).cast("int")))
    touched = rows.where(low <= high).withColumn("block", blocks)
    masks = [_days_in_block(F.col(f"{k}0"), F.col(f"{k}1")).alias(k) for k in "hi"]
    return touched.select("person_id", "block", *names, *masks).where("h + i > 0")


def _masks(stays: DataFrame, cfg: StudyConfig, *columns: Column) -> DataFrame:
    """(person_id, block, columns.., h, i): the counted days of every stay as bits of 32-day blocks."""
    if cfg.stay_cap_days > _MASK_CAP:
        return _long_masks(stays, cfg, *columns)
    counted = _counted(stays, cfg, *columns)
    return _block_masks(counted, cfg, *[c for c in counted.columns if c not in ("person_id", "onset", "h", "i")])


def _block_masks(counted: DataFrame, cfg: StudyConfig, *keep: str) -> DataFrame:
    """A row for each 32-day block that a stay touches, one or two, with its days as bits of the block."""
    blocks = F.expr(
        f"sequence(int(floor(onset / {_BLOCK})), int(floor((onset + {cfg.stay_cap_days}) / {_BLOCK})))"
    )
    masks = counted.withColumn("block", F.explode(blocks))
    return masks.select("person_id", "block", *keep, _block_bits("h"), _block_bits("i")).where("h + i > 0")


def _changes(masks: DataFrame, by: list[str]) -> DataFrame:
    """(date, by.., h, i): how the numbers counted by masks change on a day.

    Masks of first or last days take few distinct values, so they collapse map-side.
    """
    edges = F.array(
        *[
            F.struct(
                F.lit(series).alias("series"), F.lit(sign).alias("sign"), F.expr(bits).alias("mask")
            )
            for series in "hi"
            for sign, bits in ((1, f"{series} & ~shiftleft({series}, 1)"), (-1, f"{series} & ~shiftright({series}, 1)"))
        ]
    )
    patterns = (
        masks.select("block", *by, F.explode(edges).alias("e"))
        .select("block", *by, "e.*")
        .where("mask != 0")
        .groupBy("block", *by, "series", "sign", "mask")
        .agg(F.sum("sign").alias("n"))
    )
    bits = F.explode(F.sequence(F.lit(0), F.lit(_BLOCK - 1)))
    day = F.expr(f"date_from_unix_date(int(block * {_BLOCK} + bit + if(sign < 0, 1, 0)))")
    return (
        patterns.withColumn("bit", bits)
        .where("shiftright(mask, bit) & 1 = 1")
        .groupBy(day.alias("date"), *by)
        .agg(*[F.sum(F.when(F.col("series") == k, F.col("n")).otherwise(0)).alias(k) for k in "hi"])
    )


def calculate_occupancy(stays: LineList, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """(date, group in {ward, ICU}, count), gap-free from the first day to the last but one.

    ``stays`` are cleaned. A person counts once per day. Days are held as bits of 32-day blocks, so
    a stay shuffles as one or two rows however long it is, and several stays of a person merge by
    ``bit_or``. Of the merged days only the changes are counted: first days add one, days after last
    days take one off, and the running sum is the occupancy. Where the cap is too long for that, the
    stays of a person merge as intervals.
    """
    if cfg.stay_cap_days > _MASK_CAP:
        occupied = _long_stays_cover(stays, cfg)
    else:
        persons = per_person(
            stays, lambda rows: _masks(rows, cfg).groupBy("person_id", "block").agg(F.bit_or("h").alias("h"), F.bit_or("i").alias("i"))
        )
        changes = _changes(persons, [])
        # one row per day of change: a few thousand rows at most
        running = Window.orderBy("date")
        occupied = changes.select(
            "date",
            F.lead("date").over(running).alias("next"),
            F.sum("h").over(running).alias("hospital"),
            F.sum("i").over(running).alias("ICU"),
        )
    spans = F.explode(F.sequence("date", F.date_sub("next", 1), F.expr("interval 1 day")))
    daily = occupied.where("next is not null").withColumn("date", spans)
    in_use = F.when(F.col("hospital") > 0, F.col("date"))
    everywhere = Window.partitionBy()
    bounded = daily.withColumns({"first": F.min(in_use).over(everywhere), "last": F.max(in_use).over(everywhere)})
    full = bounded.where("date >= first and date < last").select(
        "date", "hospital", F.when(F.col("hospital") > 0, F.col("ICU")).otherwise(0).alias("ICU")
    )
    return _ward_and_icu(full, ["date"])


def _long_stays_cover(stays: LineList, cfg: StudyConfig) -> DataFrame:
    """(date, next, hospital, ICU) of stays of any cap: a person's intervals are united, then their ends counted."""
    onset = F.col("date_onset")
    until = F.date_add(onset, cfg.stay_cap_days)
    kinds = (("hospital", "date_admit", "date_discharge"), ("ICU", "date_ICU_admit", "date_ICU_discharge"))
    each = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                # of an unknown end nothing counts
                F.when(F.col(last).isNotNull(), F.greatest(F.col(first), onset)).alias("first"),
                F.when(F.col(first).isNotNull(), F.least(F.col(last), until)).alias("last"),
            )
            for kind, first, last in kinds
        ]
    )
    stored = stays.regular if isinstance(stays, PersonRows) else None
    united = per_person(
        stays,
        lambda rows: interval_union(
            rows.select("person_id", F.explode(each).alias("x")).select("person_id", "x.*"), ["person_id", "kind"], "first", "last", spread=rows is not stored
        ),
    )
    return daily_cover(united, "first", "last", {kind: F.col("kind") == kind for kind, *_ in kinds})


def _ward_and_icu(wide: DataFrame, ids: list[str]) -> DataFrame:
    # ICU days outside the hospital stay make the ward count negative; kept as is.
    ward = (F.col("hospital") - F.col("ICU")).alias("ward")
    return (
        wide.select(*ids, ward, "ICU")
        .unpivot(ids, ["ward", "ICU"], "group", "count")
        .withColumn("count", F.col("count").cast("double"))
    )


def calculate_occupancy_aged(stays: LineList, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """(age_group, date, group, count): every age group present, over the days of the whole table.

    A person counts once per day, under the age group of the first stay (by admission, onset, age)
    that covers the day. Stays are held as masks, as for the whole occupancy, with that order packed
    into one integer; it only matters where the age groups of a person's stays in a block differ.
    """
    code = F.expr(
        f"if(age_group = '{INVALID_AGE}', {len(_AGE_LABELS)}, if(age_group = '{AGE_BANDS[0]}', 1, int(left(age_group, 1)) + 1))"
    )
    order = (F.unix_date("date_admit").cast("bigint") * (1 << 20) + F.unix_date("date_onset")) * 16 + code

    def merged(rows: DataFrame) -> DataFrame:
        # A person has at most days x days x ages distinct stays in a block, however many rows.
        distinct = _masks(rows, cfg, order.alias("order")).groupBy("person_id", "block", "order").agg(F.bit_or("h").alias("h"), F.bit_or("i").alias("i"))
        return distinct.groupBy("person_id", "block").agg(
            F.bit_or("h").alias("h"),
            F.bit_or("i").alias("i"),
            (F.min(F.col("order") % 16)).alias("code"),
            (F.max(F.col("order") % 16)).alias("other"),
            F.collect_list(F.struct("order", "h", "i")).alias("stays"),
        )

    persons = per_person(stays, merged)
    own = F.array(F.struct("code", "h", "i"))
    # Where the age group differs between stays, each takes the days that no earlier one covers.
    none = F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).cast("bigint").alias("i"), F.array().cast("array<struct<code:bigint,h:bigint,i:bigint>>").alias("out"))

    def take(seen: Column, x: Column) -> Column:
        left = F.struct(
            (x["order"] % 16).alias("code"),
            x["h"].bitwiseAND(F.bitwise_not(seen["h"])).alias("h"),
            x["i"].bitwiseAND(F.bitwise_not(seen["i"])).alias("i"),
        )
        return F.struct(seen["h"].bitwiseOR(x["h"]).alias("h"), seen["i"].bitwiseOR(x["i"]).alias("i"), F.array_append(seen["out"], left).alias("out"))

    resolved = F.aggregate(F.array_sort("stays"), none, take, lambda seen: seen["out"])
    parts = persons.select("block", F.explode(F.when(F.col("code") == F.col("other"), own).otherwise(resolved)).alias("x")).select("block", "x.*")
    changes = _changes(parts, ["code"])

    ages = list(enumerate(_AGE_LABELS, start=1))
    sums = [F.sum(F.when(F.col("code") == k, F.col(s)).otherwise(0)).alias(f"{s}{k}") for s in "hi" for k, _ in ages]
    # one row per day of change: a few thousand rows at most
    running = Window.orderBy("date")
    counts = {f"{s}{k}": F.sum(f"{s}{k}").over(running) for s in "hi" for k, _ in ages}
    occupied = changes.groupBy("date").agg(*sums).select("date", F.lead("date").over(running).alias("next"), *(c.alias(n) for n, c in counts.items()))
    spans = F.explode(F.sequence("date", F.date_sub("next", 1), F.expr("interval 1 day")))
    hospital = F.expr(" + ".join(f"h{k}" for k, _ in ages))
    daily = occupied.where("next is not null").withColumn("date", spans).drop("next").where(hospital > 0)
    # A present age group has a day with a hospital count; the daily table is small.
    everywhere = Window.partitionBy()
    present = {f"p{k}": F.max(F.col(f"h{k}")).over(everywhere) > 0 for k, _ in ages}
    values = [c for c in daily.columns if c != "date"]
    flagged = daily.withColumns(present)
    full = fill_daily_gaps(flagged, "date", values, drop_last=True)
    cells = F.array(
        *[
            F.struct(
                F.lit(label).alias("age_group"),
                F.col(f"p{k}").alias("present"),
                F.col(f"h{k}").alias("hospital"),
                F.when(F.col(f"h{k}") > 0, F.col(f"i{k}")).otherwise(0).alias("ICU"),
            )
            for k, label in ages
        ]
    )
    long = full.select("date", F.explode(cells).alias("c")).select("date", "c.*").where("present")
    return _ward_and_icu(long, ["age_group", "date"])


def observed_from(occupancy: DataFrame, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """The part of an occupancy table that is reported."""
    return occupancy.where(F.col("date") >= F.lit(cfg.plot_start))

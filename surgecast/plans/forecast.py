"""Monte-Carlo forecast of occupancy, admissions and ED presentations."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgecast.config import ForecastDates, StudyConfig
from surgecast.functions import AGE_BANDS, counted_days, hashed_uniform
from surgecast.operators.reshape import ROWS_PER_CHUNK, complete_daily
from surgecast.operators.sampling import alias_arrays, draw_aliased, randomised_round
from surgecast.operators.staging import stage
from surgecast.plans.rates import SPAN, extend_ascertainment, extend_rates, horizons, scenarios_without_rates
from surgecast.sources.persons import LineList, per_person

CELL = ["scenario_label", "group", "bootstrap", "age_group", "date_onset"]
STRATUM = ["group", "age_group"]
MATURITY_DAYS = 14  # only stays old enough to be complete serve as patterns


def _mature(column: str, dates: ForecastDates) -> Column:
    return F.col(column) < F.lit(dates.hospital_linelist - dt.timedelta(MATURITY_DAYS))


def stay_patterns(stays: LineList, dates: ForecastDates, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """(group, age_group, mask, n): how many persons show each pattern of days after onset.

    A pattern is the set of days 0..``stay_cap_days`` on which a person was in hospital (ward) or in ICU, over all
    of the person's stays, held as bits. Persons with no counted day have mask 0. The table is
    bounded: one row per distinct set of days, group and age, whatever the size of the line list.
    """
    cap = cfg.stay_cap_days
    icu = counted_days("date_ICU_admit", "date_ICU_discharge", "date_onset", cap)
    persons = per_person(
        stays,
        lambda rows: rows.where(_mature("date_admit", dates))
        .select(
            "person_id",
            "age_group",
            counted_days("date_admit", "date_discharge", "date_onset", cap).alias("ward"),
            F.when(F.col("date_ICU_admit").isNotNull(), icu).alias("ICU"),
        )
        .groupBy("age_group", "person_id")
        .agg(F.bit_or("ward").alias("ward"), F.bit_or("ICU").alias("ICU")),
    )
    # no ICU stay: bit_or over NULLs is NULL, and the person is no ICU pattern
    long = persons.unpivot("age_group", ["ward", "ICU"], "group", "mask").where("mask is not null")
    return long.groupBy("group", "age_group", "mask").agg(F.count(F.lit(1)).alias("n"))


def ed_offsets(presentations: LineList, dates: ForecastDates, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """(group = ED, age_group, mask, n): persons per day offset of presentation; mask 0 is "none".

    A person counts once per distinct offset. Offsets before onset or beyond the cap are one value,
    "no counted day", which stays a possible draw.
    """
    cap = cfg.stay_cap_days
    offset = F.datediff("date_presentation", "date_onset")
    none = cap + 1
    slot = F.when(offset.between(0, cap), offset).otherwise(none)
    persons = per_person(
        presentations,
        lambda rows: rows.where(_mature("date_presentation", dates))
        .withColumn("slot", slot)
        .groupBy("age_group", "person_id")
        .agg(F.bit_or(F.expr("shiftleft(1L, slot)")).alias("slots")),
    )
    sums = [F.sum(F.expr(f"shiftright(slots, {d}) & 1")).alias(str(d)) for d in range(none + 1)]
    wide = persons.groupBy("age_group").agg(*sums)
    long = wide.unpivot("age_group", [f"`{d}`" for d in range(none + 1)], "slot", "n").where("n > 0")
    mask = F.expr(f"case when int(slot) = {none} then 0L else shiftleft(1L, int(slot)) end")
    return long.select(F.lit("ED").alias("group"), "age_group", mask.alias("mask"), "n")


def pattern_weights(patterns: DataFrame) -> DataFrame:
    """Adds ``p``, the share of the whole group table, and ``p_age``, the share within the age."""

    def share(*by: str) -> Column:
        return F.col("n") / F.sum("n").over(Window.partitionBy(*by))

    return patterns.select("*", share("group").alias("p"), share(*STRATUM).alias("p_age"))


def mask_days(mask: Column, cap: int = 14) -> Column:
    """Ascending day offsets in a mask."""
    days = F.transform(F.sequence(F.lit(0), F.lit(cap)), lambda d: F.when(F.getbit(mask, d) == 1, d))
    return F.array_compact(days)


def expected_patients(
    trajectory: DataFrame,
    spans: DataFrame,
    rates_ahead: DataFrame,
    ascertainment_ahead: DataFrame,
    cfg: StudyConfig = StudyConfig(),
) -> DataFrame:
    """(scenario_label, group, bootstrap, age_group, date_onset, expected, n).

    ``expected`` patients are cases x age share x conversion rates x ascertainment, and ``n`` is
    their random rounding. Expected values are kept to nine decimals so that the last bits of a
    floating-point sum, which vary with the order rows arrive in, cannot flip a rounding.
    """
    cases = trajectory.join(spans, "scenario_label")
    cases = cases.join(ascertainment_ahead, [*SPAN, "date_onset"])
    base = rates_ahead.join(cases, [*SPAN, "date_onset"])
    seen = F.col("count") * F.col("pr_age_given_case")
    hosp = seen * F.col("pr_hosp")
    expected = {
        "ward": hosp * F.col("asc"),
        "ICU": hosp * F.col("pr_ICU") * F.col("asc"),
        "ED": seen * F.col("pr_ED") * F.col("asc"),
    }
    rows = F.array(*[F.struct(F.lit(g).alias("group"), F.round(x, 9).alias("expected")) for g, x in expected.items()])
    long = base.select("scenario_label", "bootstrap", "age_group", "date_onset", F.explode(rows).alias("r"))
    long = long.select(
        "scenario_label", F.col("r.group").alias("group"), "bootstrap", "age_group", "date_onset", "r.expected"
    )
    u = hashed_uniform(cfg.seed, "round", *[F.col(c) for c in CELL])
    x = F.col("expected")
    n = F.when(F.col("group") == "ward", randomised_round(x, u, by_fraction=True, corrected=cfg.corrected)).otherwise(
        randomised_round(x, u, by_fraction=False, corrected=cfg.corrected)
    )
    return long.withColumn("n", n)


def drawn_patients(expected: DataFrame, patterns: DataFrame, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """One row per patient with a pattern drawn from the patient's group and age.

    Ages outside the model's bands get no patients, nor do groups without any pattern: those are
    listed by :func:`rejected_cells`, and the study stops unless told to go on. Rows are partitioned by (cell, ``_chunk``). Both inputs are read more
    than once: pass staged tables.
    """
    cells = expected.where(F.col("age_group").isin(AGE_BANDS)).select(*CELL, F.col("n").alias("_patients"))
    table = alias_arrays(patterns, STRATUM, ["mask"], "n")
    return draw_aliased(cells, F.col("_patients"), CELL, table, STRATUM, cfg.seed, "draw").drop("_patients")


NO_PATTERN, NO_RATES = "no pattern for age group", "no rates for scenario"


def rejected_cells(expected: DataFrame, patterns: DataFrame, unrated: DataFrame | None = None) -> DataFrame:
    """Cells the forecast cannot use: no expected value, or patients without a pattern to draw.

    ``unrated`` scenarios have no cells; each is one row with nothing but its label and reason.
    """
    known = patterns.select(STRATUM).distinct().withColumn("_known", F.lit(True))
    reason = (
        F.when(F.col("expected").isNull(), "no expected count")
        .when(~F.col("age_group").isin(AGE_BANDS), "age outside the model")
        .when((F.col("n") > 0) & F.col("_known").isNull(), NO_PATTERN)
    )
    joined = expected.join(known, STRATUM, "left")
    cells = joined.withColumn("reason", reason).where("reason is not null").drop("_known")
    if unrated is None:
        return cells
    return cells.unionByName(unrated.select("scenario_label", F.lit(NO_RATES).alias("reason")), allowMissingColumns=True)


def stop_on_losses(rejected: DataFrame, cfg: StudyConfig) -> None:
    """Raise if the forecast would leave out patients or scenarios, unless ``cfg.losses`` is "report"."""
    if cfg.losses == "report":
        return
    lost = rejected.where(F.col("reason").isin(NO_PATTERN, NO_RATES)).groupBy("reason").agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("patients"))
    lost = lost.orderBy("reason").collect()  # one row per reason
    if lost:
        found = "; ".join(f"{r.reason}: {r.cells} cells, {r.patients or 0} patients" for r in lost)
        raise ValueError(f"the forecast would be incomplete ({found}); set losses='report' to go on without them")


# Per-day counts of a chunk are summed as bit fields, several to an integer: a chunk has fewer
# units than a field can count.
_FIELD_BITS = 15
_FIELDS = 4
assert ROWS_PER_CHUNK < 1 << _FIELD_BITS


def _packed(mask: str, cap: int) -> list[Column]:
    """The bits of a mask moved to bit fields, ``_FIELDS`` days to an integer."""
    days = list(range(cap + 1))
    groups = [days[i : i + _FIELDS] for i in range(0, len(days), _FIELDS)]
    terms = "shiftleft(bigint(shiftright({m}, {d}) & 1), {s})"
    return [
        F.expr(" + ".join(terms.format(m=mask, d=d, s=_FIELD_BITS * k) for k, d in enumerate(part))) for part in groups
    ]


def _unpacked(prefix: str, day: int) -> Column:
    return F.expr(f"shiftright({prefix}{day // _FIELDS}, {_FIELD_BITS * (day % _FIELDS)}) & {(1 << _FIELD_BITS) - 1}L")


def daily_samples(expected: DataFrame, patterns: DataFrame, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """(scenario_label, group, bootstrap, age_group, date, occupied, admitted) of drawn patients.

    A patient's admission is the first counted day. Patients of one chunk of a cell are counted by
    pattern, and the counts summed per day offset before any day is written out. Chunks are already
    partitioned by their key, so the patients themselves are never shuffled, only daily sums are.
    """
    cap = cfg.stay_cap_days
    packs = {f"o{k}": c for k, c in enumerate(_packed("mask", cap))}
    packs |= {f"a{k}": c for k, c in enumerate(_packed("(mask & -mask)", cap))}
    chunk = [*CELL, "_chunk"]
    counted = drawn_patients(expected, patterns, cfg).groupBy(*chunk, "mask").agg(F.count(F.lit(1)).alias("_alike"))
    cells = counted.groupBy(*chunk).agg(*[F.sum(c * F.col("_alike")).alias(k) for k, c in packs.items()])
    per_day = F.array(
        *[
            F.struct(F.lit(d).alias("d"), _unpacked("o", d).alias("o"), _unpacked("a", d).alias("a"))
            for d in range(cap + 1)
        ]
    )
    days = cells.select(*CELL, F.explode(per_day).alias("x")).where("x.o > 0")
    return (
        days.withColumn("date", F.date_add("date_onset", F.col("x.d")))
        .groupBy("scenario_label", "group", "bootstrap", "age_group", "date")
        .agg(F.sum("x.o").alias("occupied"), F.sum("x.a").alias("admitted"))
    )


KEYS = ["scenario_label", "group", "bootstrap", "age_group", "date"]


def _clip(df: DataFrame, trajectory: DataFrame, dates: ForecastDates, cfg: StudyConfig) -> DataFrame:
    ends = trajectory.groupBy("scenario_label").agg(F.max("date_onset").alias("_end"))
    start = F.lit(dates.estimates_start + dt.timedelta(cfg.stay_cap_days))
    kept = df.where(F.col("date") >= start).join(ends, "scenario_label")
    return kept.where(F.col("date") <= F.col("_end")).drop("_end")


def sampled_occupancy(
    samples: DataFrame, trajectory: DataFrame, dates: ForecastDates, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    """Ward and ICU occupancy with admissions on the full grid, cut to the forecast range.

    A patient's admission day is one of the occupied days, so admissions never fall outside the
    occupancy rows and no second join is needed to attach them.
    """
    beds = samples.where(F.col("group").isin("ward", "ICU"))
    full = complete_daily(
        beds,
        "date",
        ["age_group", "bootstrap"],
        {"occupied": 0, "admitted": 0},
        within=["scenario_label", "group"],
    )
    return _clip(full, trajectory, dates, cfg)


def sampled_ed(
    samples: DataFrame, trajectory: DataFrame, dates: ForecastDates, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    """ED presentations per day, cut to the forecast range; days without any have no row."""
    return _clip(samples.where("group = 'ED' and admitted > 0"), trajectory, dates, cfg)


def sampled_admissions(samples: DataFrame) -> DataFrame:
    """Ward and ICU admissions per day, on every day they fall on."""
    return samples.where("group in ('ward', 'ICU') and admitted > 0").select(*KEYS, "admitted")


def assemble_outputs(
    samples: DataFrame, trajectory: DataFrame, dates: ForecastDates, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    """(scenario_label, bootstrap, date, age_group, group, count, admissions).

    ED rows are completed over days and ages only, so their filler rows carry neither bootstrap nor
    group; ``corrected`` completes them over bootstraps as well.
    """
    beds = sampled_occupancy(samples, trajectory, dates, cfg)
    ed = sampled_ed(samples, trajectory, dates, cfg)
    range_ = (
        beds.where("group = 'ward'")
        .groupBy("scenario_label")
        .agg(F.min("date").alias("_start"), F.max("date").alias("_end"))
    )
    filler_keys = ["age_group", "bootstrap"] if cfg.corrected else ["age_group"]
    dims = ed.groupBy("scenario_label").agg(*[F.collect_set(k).alias(k) for k in filler_keys])
    grid = dims.join(range_, "scenario_label").withColumn(
        "date", F.explode(F.expr("sequence(_start, _end, interval 1 day)"))
    )
    for k in filler_keys:
        grid = grid.withColumn(k, F.explode(k))
    seen = ["scenario_label", "date", *filler_keys]
    fillers = grid.select(seen).join(ed.select(seen).distinct(), seen, "left_anti")
    if cfg.corrected:
        fillers = fillers.withColumn("group", F.lit("ED"))

    columns = ["scenario_label", "bootstrap", "date", "age_group", "group", "count", "admissions"]
    occupied = beds.withColumnsRenamed({"occupied": "count", "admitted": "admissions"})
    presented = ed.withColumnsRenamed({"admitted": "admissions"}).withColumn("count", F.lit(0).cast("bigint"))
    out = occupied.unionByName(presented.select(occupied.columns)).unionByName(fillers, allowMissingColumns=True)
    return out.fillna(0, ["count", "admissions"]).select(columns)


@dataclass(frozen=True)
class ForecastTables:
    """Staged intermediate tables of one forecast run, all bounded by its dimensions."""

    trajectory: DataFrame
    expected: DataFrame
    patterns: DataFrame
    samples: DataFrame
    rejected: DataFrame


def expected_table(
    trajectory: DataFrame, rates: DataFrame, ascertainment: DataFrame, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    """Expected and realised patients from staged trajectory and rates."""
    spans = horizons(rates, trajectory)
    ahead = extend_rates(rates, spans, cfg)
    return expected_patients(trajectory, spans, ahead, extend_ascertainment(ascertainment, spans), cfg)


def sample_patients(
    trajectory: DataFrame,
    rates: DataFrame,
    ascertainment: DataFrame,
    stays: LineList,
    presentations: LineList,
    dates: ForecastDates,
    cfg: StudyConfig = StudyConfig(),
) -> ForecastTables:
    """Run the simulation up to its daily sums. ``trajectory`` and ``rates`` must be staged."""
    expected = stage(expected_table(trajectory, rates, ascertainment, cfg))
    patterns = stage(stay_patterns(stays, dates, cfg).unionByName(ed_offsets(presentations, dates, cfg)))
    rejected = stage(rejected_cells(expected, patterns, scenarios_without_rates(trajectory, horizons(rates, trajectory))))
    stop_on_losses(rejected, cfg)
    samples = stage(daily_samples(expected, patterns, cfg))
    return ForecastTables(trajectory, expected, patterns, samples, rejected)

"""Time-varying conversion rates: bootstrap, smoothing, extension over the forecast horizon."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgecast.config import ForecastDates, StudyConfig
from surgecast.operators.quantiles import median_band
from surgecast.operators.reshape import complete_daily
from surgecast.operators.sampling import bootstrap_counts, multinomial_counts
from surgecast.operators.series import fill_downup, first_per_group, interpolate, rolling_extend
from surgecast.operators.staging import stage
from surgecast.sources.linelists import cases_in_row, stay_order
from surgecast.sources.persons import LineList, per_person

RATES = ["pr_hosp", "pr_ICU", "pr_ED", "pr_age_given_case"]
CELL = ["age_group", "date_onset", "is_icu"]
MEMBER = ["bootstrap", "age_group"]
SPAN = ["first", "last", "end"]


def _in_window(start: dt.date, data_date: dt.date, cfg: StudyConfig) -> Column:
    onset = F.col("date_onset")
    return (onset >= F.lit(start)) & (onset < F.lit(data_date - dt.timedelta(cfg.lag_days)))


def rate_cells(
    cases: DataFrame, stays: LineList, presentations: LineList, dates: ForecastDates, cfg: StudyConfig
) -> DataFrame:
    """Counts per (stream, age_group, date_onset, is_icu) inside the estimation window.

    Hospital and ED line lists contribute the first row of each person. This is the only step of
    the rate estimation that reads line lists; its result is bounded by ages and days.
    """
    at_hospital = _in_window(dates.estimates_start, dates.hospital_linelist, cfg)

    def first(day: str) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: first_per_group(rows.where(at_hospital), ["person_id"], stay_order(rows, day))

    first_stay = per_person(stays, first("date_admit"))
    first_visit = per_person(presentations, first("date_presentation"))
    no_icu = F.lit(0).alias("is_icu")
    one = F.lit(1).alias("n")
    streams = {
        "case": cases.where(_in_window(dates.estimates_start, dates.case_linelist, cfg)).select(
            "age_group", "date_onset", no_icu, cases_in_row(cases).alias("n")
        ),
        "hosp": first_stay.select(
            "age_group", "date_onset", F.col("date_ICU_admit").isNotNull().cast("int").alias("is_icu"), one
        ),
        "ed": first_visit.select("age_group", "date_onset", no_icu, one),
    }
    counted = [
        rows.groupBy(*CELL).agg(F.sum("n").cast("bigint").alias("n")).where("n > 0").select(F.lit(stream).alias("stream"), *CELL, "n")
        for stream, rows in streams.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def resample_cells(cells: DataFrame, cfg: StudyConfig) -> DataFrame:
    """Bootstrap resamples of the streams, as counts per (stream, bootstrap, cell)."""
    draw = {"hashed": bootstrap_counts, "multinomial": multinomial_counts}[cfg.bootstrap_method]
    return draw(cells, ["stream"], CELL, "n", cfg.n_bootstraps, cfg.seed)


def rate_numerators(drawn: DataFrame) -> DataFrame:
    """One row per (bootstrap, age_group, date_onset) that has cases, with all four counts.

    Counts without cases on that day and age vanish, as they do when joined onto the cases.
    """

    def count_of(stream: str, also: str = "true") -> Column:
        return F.coalesce(F.sum(F.expr(f"case when stream = '{stream}' and {also} then n end")), F.lit(0))

    counts = drawn.groupBy(*MEMBER, "date_onset").agg(
        count_of("case").alias("n_case"),
        count_of("hosp").alias("n_hosp"),
        count_of("hosp", "is_icu = 1").alias("n_ICU"),
        count_of("ed").alias("n_ED"),
    )
    return counts.where("n_case > 0")


def smooth_rates(numerators: DataFrame, dates: ForecastDates, cfg: StudyConfig) -> DataFrame:
    """Seven-day rates and age shares on the full (bootstrap, age, day) grid.

    0/0 is NULL, except for ``pr_ICU`` where it is 0.
    """
    counts = ["n_case", "n_hosp", "n_ICU", "n_ED"]
    recent = numerators.where(F.col("date_onset") < F.lit(dates.data_min - dt.timedelta(cfg.lag_days)))
    full = complete_daily(recent, "date_onset", MEMBER, dict.fromkeys(counts, 0))
    rolled = rolling_extend(full, {f"{c}_7": c for c in counts}, cfg.rate_window, "sum", MEMBER, "date_onset")
    day = Window.partitionBy("bootstrap", "date_onset")
    icu = F.try_divide("n_ICU_7", "n_hosp_7")
    return rolled.select(
        *MEMBER,
        "date_onset",
        F.try_divide("n_hosp_7", "n_case_7").alias("pr_hosp"),
        F.when(F.col("n_hosp_7") == 0, 0.0).otherwise(icu).alias("pr_ICU"),
        F.try_divide("n_ED_7", "n_case_7").alias("pr_ED"),
        F.try_divide("n_case_7", F.sum("n_case_7").over(day)).alias("pr_age_given_case"),
    )


def time_varying_estimates(
    cases: DataFrame,
    stays: LineList,
    presentations: LineList,
    dates: ForecastDates,
    cfg: StudyConfig = StudyConfig(),
) -> DataFrame:
    """(bootstrap, age_group, date_onset) with the four rates."""
    cells = stage(rate_cells(cases, stays, presentations, dates, cfg))
    return smooth_rates(stage(rate_numerators(resample_cells(cells, cfg))), dates, cfg)


def horizons(rates: DataFrame, trajectory: DataFrame) -> DataFrame:
    """(scenario_label, first, last, end): the span each scenario has rates for, and its last day.

    One row per scenario. Scenarios usually share a span, so extensions are computed per span and
    scenarios looked up at the end. ``rates`` has a row for each day between its first and last.
    """
    reach = trajectory.groupBy("scenario_label").agg(F.min("date_onset").alias("_from"), F.max("date_onset").alias("end"))
    known_from, known_to = (rates.agg(f("date_onset")).scalar() for f in (F.min, F.max))
    spans = reach.select(
        "scenario_label",
        F.greatest(F.col("_from"), known_from).alias("first"),
        F.least(F.col("end"), known_to).alias("last"),
        "end",
    )
    return spans.where(F.col("first") <= F.col("last"))


def scenarios_without_rates(trajectory: DataFrame, spans: DataFrame) -> DataFrame:
    """(scenario_label): scenarios none of whose days has rates, so that nothing can be forecast."""
    return trajectory.select("scenario_label").distinct().join(spans, "scenario_label", "left_anti")


def extend_rates(rates: DataFrame, spans: DataFrame, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """(first, last, end, bootstrap, age_group, date_onset) with the rates up to ``end``.

    The last observed rates are held for two weeks and then move linearly to those of the anchor
    day. Interpolation counts rows: an anchor beyond the horizon sits one row after it
    (``corrected`` counts days). ``rates`` is read several times: pass a staged table.
    """
    distinct = spans.agg(F.collect_set(F.struct(*SPAN))).scalar()  # at most one per scenario
    day = F.col("date_onset")
    subset = rates.withColumn("_span", F.explode(distinct)).select("*", "_span.*").where(day.between(F.col("first"), F.col("last")))
    places = F.array_compact(
        F.array(
            day,
            F.when(day == F.col("last"), F.date_add(day, cfg.hold_days)),
            F.when(day == F.lit(cfg.anchor_date), F.date_add("last", cfg.anchor_days)),
        )
    )
    placed = subset.withColumn("date_onset", F.explode(places)).select(*SPAN, *MEMBER, "date_onset", *RATES)
    full = complete_daily(placed, "date_onset", MEMBER, within=SPAN, start=F.col("first"), end=F.col("end"))
    filled = interpolate(full, RATES, [*SPAN, *MEMBER], "date_onset", by_date=cfg.corrected, extend_ends=True)
    day_key = [*SPAN, "bootstrap", "date_onset"]
    filled = filled.repartition(*day_key)
    same_day = Window.partitionBy(*day_key)
    total = F.sum("pr_age_given_case").over(same_day)
    if not cfg.corrected:
        total = F.when(F.count("pr_age_given_case").over(same_day) == F.count(F.lit(1)).over(same_day), total)
    return filled.withColumn("pr_age_given_case", F.try_divide(F.col("pr_age_given_case"), total))


def extend_ascertainment(ascertainment: DataFrame, spans: DataFrame) -> DataFrame:
    """(first, last, end, date_onset, asc) for each day of a span up to its ``end``, gaps filled."""
    days = F.explode(F.sequence(F.col("first"), F.col("end"), F.expr("interval 1 day")))
    grid = spans.select(*SPAN).distinct().withColumn("date_onset", days)
    known = grid.join(ascertainment.select("date_onset", "asc"), "date_onset", "left")
    return fill_downup(known, ["asc"], SPAN, "date_onset").select(*SPAN, "date_onset", "asc")


def per_scenario(extended: DataFrame, spans: DataFrame) -> DataFrame:
    """Repeat span-keyed rows under each scenario of the span."""
    return extended.join(spans, SPAN).drop(*SPAN)


def summarise_rate(
    rates: DataFrame, rate: str, dates: ForecastDates, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    """Median and 90 % band of one rate over the bootstraps, per day and age group.

    Age shares cover every day and are NULL where any member is; the others start with the
    estimation window and have a NULL median there.
    """
    shares = rate == "pr_age_given_case"
    rows = rates if shares else rates.where(F.col("date_onset") >= F.lit(dates.estimates_start))
    return median_band(rows, ["date_onset", "age_group"], rate, null_band=shares, lenient=cfg.corrected)

"""Observed daily series and forecast fan tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgecast.config import ForecastDates, StudyConfig
from surgecast.operators.quantiles import central_intervals
from surgecast.operators.series import first_per_group, rolling_mean_full
from surgecast.operators.staging import stage
from surgecast.sources.linelists import stay_order
from surgecast.sources.persons import LineList, per_person

FAN_LEVELS = (50, 70, 90)


def _daily(rows: DataFrame, date: str, cfg: StudyConfig, *by: str) -> DataFrame:
    start = cfg.plot_start + dt.timedelta(cfg.plot_warmup_days)
    counts = rows.where(F.col(date) >= F.lit(start)).groupBy(date, *by)
    return counts.agg(F.sum("n").alias("n") if "n" in rows.columns else F.count(F.lit(1)).alias("n"))


def first_row_counts(rows: DataFrame, *by: str) -> DataFrame:
    """First rows per person as counts, from which several daily series are summed."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def _reported(df: DataFrame, cfg: StudyConfig) -> DataFrame:
    return df.where(F.col("date_onset") >= F.lit(cfg.plot_start))


def first_listed_stays(stays: LineList, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """The first stay of each person in file order."""

    def first(rows: DataFrame) -> DataFrame:
        order = [F.col("row_id")] if "row_id" in rows.columns else stay_order(rows, "date_admit", "date_onset", "age_group")
        return first_per_group(_reported(rows, cfg), ["person_id"], order)

    return per_person(stays, first)


def earliest_stays(stays: LineList, dates: ForecastDates, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """The earliest completely reported stay of each person."""
    before = F.lit(dates.hospital_linelist - dt.timedelta(cfg.lag_days))

    def first(rows: DataFrame) -> DataFrame:
        settled = _reported(rows, cfg).where(F.col("date_admit") < before)
        return first_per_group(settled, ["person_id"], stay_order(rows, "date_admit"))

    return per_person(stays, first)


def earliest_presentations(
    presentations: LineList, dates: ForecastDates, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    """The earliest presentation of each person within two weeks of onset."""
    day, onset = F.col("date_presentation"), F.col("date_onset")

    def first(rows: DataFrame) -> DataFrame:
        settled = _reported(rows, cfg).where(
            (day < F.lit(dates.hospital_linelist - dt.timedelta(cfg.lag_days)))
            & (day >= onset)
            & (day <= F.date_add(onset, cfg.stay_cap_days))
        )
        return first_per_group(settled, ["person_id"], stay_order(rows, "date_presentation"))

    return per_person(presentations, first)


def admissions_observed(stays: LineList, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    return _daily(first_listed_stays(stays, cfg), "date_admit", cfg)


def icu_admissions_observed(stays: LineList, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    return _daily(first_listed_stays(stays, cfg), "date_ICU_admit", cfg)


def admissions_smoothed(stays: LineList, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """Seven-row centred mean of the daily admissions; days without admissions are not rows."""
    return _smoothed(admissions_observed(stays, cfg), cfg)


def _smoothed(daily: DataFrame, cfg: StudyConfig) -> DataFrame:
    mean = rolling_mean_full("n", cfg.admission_window, [], "date_admit")
    return daily.select("date_admit", mean.alias("n"))


def ed_observed(
    presentations: LineList, dates: ForecastDates, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    return _daily(earliest_presentations(presentations, dates, cfg), "date_presentation", cfg)


def admissions_observed_aged(stays: LineList, dates: ForecastDates, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    return _daily(earliest_stays(stays, dates, cfg), "date_admit", cfg, "age_group")


def icu_admissions_observed_aged(
    stays: LineList, dates: ForecastDates, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    return _daily(earliest_stays(stays, dates, cfg), "date_ICU_admit", cfg, "age_group")


def ed_observed_aged(
    presentations: LineList, dates: ForecastDates, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    return _daily(earliest_presentations(presentations, dates, cfg), "date_presentation", cfg, "age_group")


def observed_series(
    stays: LineList, presentations: LineList, dates: ForecastDates, cfg: StudyConfig = StudyConfig()
) -> dict[str, DataFrame]:
    """All observed series of a study. Each set of first rows is found once and kept as daily counts."""
    listed = stage(first_row_counts(first_listed_stays(stays, cfg), "date_admit", "date_ICU_admit"))
    settled = stage(first_row_counts(earliest_stays(stays, dates, cfg), "date_admit", "date_ICU_admit", "age_group"))
    visits = stage(first_row_counts(earliest_presentations(presentations, dates, cfg), "date_presentation", "age_group"))
    return {
        "admissions_observed": _daily(listed, "date_admit", cfg),
        "admissions_smoothed": _smoothed(_daily(listed, "date_admit", cfg), cfg),
        "icu_admissions_observed": _daily(listed, "date_ICU_admit", cfg),
        "ed_observed": _daily(visits, "date_presentation", cfg),
        "admissions_observed_aged": _daily(settled, "date_admit", cfg, "age_group"),
        "icu_admissions_observed_aged": _daily(settled, "date_ICU_admit", cfg, "age_group"),
        "ed_observed_aged": _daily(visits, "date_presentation", cfg, "age_group"),
    }


def ensemble_totals(outputs: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum of ``value`` per member, day and group (and ``by``)."""
    return outputs.groupBy("scenario_label", "bootstrap", "date", "group", *by).agg(F.sum(value).alias(value))


def fan_table(
    outputs: DataFrame,
    value: str,
    by: Sequence[str] = (),
    cfg: StudyConfig = StudyConfig(),
    levels: Sequence[int] = FAN_LEVELS,
) -> DataFrame:
    """Central intervals over the ensemble per scenario, day and group (and ``by``).

    Members without a row are ignored, except for admissions by age, where they count as 0: there
    every group is topped up to the number of members in the whole table by one weighted zero row.
    Rows without a bootstrap form one further member. ``corrected`` tops up everywhere and has no
    such member. ``outputs`` is read several times: pass a stored table.
    """
    ids = ["scenario_label", "date", "group", *by]
    if cfg.corrected:
        outputs = outputs.where("bootstrap is not null")
    totals = ensemble_totals(outputs, value, by)
    if not cfg.corrected and not (by and value == "admissions"):
        return central_intervals(totals, ids, value, levels)
    members = outputs.agg(
        F.countDistinct("bootstrap") + F.coalesce(F.max(F.col("bootstrap").isNull().cast("int")), F.lit(0))
    ).scalar()
    rows = totals.select(*ids, value, F.lit(1).cast("bigint").alias("members"))
    zeros = totals.groupBy(*ids).agg((members - F.count(F.lit(1))).alias("members"))
    zeros = zeros.where("members > 0").withColumn(value, F.lit(0).cast("bigint"))
    return central_intervals(rows.unionByName(zeros), ids, value, levels, frequency="members")

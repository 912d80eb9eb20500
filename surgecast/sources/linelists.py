"""Cleaning of raw line lists.

Each formatter keeps a ``row_id`` column if the input has one: it stands for the position in the
file and breaks ties wherever "the first row" matters.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.config import ForecastDates, StudyConfig
from surgecast.functions import age_band, date_from_file_name


def _known_patients(raw: DataFrame, age: str, onset: Column, cfg: StudyConfig) -> DataFrame:
    """Rows with an age and an onset inside the study.

    Rows are filtered on their raw columns, before any are derived: a filter on a derived column is
    pushed below it and would compute it twice.
    """
    known = raw.dropna(subset=[age]).where(onset >= F.lit(cfg.study_start))
    return known.where(F.col(age) >= 0) if cfg.corrected else known


def _row_id(df: DataFrame) -> list[str]:
    return ["row_id"] if "row_id" in df.columns else []


def format_cases(raw: DataFrame, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """Typed case line list -> (date_onset, age_group)."""
    onset = F.col("CALCULATED_ONSET_DATE")
    known = _known_patients(raw, "AGE_AT_EVENT_YEARS", onset, cfg)
    return known.select(onset.alias("date_onset"), age_band(F.col("AGE_AT_EVENT_YEARS")).alias("age_group"))


def format_hospital(raw: DataFrame, cfg: StudyConfig = StudyConfig(), data_date: dt.date | None = None) -> DataFrame:
    """Hospital episodes -> stays with all dates on or after onset.

    ICU dates count only as a valid pair: with a reversed or half-known pair both become NULL. Stays
    that end before they start, or have no end, are dropped. In corrected mode stays still open are
    censored at ``data_date`` instead.
    """
    onset = F.col("ncims_calc_onset_dt").cast("date")
    admit, discharge, icu_admit, icu_discharge = (
        F.col(c).cast("date") for c in ("admit_date", "discharge_date", "first_icu_date", "last_icu_date")
    )
    if cfg.corrected and data_date is not None:
        discharge = F.when(admit.isNotNull(), F.coalesce(discharge, F.lit(data_date)))
        icu_discharge = F.when(icu_admit.isNotNull(), F.coalesce(icu_discharge, F.lit(data_date)))
    # comparisons with an unknown date are not true
    stays = _known_patients(raw, "age", onset, cfg).where((discharge >= admit) & (discharge >= onset))
    in_icu = (icu_discharge >= icu_admit) & (icu_discharge >= onset)
    return stays.select(
        *_row_id(raw),
        "person_id",
        onset.alias("date_onset"),
        age_band(F.col("age")).alias("age_group"),
        F.greatest(admit, onset).alias("date_admit"),
        discharge.alias("date_discharge"),
        F.when(in_icu, F.greatest(icu_admit, onset)).alias("date_ICU_admit"),
        F.when(in_icu, icu_discharge).alias("date_ICU_discharge"),
    )


def format_ed(raw: DataFrame, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """ED rows -> presentations; the date may be unknown or precede onset."""
    onset = F.col("ncims_calc_onset_dt").cast("date")
    return _known_patients(raw, "age", onset, cfg).select(
        *_row_id(raw),
        "person_id",
        onset.alias("date_onset"),
        age_band(F.col("age")).alias("age_group"),
        F.col("presentation_date").cast("date").alias("date_presentation"),
    )


def cases_in_row(cases: DataFrame) -> Column:
    """How many cases a row stands for: ``n`` of daily counts, one of a line list."""
    return (F.col("n") if "n" in cases.columns else F.lit(1)).cast("bigint")


def count_cases(cases: DataFrame) -> DataFrame:
    """(date_onset, age_group, n): a line list, or finer counts, as daily counts."""
    return cases.groupBy("date_onset", "age_group").agg(F.sum(cases_in_row(cases)).alias("n"))


def stay_order(df: DataFrame, *first: str) -> list[Column]:
    """A total order of rows: the given columns (NULL last), then file position or every column."""
    rest = ["row_id"] if "row_id" in df.columns else [c for c in df.columns if c not in ("person_id", *first)]
    return [F.col(c).asc_nulls_last() for c in (*first, *rest)]


def forecast_dates_table(
    cases: DataFrame, hospital_path: str, forecast: dt.date, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    """The study's dates as one row: the hospital data date comes from the file name."""
    seen = cases.where("n > 0") if "n" in cases.columns else cases
    dated = seen.agg(F.max("date_onset").alias("date_case_linelist")).withColumn(
        "date_hospital_linelist", date_from_file_name(F.lit(hospital_path))
    )
    earlier = F.least("date_hospital_linelist", "date_case_linelist")
    return dated.select(
        F.date_sub(earlier, cfg.lookback_days).alias("date_estimates_start"),
        "date_hospital_linelist",
        "date_case_linelist",
        F.lit(forecast).alias("date_forecast"),
    )


def data_date_of(path: str) -> dt.date | None:
    """The data date in a file's name, where stays still open are censored in corrected mode."""
    stamps = re.findall(r"\d{4}_\d{2}_\d{2}", path)
    return dt.datetime.strptime(stamps[0], "%Y_%m_%d").date() if stamps else None


def resolve_forecast_dates(
    cases: DataFrame, hospital_path: str, forecast: dt.date, cfg: StudyConfig = StudyConfig()
) -> ForecastDates:
    """Read that one row, so that later plans carry literal dates the scans can prune by."""
    row = forecast_dates_table(cases, hospital_path, forecast, cfg).first()
    if None in tuple(row):
        raise ValueError(f"no data date in {hospital_path!r}, or no dated case")
    return ForecastDates(*row)

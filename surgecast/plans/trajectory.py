"""Case trajectory: ascertainment-adjusted backcast joined to each scenario's forecast."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgecast.config import ForecastDates, StudyConfig
from surgecast.operators.reshape import fill_daily_gaps
from surgecast.operators.series import interpolate, rolling_extend
from surgecast.sources.linelists import cases_in_row


def backcast(
    cases: DataFrame, ascertainment: DataFrame, dates: ForecastDates, cfg: StudyConfig = StudyConfig()
) -> DataFrame:
    """Daily (date_onset, count): observed cases, smoothed, divided by ascertainment.

    Days from the start of the estimation window are padded with 0; earlier days are kept as they
    are. The result starts with the first ascertainment date, and its last two days are NULL.
    """
    last = _last_day(dates, cfg)
    observed = cases.where(F.col("date_onset") < F.lit(last)).select("date_onset", cases_in_row(cases).alias("seen"))
    padding = cases.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(dates.estimates_start), F.lit(last))).alias("date_onset"), F.lit(0).cast("bigint").alias("seen")
    )
    # one row per day from here on
    daily = observed.unionByName(padding).groupBy("date_onset").agg(F.sum("seen").alias("count"))
    smooth = rolling_extend(daily, {"smooth": "count"}, cfg.case_window, "mean", [], "date_onset")
    first = ascertainment.agg(F.min("date_onset")).scalar()
    adjusted = smooth.where(F.col("date_onset") >= first).join(ascertainment, "date_onset", "left")
    settled = F.col("date_onset") <= F.lit(last - dt.timedelta(2))
    return adjusted.select("date_onset", F.when(settled, F.try_divide("smooth", "asc")).alias("count"))


def _last_day(dates: ForecastDates, cfg: StudyConfig) -> dt.date:
    return dates.case_linelist - dt.timedelta(cfg.lag_days)


def make_case_trajectory(
    forecast: DataFrame,
    ascertainment: DataFrame,
    cases: DataFrame,
    dates: ForecastDates,
    cfg: StudyConfig = StudyConfig(),
) -> DataFrame:
    """(scenario_label, date_onset, count) with a row for every day.

    The forecast takes over after the backcast's last day. Counts are rounded half-to-even and gaps
    interpolated on the line between their neighbours.
    """
    # the backcast is daily-grain; it is repeated under each scenario of the forecast
    labels = forecast.agg(F.collect_set("scenario_label")).scalar()
    history = backcast(cases, ascertainment, dates, cfg).withColumn("scenario_label", F.explode(labels))
    # the backcast reaches the last day, unless ascertainment only starts after it
    last = F.lit(_last_day(dates, cfg))
    no_history = ascertainment.agg(F.min("date_onset")).scalar() > last
    ahead = forecast.where((F.col("date_onset") > last) | no_history)
    columns = ["scenario_label", "date_onset", "count"]
    joined = ahead.select(columns).unionByName(history.select(columns)).withColumn("count", F.rint("count"))
    full = fill_daily_gaps(joined, "date_onset", ["count"], ["scenario_label"], fill=None)
    return interpolate(full, ["count"], ["scenario_label"], "date_onset")

"""The whole study as stored tables, each computed once from the ones before."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surgecast.config import ForecastDates, StudyConfig
from surgecast.operators.staging import release, stage
from surgecast.plans import forecast as fc
from surgecast.plans import occupancy, rates, summaries
from surgecast.plans.trajectory import make_case_trajectory
from surgecast.sources.linelists import count_cases, forecast_dates_table, resolve_forecast_dates
from surgecast.sources.persons import CROWDED, LineList, PersonRows, all_rows, forget, store_by_person
from surgecast.sources.readers import observed_rejects, write_results
from surgecast.sources.results import manifest, open_run, replace_scenarios, seal_run


@dataclass(frozen=True)
class Inputs:
    """Cleaned inputs of a study."""

    cases: DataFrame  # date_onset, age_group; with n, daily counts
    stays: LineList
    presentations: LineList
    ascertainment: DataFrame  # date_onset, asc
    forecast: DataFrame  # scenario_label, date_onset, count
    hospital_path: str
    forecast_date: dt.date
    rejects: DataFrame | None = None  # cells of the input files that could not be read
    observed: Mapping[str, Observation] = field(default_factory=dict)  # counts of such cells, gathered while an input is stored


def dates_of(inputs: Inputs, cfg: StudyConfig) -> ForecastDates:
    return resolve_forecast_dates(inputs.cases, inputs.hospital_path, inputs.forecast_date, cfg)


def staged_rates(inputs: Inputs, dates: ForecastDates, cfg: StudyConfig) -> DataFrame:
    return stage(rates.time_varying_estimates(inputs.cases, inputs.stays, inputs.presentations, dates, cfg))


def staged_trajectory(inputs: Inputs, dates: ForecastDates, cfg: StudyConfig) -> DataFrame:
    return stage(make_case_trajectory(inputs.forecast, inputs.ascertainment, inputs.cases, dates, cfg))


def sampled(inputs: Inputs, dates: ForecastDates, cfg: StudyConfig) -> fc.ForecastTables:
    return fc.sample_patients(
        staged_trajectory(inputs, dates, cfg),
        staged_rates(inputs, dates, cfg),
        inputs.ascertainment,
        inputs.stays,
        inputs.presentations,
        dates,
        cfg,
    )


def forecast_outputs(inputs: Inputs, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """All scenarios' forecast: ward and ICU occupancy and admissions, ED presentations."""
    dates = dates_of(inputs, cfg)
    tables = sampled(inputs, dates, cfg)
    return fc.assemble_outputs(tables.samples, tables.trajectory, dates, cfg)


def _stored(spark: SparkSession, table: DataFrame, path: str) -> DataFrame:
    write_results(table, path)
    return spark.read.schema(table.schema).parquet(path)


def _store_scenarios(inputs: Inputs, estimates: DataFrame, dates: ForecastDates, out: str, cfg: StudyConfig) -> dict[str, DataFrame]:
    """Forecast the scenarios of ``inputs``, store their outputs, and return the tables that are made anew from all stored outputs."""
    spark = inputs.cases.sparkSession
    trajectory = staged_trajectory(inputs, dates, cfg)
    tables = fc.sample_patients(
        trajectory, estimates, inputs.ascertainment, inputs.stays, inputs.presentations, dates, cfg
    )
    made = stage(fc.assemble_outputs(tables.samples, trajectory, dates, cfg))
    empty = trajectory.select("scenario_label").distinct().join(made.select("scenario_label").distinct(), "scenario_label", "left_anti")
    lost = [r["scenario_label"] for r in empty.orderBy("scenario_label").collect()]  # scenarios are few
    replace_scenarios(made, f"{out}/outputs")
    replace_scenarios(trajectory, f"{out}/case_trajectory")
    outputs = spark.read.schema(made.schema).parquet(f"{out}/outputs").where(~F.col("scenario_label").isin(lost))
    results = {"rejected_cells": tables.rejected}
    for value, name in (("count", "occupancy"), ("admissions", "admissions")):
        results[f"fan_{name}"] = summaries.fan_table(outputs, value, cfg=cfg)
        results[f"fan_{name}_aged"] = summaries.fan_table(outputs, value, ["age_group"], cfg)
    return results


def rerun_scenarios(inputs: Inputs, out: str, cfg: StudyConfig = StudyConfig()) -> list[str]:
    """Forecast the scenarios of ``inputs.forecast`` again, into a study that is stored under ``out``.

    Only their directories of outputs and trajectories are replaced; rates are those stored, and
    fan tables are made from all scenarios' outputs. Cells rejected before stay for the other
    scenarios. A run that stops on the way leaves the study without a manifest.
    """
    spark = inputs.cases.sparkSession
    dates = dates_of(inputs, cfg)
    names = [r["name"] for r in manifest(spark, out).select("name").distinct().orderBy("name").collect()]
    if not names:
        raise ValueError(f"no finished study under {out!r}")
    open_run(spark, out)
    estimates = stage(spark.read.parquet(f"{out}/time_varying_estimates"))
    results = _store_scenarios(inputs, estimates, dates, out, cfg)
    before = spark.read.parquet(f"{out}/rejected_cells")
    again = inputs.forecast.select("scenario_label").distinct()
    others = before.join(again, "scenario_label", "left_anti").select(*before.columns)
    results["rejected_cells"] = stage(others.unionByName(results["rejected_cells"]))
    for name, table in results.items():
        if name in names:
            write_results(table, f"{out}/{name}")
    seal_run(spark, out, names)
    release()
    return sorted({"outputs", "case_trajectory", *results} & set(names))


def run_study(inputs: Inputs, out: str, cfg: StudyConfig = StudyConfig(), *, buckets: int | None = None) -> list[str]:
    """Write every table of a study under ``out`` and return their names.

    The cleaned inputs are stored first, cases as daily counts and the other line lists by person, in
    ``buckets`` files each (by default as many as there are shuffle partitions), and everything
    else is computed from what is stored: each input is read and cleaned once, and what is found
    per person needs no exchange. The manifest is written last.
    """
    spark = inputs.cases.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    open_run(spark, out)
    cleaned = {
        "case_counts": count_cases(inputs.cases),
        "ascertainment": inputs.ascertainment,
        "case_forecast": inputs.forecast,
    }
    if inputs.rejects is not None:
        cleaned["rejected_inputs"] = inputs.rejects
    stored = {name: _stored(spark, table, f"{out}/{name}") for name, table in cleaned.items()}
    people: dict[str, PersonRows] = {
        name: store_by_person(all_rows(table), f"{out}/{name}", buckets)
        for name, table in (("hospital_linelist", inputs.stays), ("ED_linelist", inputs.presentations))
    }
    inputs = replace(
        inputs,
        cases=stored["case_counts"],
        stays=people["hospital_linelist"],
        presentations=people["ED_linelist"],
        ascertainment=stored["ascertainment"],
        forecast=stored["case_forecast"],
    )
    dates = dates_of(inputs, cfg)
    estimates = staged_rates(inputs, dates, cfg)
    results = {
        "forecast_dates": forecast_dates_table(inputs.cases, inputs.hospital_path, inputs.forecast_date, cfg),
        "occupancy": occupancy.calculate_occupancy(inputs.stays, cfg),
        "occupancy_aged": occupancy.calculate_occupancy_aged(inputs.stays, cfg),
        "time_varying_estimates": estimates,
        **summaries.observed_series(inputs.stays, inputs.presentations, dates, cfg),
        **_store_scenarios(inputs, estimates, dates, out, cfg),
    }
    for rate in rates.RATES:
        results[f"rate_summary_{rate}"] = rates.summarise_rate(estimates, rate, dates, cfg)
    if inputs.observed:
        results["reject_counts"] = observed_rejects(spark, inputs.observed)
    for name, table in results.items():
        write_results(table, f"{out}/{name}")
    names = [*cleaned, *people, *(name + CROWDED for name in people), "outputs", "case_trajectory", *results]
    seal_run(spark, out, names)
    for table in people.values():
        forget(table)
    release()
    return names


def store_forecast(inputs: Inputs, out: str, cfg: StudyConfig = StudyConfig()) -> list[str]:
    """The forecast part of a study alone: rates, trajectories, outputs and what is rejected, with their manifest."""
    spark = inputs.cases.sparkSession
    dates = dates_of(inputs, cfg)
    open_run(spark, out)
    estimates = staged_rates(inputs, dates, cfg)
    results = {"time_varying_estimates": estimates, "rejected_cells": _store_scenarios(inputs, estimates, dates, out, cfg)["rejected_cells"]}
    for name, table in results.items():
        write_results(table, f"{out}/{name}")
    names = ["outputs", "case_trajectory", *results]
    seal_run(spark, out, names)
    release()
    return names

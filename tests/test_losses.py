"""Nothing is left out without saying so."""

import dataclasses
import datetime as dt

import pytest
from conftest import collected
from pyspark.sql import functions as F

from checks import views as v
from surgecast import StudyConfig
from surgecast.plans import forecast as fc
from surgecast.plans import rates, study, summaries
from surgecast.sources import linelists, readers

SF = "/root/testdata/sf0.001"


def test_a_forecast_stops_on_patients_without_pattern(spark):
    cfg = dataclasses.replace(v.EV_CONFIG, losses="stop")
    with pytest.raises(ValueError, match="no pattern for age group: [1-9]"):
        study.forecast_outputs(v.inputs(spark, SF, cfg), cfg)


def test_a_scenario_without_rates_is_rejected(spark):
    day = dt.date(2024, 1, 1)
    known = spark.createDataFrame([(day + dt.timedelta(i),) for i in range(5)], "date_onset date")
    rows = [("in", day + dt.timedelta(3), 1.0), ("after", day + dt.timedelta(9), 1.0)]
    trajectory = spark.createDataFrame(rows, "scenario_label string, date_onset date, count double")
    unrated = rates.scenarios_without_rates(trajectory, rates.horizons(known, trajectory))
    assert collected(unrated) == [("after",)]
    cell = "scenario_label string, group string, bootstrap int, age_group string, date_onset date, expected double, n long"
    empty = spark.createDataFrame([], cell)
    rejected = fc.rejected_cells(empty, spark.createDataFrame([], "group string, age_group string, mask int, n long"), unrated)
    assert collected(rejected, "scenario_label", "reason") == [("after", fc.NO_RATES)]
    with pytest.raises(ValueError, match=fc.NO_RATES):
        fc.stop_on_losses(rejected, StudyConfig())
    fc.stop_on_losses(rejected, StudyConfig(losses="report"))
    fc.stop_on_losses(rejected.limit(0), StudyConfig())


def test_counts_as_files_write_them(spark):
    texts = ["3", "3.0", "1,234", " 7 ", "0", "2.5", "many", "", None, "-1"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r[0] for r in df.select(readers.parse_count(F.col("x"))).collect()] == [3, 3, 1234, 7, 0, None, None, None, None, -1]


def test_wide_counts_and_their_rejects(spark, tmp_path):
    (tmp_path / "w.csv").write_text(
        'day_specimen_date,"[0, 10)","[80, 150)","odd"\n1/2/2023,3.0,"1,234",x\n2/2/2023,NA,2.5,x\nsoon,4,1,x\n'
    )
    wide = spark.read.csv(str(tmp_path / "w.csv"), header=True, nullValue="NA")
    counted = readers.case_bands_to_counts(wide)
    assert collected(counted, "age_group", "n") == [("0-9", 3), ("80+", 1234)]
    listed = readers.read_case_bands(spark, str(tmp_path / "w.csv"))
    assert collected(listed.groupBy("age_group").count()) == [("0-9", 3), ("80+", 1234)]
    assert collected(readers.case_band_rejects(wide), "day_specimen_date", "band", "text", "reason") == [
        ("2/2/2023", "[80, 150)", "2.5", "unreadable count"),
        ("soon", "[0, 10)", "4", "unreadable date"),
        ("soon", "[80, 150)", "1", "unreadable date"),
    ]


def test_case_file_by_name_and_its_rejects(spark, tmp_path):
    columns = list(reversed(readers.CASE_LINELIST_COLUMNS))
    row = dict.fromkeys(columns, "NA") | {"CASE_ID": "7", "CALCULATED_ONSET_DATE": "2023/03/02", "SYMPTOM_ONSET_DATE": "2023-03-01", "AGE_AT_EVENT_YEARS": "old", "INTERVIEWED_DATE": "2023-13-01"}
    (tmp_path / "c.csv").write_text(",".join(columns) + ",extra\n" + ",".join(row[c] for c in columns) + ",x\n")
    got = readers.read_case_linelist(spark, str(tmp_path / "c.csv"))
    assert got.columns == readers.CASE_LINELIST_COLUMNS
    (r,) = got.collect()
    assert (r.CASE_ID, r.CALCULATED_ONSET_DATE, r.SYMPTOM_ONSET_DATE, r.AGE_AT_EVENT_YEARS) == (7.0, dt.date(2023, 3, 2), dt.date(2023, 3, 1), None)
    rejects = readers.case_linelist_rejects(spark, str(tmp_path / "c.csv"))
    assert collected(rejects, "column", "text", "n") == [("AGE_AT_EVENT_YEARS", "old", 1), ("INTERVIEWED_DATE", "2023-13-01", 1)]


def test_daily_counts_stand_for_a_line_list(spark):
    cases = v.cases(spark, SF)
    counts = linelists.count_cases(cases)
    dates = linelists.resolve_forecast_dates(cases, v.EV_HOSPITAL_PATH, v.EV_FORECAST_DATE, v.EV_CONFIG)
    assert dates == linelists.resolve_forecast_dates(counts, v.EV_HOSPITAL_PATH, v.EV_FORECAST_DATE, v.EV_CONFIG)
    args = (v.stays(spark, SF), v.presentations(spark, SF), dates, v.EV_CONFIG)
    assert collected(rates.rate_cells(cases, *args)) == collected(rates.rate_cells(counts, *args))


def test_observed_series_as_one_by_one(spark):
    stays, visits, cfg = v.stays(spark, SF), v.presentations(spark, SF), v.EV_CONFIG
    dates = linelists.resolve_forecast_dates(v.cases(spark, SF), v.EV_HOSPITAL_PATH, v.EV_FORECAST_DATE, cfg)
    series = summaries.observed_series(stays, visits, dates, cfg)
    alone = {
        "admissions_observed": summaries.admissions_observed(stays, cfg),
        "admissions_smoothed": summaries.admissions_smoothed(stays, cfg),
        "icu_admissions_observed": summaries.icu_admissions_observed(stays, cfg),
        "ed_observed": summaries.ed_observed(visits, dates, cfg),
        "admissions_observed_aged": summaries.admissions_observed_aged(stays, dates, cfg),
        "icu_admissions_observed_aged": summaries.icu_admissions_observed_aged(stays, dates, cfg),
        "ed_observed_aged": summaries.ed_observed_aged(visits, dates, cfg),
    }
    assert series.keys() == alone.keys()
    for name, table in alone.items():
        assert collected(series[name]) == collected(table.select(series[name].columns)), name


def test_study_bounds_remove_rows(spark):
    """Every bound of the stand-in study bites, so a query that ignored one would differ from its SQL."""
    cfg = v.EV_CONFIG
    raw = v.view(spark, SF, "ev_hospital")
    assert raw.where(F.col("ncims_calc_onset_dt") < F.lit(cfg.study_start)).count() > 0
    assert raw.where("age is null").count() > 0
    stays = v.stays(spark, SF)
    dates = linelists.resolve_forecast_dates(v.cases(spark, SF), v.EV_HOSPITAL_PATH, v.EV_FORECAST_DATE, cfg)
    onset = F.col("date_onset")
    assert stays.where(onset < F.lit(dates.estimates_start)).count() > 0
    assert stays.where(onset >= F.lit(dates.hospital_linelist - dt.timedelta(cfg.lag_days))).count() > 0
    assert stays.where(onset < F.lit(cfg.plot_start)).count() > 0
    assert dates.hospital_linelist < dates.case_linelist

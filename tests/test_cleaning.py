import datetime as dt

import pytest
from conftest import collected, day
from pyspark.sql import functions as F

from surgecast import StudyConfig
from surgecast.functions import age_band, band_from_interval_label, counted_days, date_from_file_name, parse_dmy
from surgecast.sources import readers
from surgecast.sources.linelists import format_cases, format_ed, format_hospital, forecast_dates_table, resolve_forecast_dates


def test_age_band(spark):
    ages = [None, -1.0, 0.0, 9.5, 10.0, 79.0, 80.0, 120.0]
    df = spark.createDataFrame([(a,) for a in ages], "age double")
    got = [r[0] for r in df.select(age_band(F.col("age"))).collect()]
    assert got == [None, "invalid", "0-9", "0-9", "10-19", "70-79", "80+", "80+"]


def test_interval_labels(spark):
    df = spark.createDataFrame([(x,) for x in ["[0, 10)", "[70, 80)", "[80, 150)", "odd", None]], "x string")
    loose, strict = band_from_interval_label(F.col("x")), band_from_interval_label(F.col("x"), strict=True)
    assert [tuple(r) for r in df.select(loose, strict).collect()] == [
        ("0-9", "0-9"), ("70-79", "70-79"), ("80+", "80+"), ("80+", None), (None, None),
    ]


def test_dates(spark):
    texts = ["12/7/2023", "12-07-2023", "12 Jul 2023", "12/07/23", "12/07/70", "31/02/2023", "soon", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    got = [r[0] for r in df.select(parse_dmy(F.col("x"))).collect()]
    assert got == [dt.date(2023, 7, 12)] * 4 + [dt.date(1970, 7, 12), None, None, None]
    paths = spark.createDataFrame([("data/x_2023_07_12.xlsx",), ("data/x.xlsx",)], "x string")
    assert [r[0] for r in paths.select(date_from_file_name(F.col("x"))).collect()] == [dt.date(2023, 7, 12), None]


def test_counted_days(spark):
    rows = [("2023-01-01", "2023-01-03"), ("2023-01-14", "2023-02-01"), ("2023-01-16", "2023-01-20"), ("2022-12-30", "2023-01-01")]
    df = spark.createDataFrame([(day(a), day(b), day("2023-01-01")) for a, b in rows], "a date, b date, o date")
    got = [r[0] for r in df.select(counted_days("a", "b", "o", 14)).collect()]
    assert got == [0b111, 0b11 << 13, 0, 0b1]


HOSPITAL = "row_id long, person_id long, age double, onset string, admit string, discharge string, icu0 string, icu1 string"


def raw_hospital(spark, rows):
    df = spark.createDataFrame(rows, HOSPITAL)
    names = {"onset": "ncims_calc_onset_dt", "admit": "admit_date", "discharge": "discharge_date",
             "icu0": "first_icu_date", "icu1": "last_icu_date"}
    return df.select("row_id", "person_id", "age", *[F.col(a).cast("timestamp_ntz").alias(b) for a, b in names.items()])


ROWS = [
    (1, 1, 30.0, "2023-01-05", "2023-01-03 10:00:00", "2023-01-08", "2023-01-04", "2023-01-06"),  # clamped
    (2, 2, 30.0, "2023-01-05", "2023-01-06", None, None, None),  # open stay
    (3, 3, 30.0, "2023-01-05", "2023-01-06", "2023-01-05", None, None),  # reversed
    (4, 4, 30.0, "2023-01-05", "2023-01-06", "2023-01-09", "2023-01-07", None),  # ICU without end
    (5, 5, 30.0, "2023-01-05", "2023-01-06", "2023-01-09", "2023-01-02", "2023-01-04"),  # ICU over before onset
    (6, 6, 30.0, "2021-12-31", "2022-01-06", "2022-01-09", None, None),  # before the study
    (7, 7, None, "2023-01-05", "2023-01-06", "2023-01-09", None, None),  # no age
    (8, 8, -1.0, "2023-01-05", "2023-01-06", "2023-01-09", None, None),  # negative age
]


def test_format_hospital(spark):
    got = collected(format_hospital(raw_hospital(spark, ROWS)).drop("row_id"))
    assert got == [
        (1, day("2023-01-05"), "30-39", day("2023-01-05"), day("2023-01-08"), day("2023-01-05"), day("2023-01-06")),
        (4, day("2023-01-05"), "30-39", day("2023-01-06"), day("2023-01-09"), None, None),
        (5, day("2023-01-05"), "30-39", day("2023-01-06"), day("2023-01-09"), None, None),
        (8, day("2023-01-05"), "invalid", day("2023-01-06"), day("2023-01-09"), None, None),
    ]


def test_format_hospital_corrected_censors_open_stays(spark):
    cfg = StudyConfig(semantics="corrected")
    got = {r.person_id: r for r in format_hospital(raw_hospital(spark, ROWS), cfg, day("2023-02-01")).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert got[2].date_discharge == day("2023-02-01")
    assert got[4].date_ICU_discharge == day("2023-02-01")


def test_format_ed_and_cases(spark):
    ed = spark.createDataFrame(
        [(1, 5.0, day("2023-01-05"), None), (2, 5.0, day("2023-01-05"), day("2023-01-01")), (3, 5.0, None, None)],
        "person_id long, age double, ncims_calc_onset_dt date, presentation_date date",
    )
    assert collected(format_ed(ed), "person_id", "date_presentation") == [(1, None), (2, day("2023-01-01"))]
    cases = spark.createDataFrame(
        [(day("2023-01-05"), 81.0), (day("2020-01-05"), 81.0), (None, 3.0), (day("2023-01-05"), None)],
        "CALCULATED_ONSET_DATE date, AGE_AT_EVENT_YEARS double",
    )
    assert collected(format_cases(cases)) == [(day("2023-01-05"), "80+")]


def test_forecast_dates(spark):
    cases = spark.createDataFrame([(day("2023-07-11"), "0-9"), (day("2023-07-01"), "0-9")], "date_onset date, age_group string")
    table = forecast_dates_table(cases, "x_2023_07_12.xlsx", day("2023-07-13"))
    expected = (day("2023-04-12"), day("2023-07-12"), day("2023-07-11"), day("2023-07-13"))
    assert [tuple(r) for r in table.collect()] == [expected]
    dates = resolve_forecast_dates(cases, "x_2023_07_12.xlsx", day("2023-07-13"))
    assert dates.data_min == day("2023-07-11")
    with pytest.raises(ValueError):
        resolve_forecast_dates(cases, "undated.xlsx", day("2023-07-13"))


def test_readers_from_files(spark, tmp_path):
    names = readers.CASE_LINELIST_COLUMNS
    good = dict.fromkeys(names, "NA") | {"CASE_ID": "7", "CALCULATED_ONSET_DATE": "2023-01-02", "AGE_AT_EVENT_YEARS": "x", "SYMPTOMS": '"a, b"'}
    path = tmp_path / "cases.csv"
    path.write_text(",".join(names) + "\n" + ",".join(good[n] for n in names) + "\n")
    (row,) = readers.read_case_linelist(spark, str(path)).collect()
    assert (row.CASE_ID, row.CALCULATED_ONSET_DATE, row.AGE_AT_EVENT_YEARS, row.SYMPTOMS) == (7.0, day("2023-01-02"), None, "a, b")

    (tmp_path / "bands.csv").write_text('day_specimen_date,other,"[0, 10)","[80, 150)"\n1/2/2023,5,3,0\nbad,1,1,1\n')
    got = readers.read_case_bands(spark, str(tmp_path / "bands.csv"))
    assert collected(got) == [(day("2023-02-01"), "0-9")] * 3 + [(day("2023-02-01"), "80+")] * 2
    fixed = readers.read_case_bands(spark, str(tmp_path / "bands.csv"), corrected=True)
    assert collected(fixed) == [(day("2023-02-01"), "0-9")] * 3

    (tmp_path / "asc.csv").write_text("Var1,alpha\n3/2/2023,0.25\n")
    assert collected(readers.read_ascertainment(spark, str(tmp_path / "asc.csv"))) == [(day("2023-02-03"), 0.25)]

    scenarios = {"a": "S 1.6, 10% x", "b": "S b"}
    (tmp_path / "fc.csv").write_text('Date,"S 1.6, 10% x",S b\n3/2/2023,1.5,NA\n')
    got = readers.read_case_forecast(spark, str(tmp_path / "fc.csv"), scenarios)
    assert collected(got) == [("a", day("2023-02-03"), 1.5), ("b", day("2023-02-03"), None)]

    (tmp_path / "ed.csv").write_text("extra,person_id,age,ncims_calc_onset_dt,presentation_date\n1,p1,4,2023-01-05 01:00:00,bad\n")
    (row,) = format_ed(readers.read_presentations(spark, str(tmp_path / "ed.csv"))).collect()
    assert (row.person_id, row.age_group, row.date_onset, row.date_presentation) == ("p1", "0-9", day("2023-01-05"), None)

    (tmp_path / "stays.csv").write_text(
        "person_id,age,ncims_calc_onset_dt,admit_date,discharge_date,first_icu_date,last_icu_date\np1,4,2023-01-05,2023-01-04,2023-01-06,,\n"
    )
    (row,) = format_hospital(readers.read_stays(spark, str(tmp_path / "stays.csv"))).collect()
    assert (row.date_admit, row.date_discharge, row.date_ICU_admit) == (day("2023-01-05"), day("2023-01-06"), None)

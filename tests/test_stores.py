"""Line lists stored by person, replaced scenarios, observed rejects."""

import dataclasses

import pytest
from conftest import collected, day
from pyspark.sql import Observation
from pyspark.sql import functions as F
from test_plans import STAY, stay

from checks import views as v
from surgecast.operators.series import first_per_group
from surgecast.plans import forecast as fc
from surgecast.plans import occupancy, rates, study, summaries
from surgecast.sources import persons, readers, results
from surgecast.sources.linelists import stay_order

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stores")
    stays = persons.store_by_person(v.stays(spark, SF), f"{folder}/stays", 4)
    visits = persons.store_by_person(v.presentations(spark, SF), f"{folder}/visits", 4)
    yield stays, visits, folder
    persons.forget(stays)
    persons.forget(visits)


def plans(inputs, dates, cfg):
    return {
        "occupancy": occupancy.calculate_occupancy(inputs.stays, cfg),
        "occupancy_aged": occupancy.calculate_occupancy_aged(inputs.stays, cfg),
        "patterns": fc.stay_patterns(inputs.stays, dates, cfg),
        "offsets": fc.ed_offsets(inputs.presentations, dates, cfg),
        "cells": rates.rate_cells(inputs.cases, inputs.stays, inputs.presentations, dates, cfg),
        "listed": summaries.first_row_counts(summaries.first_listed_stays(inputs.stays, cfg), "date_admit", "date_ICU_admit"),
        "earliest": summaries.first_row_counts(summaries.earliest_stays(inputs.stays, dates, cfg), "date_admit"),
        "visits": summaries.first_row_counts(summaries.earliest_presentations(inputs.presentations, dates, cfg), "date_presentation"),
    }


def by_person_exchanges(table):
    plan = table._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "person_id" in line]


def test_plans_by_person_need_no_exchange(spark, stored):
    """The same results as from plain tables, without an exchange by person."""
    cfg, inputs = v.EV_CONFIG, v.inputs(spark, SF)
    dates = study.dates_of(inputs, cfg)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = plans(inputs, dates, cfg)
        by_person = plans(dataclasses.replace(inputs, stays=stored[0], presentations=stored[1]), dates, cfg)
        for name, table in by_person.items():
            assert by_person_exchanges(plain[name]) and not by_person_exchanges(table), name
            assert collected(table) == collected(plain[name]), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_person_with_most_rows_is_kept_apart(spark, tmp_path):
    rows = [stay(1, "2023-03-01", f"2023-03-{1 + i % 28:02d}", f"2023-03-{1 + i % 28:02d}", age="0-9" if i % 2 else "80+") for i in range(400)]
    rows += [stay(p, "2023-03-01", "2023-03-02", "2023-03-05") for p in range(2, 60)] + [stay(None, "2023-03-01", "2023-03-02", "2023-03-05")] * 30
    df = spark.createDataFrame(rows, STAY)
    kept = persons.store_by_person(df, str(tmp_path / "s"), 4, most_rows=20)
    assert kept.regular.count() == 58 and kept.crowded.count() == 430
    again = persons.read_by_person(spark, str(tmp_path / "s"), 4)
    for table in (kept, again):
        assert collected(table.all()) == collected(df)
        assert collected(occupancy.calculate_occupancy(table)) == collected(occupancy.calculate_occupancy(df))
        assert collected(occupancy.calculate_occupancy_aged(table)) == collected(occupancy.calculate_occupancy_aged(df))
        first = persons.per_person(table, lambda r: first_per_group(r, ["person_id"], stay_order(r, "date_admit")))
        assert collected(first) == collected(first_per_group(df, ["person_id"], stay_order(df, "date_admit")))
        persons.forget(table)


def test_a_window_of_onsets_skips_row_groups(spark, tmp_path):
    """Files are in order of onset, so statistics exclude the row groups of other days."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(16 * 1024))
    try:
        onset = F.date_add(F.lit(day("2020-01-01")), (F.xxhash64("id") % 500 + 500).cast("int"))
        rows = spark.range(60_000).select(F.col("id").alias("person_id"), onset.alias("date_onset"), F.md5(F.col("id").cast("string")).alias("note"))
        kept = persons.store_by_person(rows, str(tmp_path / "s"), 2)
        plain = str(tmp_path / "plain")
        rows.coalesce(2).write.parquet(plain)
    finally:
        conf.unset("parquet.block.size")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = {}
        for name, table in (("kept", kept.regular), ("plain", spark.read.parquet(plain))):
            few = table.where((F.col("date_onset") >= F.lit(day("2021-01-01"))) & (F.col("date_onset") < F.lit(day("2021-04-01"))))
            rows_found = len(few.collect())
            scan = few._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
            read[name] = scan.metrics().get("numOutputRows").get().value()
            assert rows_found == rows.where("date_onset >= '2021-01-01' and date_onset < '2021-04-01'").count()
        assert read["kept"] < 0.3 * read["plain"] and read["plain"] == 60_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        persons.forget(kept)


# --- replaced scenarios ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def study_folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("study"))
    cfg = dataclasses.replace(v.EV_CONFIG, n_bootstraps=3)
    study.run_study(v.inputs(spark, SF), path, cfg)
    return path, cfg


def test_a_scenario_is_replaced_and_the_others_stay(spark, study_folder):
    path, cfg = study_folder
    assert results.broken_tables(spark, path).count() == 0
    before = {r.scenario_label: r.content for r in results.manifest(spark, path).where("name = 'outputs'").collect()}
    inputs = v.inputs(spark, SF)
    one = dataclasses.replace(inputs, forecast=inputs.forecast.where("scenario_label = '2-HIGH'"))
    fans = {r.scenario_label: r["count"] for r in spark.read.parquet(f"{path}/fan_occupancy").groupBy("scenario_label").count().collect()}
    names = study.rerun_scenarios(one, path, dataclasses.replace(cfg, seed=99))
    assert {"outputs", "case_trajectory", "fan_admissions_aged", "rejected_cells"} <= set(names)
    after = {r.scenario_label: r.content for r in results.manifest(spark, path).where("name = 'outputs'").collect()}
    assert {s for s in before if before[s] != after[s]} == {"2-HIGH"} and before.keys() == after.keys()
    assert results.broken_tables(spark, path).count() == 0
    again = {r.scenario_label: r["count"] for r in spark.read.parquet(f"{path}/fan_occupancy").groupBy("scenario_label").count().collect()}
    assert again.keys() == fans.keys() and all(again[s] == fans[s] for s in fans if s != "2-HIGH")


def test_a_broken_run_is_seen(spark, study_folder, tmp_path):
    path, _ = study_folder
    table = spark.createDataFrame([("a", 1), ("b", 2)], "scenario_label string, x int")
    folder = str(tmp_path)
    results.open_run(spark, folder)
    results.replace_scenarios(table, f"{folder}/outputs")
    with pytest.raises(ValueError, match="did not finish"):
        results.broken_tables(spark, folder)
    with pytest.raises(ValueError, match="no finished study"):
        study.rerun_scenarios(v.inputs(spark, SF), folder, v.EV_CONFIG)
    results.seal_run(spark, folder, ["outputs"])
    assert results.broken_tables(spark, folder).count() == 0
    results.replace_scenarios(spark.createDataFrame([("b", 3)], "scenario_label string, x int"), f"{folder}/outputs")
    assert collected(spark.read.parquet(f"{folder}/outputs"), "scenario_label", "x") == [("a", 1), ("b", 3)]
    assert collected(results.broken_tables(spark, folder)) == [("outputs", "b")]


# --- observed rejects -------------------------------------------------------------------------------


def test_rejects_are_counted_by_the_job_that_stores_the_rows(spark, tmp_path):
    texts = [("1", "30", "2023-01-01", "2023-01-02", "x"), ("2", "old", "2023-01-01", "2023-13-02", "2023-01-03"), ("3", None, "?", None, None)]
    path = str(tmp_path / "ed.csv")
    spark.createDataFrame(texts, "person_id string, age string, ncims_calc_onset_dt string, presentation_date string, note string").write.csv(path, header=True)
    rejects = Observation()
    table = readers.read_presentations(spark, path, rejects=rejects)
    table.write.parquet(str(tmp_path / "stored"))
    assert collected(readers.observed_rejects(spark, {"ed": rejects}), "input", "column", "n") == [
        ("ed", "age", 1), ("ed", "ncims_calc_onset_dt", 1), ("ed", "presentation_date", 1),
    ]
    assert spark.read.parquet(str(tmp_path / "stored")).count() == 3


def test_a_study_stores_its_reject_counts(spark, tmp_path):
    cfg = dataclasses.replace(v.EV_CONFIG, n_bootstraps=2)
    inputs, rejects = v.inputs(spark, SF), Observation()
    cases = inputs.cases.observe(rejects, F.count_if(F.col("age_group").isNull()).alias("age_group"))
    study.run_study(dataclasses.replace(inputs, cases=cases, observed={"cases": rejects}), str(tmp_path), cfg)
    assert collected(spark.read.parquet(f"{tmp_path}/reject_counts"), "input", "column", "n") == [("cases", "age_group", 0)]

import dataclasses
import datetime as dt

import pytest
from conftest import collected, day
from pyspark.sql import functions as F

from checks import views as v
from surgecast import ForecastDates, StudyConfig
from surgecast.operators.staging import stage
from surgecast.plans import forecast as fc
from surgecast.plans import rates, study, summaries
from surgecast.plans.occupancy import calculate_occupancy, calculate_occupancy_aged
from surgecast.plans.trajectory import backcast, make_case_trajectory

SF = "/root/testdata/sf0.001"
STAY = "person_id long, date_onset date, age_group string, date_admit date, date_discharge date, date_ICU_admit date, date_ICU_discharge date"
DATES = ForecastDates(day("2023-01-01"), day("2023-06-01"), day("2023-05-31"), day("2023-06-01"))


def stay(person, onset, admit, discharge, icu0=None, icu1=None, age="0-9"):
    return (person, day(onset), age, day(admit), day(discharge), day(icu0), day(icu1))


STAYS = [
    stay(1, "2023-03-01", "2023-03-01", "2023-03-04"),
    stay(1, "2023-03-03", "2023-03-03", "2023-03-06", age="10-19"),  # overlaps the first stay
    stay(2, "2023-03-01", "2023-03-02", "2023-04-30"),  # capped at onset + 14
    stay(3, "2023-03-01", "2023-03-20", "2023-03-25"),  # begins after the cap: no day counts
    stay(4, "2023-03-28", "2023-03-28", "2023-03-29", "2023-03-28", "2023-03-31", age="80+"),  # ICU outlasts the stay
]


def reference_days(stays, start, end):
    """(person, day) of every counted day."""
    days = {}
    for s in sorted(stays, key=lambda s: (s[3], s[1], s[2])):
        if s[start] is None:
            continue
        last = min(s[end], s[1] + dt.timedelta(14))
        d = max(s[start], s[1])
        while d <= last:
            days.setdefault((s[0], d), s[2])
            d += dt.timedelta(1)
    return days


def expected_occupancy(stays):
    hospital, icu = reference_days(stays, 3, 4), reference_days(stays, 5, 6)
    dates = [d for _, d in hospital]
    out = {}
    d = min(dates)
    while d < max(dates):
        n = sum(1 for _, x in hospital if x == d)
        i = sum(1 for _, x in icu if x == d) if n else 0
        out[d] = (float(n - i), float(i))
        d += dt.timedelta(1)
    return out


def wide(occupancy, *keys):
    return {
        tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: (r.ward, r.ICU)
        for r in occupancy.groupBy(*keys).pivot("group", ["ward", "ICU"]).agg(F.first("count")).collect()
    }


def test_occupancy(spark):
    got = wide(calculate_occupancy(spark.createDataFrame(STAYS, STAY)), "date")
    assert got == expected_occupancy(STAYS)
    assert got[day("2023-03-03")] == (2.0, 0.0)  # person 1 counts once
    assert got[day("2023-03-20")] == (0.0, 0.0)  # gap
    assert max(got) == day("2023-03-28")  # last day dropped


def test_occupancy_of_icu_days_outside_the_stay_is_negative(spark):
    stays = [*STAYS, stay(5, "2023-03-28", "2023-03-30", "2023-04-02")]
    got = wide(calculate_occupancy(spark.createDataFrame(stays, STAY)), "date")
    assert got == expected_occupancy(stays)
    assert got[day("2023-03-30")] == (0.0, 1.0)


def test_occupancy_aged(spark):
    got = wide(calculate_occupancy_aged(spark.createDataFrame(STAYS, STAY)), "age_group", "date")
    hospital = reference_days(STAYS, 3, 4)
    for (age, date), (ward, icu) in got.items():
        assert ward + icu == sum(1 for (_, d), a in hospital.items() if (a, d) == (age, date))
    assert {a for a, _ in got} == {"0-9", "10-19", "80+"}
    assert got["0-9", day("2023-03-04")] == (2.0, 0.0) and got["10-19", day("2023-03-05")] == (1.0, 0.0)
    assert len(got) == 3 * 28


def test_occupancy_with_one_person_holding_most_stays(spark):
    base = day("2023-01-01")
    hot = spark.range(3000).select(
        F.lit(1).cast("long").alias("person_id"), F.expr("date_add(date'2023-01-01', int(id % 100))").alias("date_onset")
    )
    rest = spark.range(50).select(
        (F.col("id") + 2).alias("person_id"), F.expr("date_add(date'2023-01-01', int(id))").alias("date_onset")
    )
    stays = hot.union(rest).selectExpr(
        "person_id", "date_onset", "'0-9' age_group", "date_onset date_admit", "date_add(date_onset, 2) date_discharge",
        "cast(null as date) date_ICU_admit", "cast(null as date) date_ICU_discharge",
    )
    got = wide(calculate_occupancy(stays), "date")
    assert wide(calculate_occupancy_aged(stays), "date") == got
    for i in range(101):
        others = sum(1 for p in range(50) if p <= i <= p + 2)
        assert got[base + dt.timedelta(i)] == (1.0 + others, 0.0)


def test_stay_patterns(spark):
    patterns = fc.stay_patterns(spark.createDataFrame(STAYS, STAY), DATES)
    shown = patterns.select("group", "age_group", fc.mask_days(F.col("mask")).alias("d"), "n")
    got = {(r.group, r.age_group, tuple(r.d)): r.n for r in shown.collect()}
    assert got == {
        ("ward", "0-9", (0, 1, 2, 3)): 1,  # a person's stays merge within an age group only
        ("ward", "10-19", (0, 1, 2, 3)): 1,
        ("ward", "0-9", tuple(range(1, 15))): 1,
        ("ward", "0-9", ()): 1,
        ("ward", "80+", (0, 1)): 1,
        ("ICU", "80+", (0, 1, 2, 3)): 1,
    }


def test_ed_offsets(spark):
    rows = [(1, 0), (1, 0), (1, 14), (2, 15), (3, -2), (4, None)]
    df = spark.createDataFrame(
        [(p, "0-9", day("2023-03-05"), None if o is None else day("2023-03-05") + dt.timedelta(o)) for p, o in rows],
        "person_id long, age_group string, date_onset date, date_presentation date",
    )
    assert collected(fc.ed_offsets(df, DATES), "mask", "n") == [(0, 2), (1, 1), (1 << 14, 1)]


def test_backcast(spark):
    cfg = StudyConfig()
    dates = ForecastDates(day("2023-01-01"), day("2023-01-10"), day("2023-01-10"), day("2023-01-10"))
    cases = spark.createDataFrame([(day(f"2023-01-{d:02d}"), "0-9") for d in (2, 3, 3, 3, 4, 6, 9)], "date_onset date, age_group string")
    asc = spark.createDataFrame([(day(f"2023-01-{d:02d}"), 0.5) for d in range(3, 9) if d != 5], "date_onset date, asc double")
    got = dict(collected(backcast(cases, asc, dates, cfg)))
    assert got == {
        day("2023-01-03"): pytest.approx(5 / 3 / 0.5), day("2023-01-04"): pytest.approx(4 / 3 / 0.5),
        day("2023-01-05"): None, day("2023-01-06"): pytest.approx(1 / 3 / 0.5),
        day("2023-01-07"): None, day("2023-01-08"): None,
    }
    forecast = spark.createDataFrame(
        [("a", day("2023-01-08"), 99.0), ("a", day("2023-01-10"), 11.0), ("b", day("2023-01-09"), 2.5)],
        "scenario_label string, date_onset date, count double",
    )
    rows = collected(make_case_trajectory(forecast, asc, cases, dates, cfg))
    trajectory = {s: [c for x, _, c in rows if x == s] for s in ("a", "b")}
    assert trajectory["a"] == pytest.approx([3, 3, 2, 1, 3.5, 6, 8.5, 11])
    assert trajectory["b"] == pytest.approx([3, 3, 2, 1, 1 + 1 / 3, 1 + 2 / 3, 2])


def numerators(spark, rows):
    columns = "bootstrap int, age_group string, date_onset date, n_case long, n_hosp long, n_ICU long, n_ED long"
    return spark.createDataFrame(rows, columns)


def test_smooth_rates(spark):
    rows = [(1, "0-9", day(f"2023-01-{d:02d}"), 2, 1, 0, 1) for d in range(1, 9)]
    rows += [(1, "80+", day("2023-01-01"), 4, 0, 0, 0)]
    got = {(r.age_group, r.date_onset.day): r for r in rates.smooth_rates(numerators(spark, rows), DATES, StudyConfig()).collect()}
    assert len(got) == 16
    young, old = got["0-9", 4], got["80+", 4]
    assert (young.pr_hosp, young.pr_ICU, young.pr_ED) == (0.5, 0.0, 0.5)
    assert old.pr_hosp == 0.0 and old.pr_ICU == 0.0  # 0/0 in ICU counts as 0
    assert got["80+", 5].pr_hosp is None  # no cases in the window
    assert young.pr_age_given_case + old.pr_age_given_case == pytest.approx(1)
    assert old.pr_age_given_case == pytest.approx(4 / 18)


def test_extend_rates_counts_rows_to_the_anchor(spark):
    cfg = StudyConfig(anchor_date=day("2023-01-02"))
    days = [day("2023-01-01") + dt.timedelta(i) for i in range(5)]
    table = spark.createDataFrame(
        [(1, "0-9", d, float(i), 0.0, 0.0, 1.0) for i, d in enumerate(days)],
        "bootstrap int, age_group string, date_onset date, pr_hosp double, pr_ICU double, pr_ED double, pr_age_given_case double",
    )
    trajectory = spark.range(25).selectExpr("'s' scenario_label", "date_add(date'2023-01-01', int(id)) date_onset", "1D count")
    spans = rates.horizons(table, trajectory)

    def extended(config):
        ahead = rates.per_scenario(rates.extend_rates(table, spans, config), spans)
        return {r.date_onset: r.pr_hosp for r in ahead.collect()}

    got = extended(cfg)
    assert got[day("2023-01-05")] == got[day("2023-01-19")] == got[day("2023-01-12")] == 4.0
    # the anchor lies on 6 March; in rows it comes right after 25 January
    assert got[day("2023-03-06")] == 1.0
    assert got[day("2023-01-20")] == pytest.approx(4 - 3 / 7)
    exact = extended(dataclasses.replace(cfg, semantics="corrected"))
    assert exact[day("2023-01-20")] == pytest.approx(4 - 3 / 46)


@pytest.fixture(scope="module")
def run(spark):
    cfg = dataclasses.replace(v.EV_CONFIG, n_bootstraps=5)
    inputs = v.inputs(spark, SF)
    dates = study.dates_of(inputs, cfg)
    tables = study.sampled(inputs, dates, cfg)
    return cfg, inputs, dates, tables, stage(fc.assemble_outputs(tables.samples, tables.trajectory, dates, cfg))


def test_every_patient_gets_a_pattern(run):
    cfg, _, _, tables, _ = run
    expected = stage(tables.expected)
    drawn = fc.drawn_patients(expected, tables.patterns, cfg)
    rejected = fc.rejected_cells(expected, tables.patterns).agg(F.sum("n")).first()[0] or 0
    assert drawn.count() == expected.agg(F.sum(F.greatest("n", F.lit(0)))).first()[0] - rejected


def test_samples_equal_patient_by_patient_counting(run):
    cfg, _, _, tables, _ = run
    drawn = stage(fc.drawn_patients(tables.expected, tables.patterns, cfg))
    keys = ["scenario_label", "group", "bootstrap", "age_group"]
    days = drawn.select(*keys, "date_onset", fc.mask_days(F.col("mask")).alias("d")).where("size(d) > 0")
    occupied = days.select(*keys, F.explode("d").alias("o"), "date_onset").groupBy(*keys, F.expr("date_add(date_onset, o)").alias("date")).count()
    admitted = days.groupBy(*keys, F.expr("date_add(date_onset, d[0])").alias("date")).count()
    assert occupied.exceptAll(tables.samples.select(*keys, "date", "occupied")).count() == 0
    assert admitted.exceptAll(tables.samples.where("admitted > 0").select(*keys, "date", "admitted")).count() == 0
    assert tables.samples.where("admitted > occupied").count() == 0


def test_outputs_shape(run):
    cfg, _, dates, tables, outputs = run
    beds = outputs.where("group != 'ED'")
    assert beds.where("admissions > count").count() == 0
    per_member = beds.groupBy("scenario_label", "group").agg(
        F.count("*").alias("n"), F.countDistinct("bootstrap", "age_group", "date").alias("k")
    )
    assert all(r.n == r.k for r in per_member.collect())
    assert outputs.agg(F.min("date")).first()[0] >= dates.estimates_start + dt.timedelta(14)
    assert outputs.agg(F.max("date")).first()[0] <= tables.trajectory.agg(F.max("date_onset")).first()[0]
    filler = outputs.where("bootstrap is null")
    assert filler.where("group is not null or count != 0 or admissions != 0").count() == 0


def test_corrected_outputs_are_complete(run):
    cfg, _, dates, tables, _ = run
    fixed = dataclasses.replace(cfg, semantics="corrected")
    outputs = fc.assemble_outputs(tables.samples, tables.trajectory, dates, fixed)
    assert outputs.where("bootstrap is null or group is null").count() == 0
    ed = outputs.where("group = 'ED'").groupBy("scenario_label").agg(
        F.count("*").alias("n"), (F.countDistinct("bootstrap") * F.countDistinct("age_group") * F.countDistinct("date")).alias("k")
    )
    assert all(r.n == r.k for r in ed.collect())


def test_fan_counts_absent_members_as_zero_for_admissions_by_age(spark, run):
    cfg = run[0]
    rows = [("s", b, day("2023-01-01"), "0-9", "ED", 0, 10) for b in (1, 2)]
    rows += [("s", 3, day("2023-01-02"), "0-9", "ED", 0, 10), ("s", None, day("2023-01-03"), "0-9", None, 0, 0)]
    outputs = spark.createDataFrame(rows, run[4].schema)
    pick = lambda df: {r.date.day: (r.lower, r.upper) for r in df.where("quant = 50").collect()}
    assert pick(summaries.fan_table(outputs, "admissions", cfg=cfg)) == {1: (10, 10), 2: (10, 10), 3: (0, 0)}
    # members 1, 2, 3 and the one without a bootstrap
    assert pick(summaries.fan_table(outputs, "admissions", ["age_group"], cfg)) == {1: (0, 10), 2: (0, 2.5), 3: (0, 0)}
    fixed = dataclasses.replace(cfg, semantics="corrected")
    assert pick(summaries.fan_table(outputs, "admissions", cfg=fixed)) == {1: (5, 10), 2: (0, 5)}


def test_first_listed_and_earliest_stay_differ(spark):
    rows = [(2, *stay(1, "2023-01-05", "2023-01-07", "2023-01-09")), (1, *stay(1, "2023-01-05", "2023-01-08", "2023-01-09"))]
    df = spark.createDataFrame(rows, "row_id long, " + STAY)
    assert summaries.first_listed_stays(df).first().date_admit == day("2023-01-08")
    assert summaries.earliest_stays(df, DATES).first().date_admit == day("2023-01-07")


def test_run_study_writes_every_table(spark, tmp_path):
    cfg = dataclasses.replace(v.EV_CONFIG, n_bootstraps=3)
    names = study.run_study(v.inputs(spark, SF), str(tmp_path), cfg)
    assert len(names) == len(set(names)) == 29
    counts = {n: spark.read.parquet(f"{tmp_path}/{n}").count() for n in names}
    assert all(counts[n] > 0 for n in names if n != "rejected_cells" and not n.endswith("_crowded"))
    assert (tmp_path / "outputs" / "scenario_label=2-HIGH").is_dir()


def test_rates_do_not_depend_on_partitioning(spark):
    cfg = dataclasses.replace(v.EV_CONFIG, n_bootstraps=3)
    inputs = v.inputs(spark, SF)
    dates = study.dates_of(inputs, cfg)

    def run():
        return collected(rates.time_varying_estimates(inputs.cases, inputs.stays, inputs.presentations, dates, cfg))

    width = spark.conf.get("spark.sql.shuffle.partitions")
    first = run()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert [r[:3] for r in first] == [r[:3] for r in again]
    assert all(a == pytest.approx(b) for r, s in zip(first, again, strict=True) for a, b in zip(r[3:], s[3:], strict=True) if a is not None)

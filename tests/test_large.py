"""Operators on groups and series too large for one task, and draws at a cost that ignores the units."""

import math
import random

import numpy as np
import pytest
from conftest import collected, day
from pyspark.sql import functions as F

from surgecast import StudyConfig
from surgecast.functions import hashed_uniform
from surgecast.functions.hashing import key_text, sequence_seeds, sequence_uniform
from surgecast.operators import intervals, long_series, sampling, selection, series
from surgecast.plans import forecast as fc
from surgecast.plans.occupancy import calculate_occupancy, calculate_occupancy_aged
from tests_reference import long_occupancy

ROWS = [(i, None if i % 7 in (2, 3) or i < 4 or i > 394 else float((i * 37) % 101)) for i in range(400)]


@pytest.fixture(scope="module")
def numbers(spark):
    df = spark.createDataFrame(ROWS, "i long, x double").repartition(5)
    return df, long_series.long_series(df, ["i"], rows_a_block=16)


def test_rows_are_numbered_in_order(numbers):
    _, long = numbers
    assert long.n == 400 and long.block == 16
    assert collected(long.rows, "i", "_rn") == [(i, i) for i in range(400)]


@pytest.mark.parametrize(("width", "how"), [(3, "mean"), (7, "sum"), (31, "mean")])
def test_long_rolling_equals_plain(numbers, width, how):
    df, long = numbers
    want = collected(series.rolling_extend(df.withColumn("p", F.lit(1)), {"y": "x"}, width, how, ["p"], "i"), "i", "y")
    got = collected(long_series.rolling_extend_long(long, {"y": "x"}, width, how), "i", "y")
    assert [r[0] for r in got] == list(range(400))
    assert all(a == pytest.approx(b) for (_, a), (_, b) in zip(got, want, strict=True))
    mean = series.rolling_mean_full("x", width, [], "i")
    want = collected(df.select("i", mean.alias("y")))
    got = collected(long_series.rolling_mean_full_long(long, {"y": "x"}, width), "i", "y")
    assert all(a == pytest.approx(b) for (_, a), (_, b) in zip(got, want, strict=True))


def test_a_window_wider_than_a_block_is_refused(numbers):
    with pytest.raises(ValueError, match="block"):
        long_series.rolling_extend_long(numbers[1], {"y": "x"}, 41, "sum").count()


def test_long_fill_and_interpolation_equal_plain(numbers):
    df, long = numbers
    one = df.withColumn("p", F.lit(1))
    assert collected(long_series.fill_downup_long(long, ["x"])) == collected(series.fill_downup(one, ["x"], ["p"], "i"), "i", "x")
    for extend in (False, True):
        want = collected(series.interpolate(one, ["x"], ["p"], "i", extend_ends=extend), "i", "x")
        got = collected(long_series.interpolate_long(long, ["x"], extend_ends=extend), "i", "x")
        assert all(a == pytest.approx(b) for (_, a), (_, b) in zip(got, want, strict=True))


def test_values_known_only_far_away_are_carried(spark):
    rows = [(i, float(i) if i in (50, 350) else None) for i in range(400)]
    long = long_series.long_series(spark.createDataFrame(rows, "i long, x double"), ["i"], rows_a_block=16)
    got = dict(collected(long_series.fill_downup_long(long, ["x"])))
    assert got == {i: 350.0 if i >= 350 else 50.0 for i in range(400)}
    got = dict(collected(long_series.interpolate_long(long, ["x"])))
    assert got == {i: pytest.approx(float(i)) if 50 <= i <= 350 else None for i in range(400)}


def test_short_and_empty_series(spark):
    long = long_series.long_series(spark.createDataFrame([(1, 2.0)], "i long, x double"), ["i"])
    assert collected(long_series.rolling_extend_long(long, {"y": "x"}, 3, "sum")) == [(1, 2.0, None)]
    none = long_series.long_series(spark.createDataFrame([], "i long, x double"), ["i"])
    assert long_series.fill_downup_long(none, ["x"]).collect() == [] and long_series.rolling_extend_long(none, {"y": "x"}, 3, "sum").collect() == []


def test_no_task_holds_a_long_series(numbers):
    _, long = numbers
    for df in (long_series.rolling_extend_long(long, {"y": "x"}, 7, "sum"), long_series.interpolate_long(long, ["x"]), long_series.fill_downup_long(long, ["x"])):
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()


# --- quantiles --------------------------------------------------------------------------------------


def test_exact_quantiles(spark):
    rng = random.Random(2)
    groups = {
        "even": [rng.uniform(-5, 5) for _ in range(3000)],
        "spread": [10 ** rng.uniform(-300, 300) * rng.choice((-1, 1)) for _ in range(500)],
        "same": [2.5] * 700,
        "ties": [float(rng.randrange(3)) for _ in range(901)],
        "widest": [-1.7e308, 0.0, 1.7e308],
        "one": [4.0],
        None: [1.0, 2.0, float("nan"), float("inf"), None],
    }
    rows = [(g, x) for g, values in groups.items() for x in values] + [("none", None)]
    points = (0.0, 0.05, 0.5, 0.77, 1.0)
    got = {(r.g, r.p): (r.n, r.quantile) for r in selection.exact_quantiles(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", points).collect()}
    finite = {g: sorted(x for x in values if x is not None and math.isfinite(x)) for g, values in groups.items()}
    assert got.keys() == {(g, p) for g in finite for p in points}
    for (g, p), (n, q) in got.items():
        values = finite[g]
        at = p * (len(values) - 1)
        low, high = values[math.floor(at)], values[math.ceil(at)]
        assert n == len(values) and q == pytest.approx(low + (high - low) * (at - math.floor(at)), rel=1e-12)


def test_quantiles_count_before_they_shuffle(spark, monkeypatch):
    """What is shuffled of a group is counts of its ranges' parts."""
    seen = []
    real = selection.stage
    monkeypatch.setattr(selection, "stage", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.sqrt("id").alias("x"))
    selection.exact_quantiles(df, ["g"], "x", (0.5,)).collect()
    passes = [p for p in seen if "_part" in p]
    assert passes and all("partial_count" in p for p in passes)


# --- intervals --------------------------------------------------------------------------------------


def test_interval_union_in_small_tasks(spark):
    """More tasks than shuffle partitions hold the intervals, of crowded keys and null ones too; stored by key they stay in place."""
    rows = [(k, day, day + d) for k in (None, *range(300)) for day in range(0, 40, 4) for d in (0, 1, 2)] + [(5, 100, 100)] * 2000
    days = spark.createDataFrame(rows, "k long, f int, l int").select("k", F.date_from_unix_date("f").alias("first"), F.date_from_unix_date("l").alias("last"))
    whole = intervals.interval_union(days, ["k"], "first", "last")
    n = intervals.TASKS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = [r["n"] for r in whole.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > n / 2 and max(sizes) < whole.count() / 8
    assert collected(whole) == collected(intervals.interval_union(days, ["k"], "first", "last", spread=False))
    assert whole.count() == 301 * 10 + 1


def test_interval_union(spark):
    rows = [(1, 0, 5), (1, 3, 9), (1, 10, 12), (1, 14, 14), (1, 20, 18), (1, 2, 2), (2, 1, 1), (2, None, 4), (2, 3, None), (1, 14, 40), (1, 15, 16)]
    df = spark.createDataFrame([(k, a, b) for k, a, b in rows], "k int, a int, b int")
    days = df.select("k", F.date_add(F.lit(day("2023-01-01")), F.col("a")).alias("first"), F.date_add(F.lit(day("2023-01-01")), F.col("b")).alias("last"))
    got = collected(intervals.interval_union(days, ["k"], "first", "last"))
    assert [(k, (a - day("2023-01-01")).days, (b - day("2023-01-01")).days) for k, a, b in got] == [(1, 0, 12), (1, 14, 40), (2, 1, 1)]


@pytest.mark.parametrize("cap", [14, 15, 16, 40, 60])
def test_occupancy_of_any_cap(spark, cap):
    rng = random.Random(cap)
    rows = []
    for _ in range(120):
        onset = rng.randrange(100)
        admit = onset + rng.randrange(0, 20)
        icu = admit + rng.randrange(-2, 5) if rng.random() < 0.4 else None
        rows.append((rng.randrange(25), onset, rng.choice(("0-9", "80+")), admit, admit + rng.randrange(0, 70), max(icu, onset) if icu is not None else None, icu + rng.randrange(3, 60) if icu is not None else None))
    cfg = StudyConfig(stay_cap_days=cap)
    first = day("2023-01-01")
    names = ["date_onset", "date_admit", "date_discharge", "date_ICU_admit", "date_ICU_discharge"]
    df = spark.createDataFrame(rows, "person_id int, date_onset int, age_group string, date_admit int, date_discharge int, date_ICU_admit int, date_ICU_discharge int")
    df = df.withColumns({n: F.date_add(F.lit(first), F.col(n)) for n in names})
    plain, aged = long_occupancy(rows, cap)
    got = {((r.date - first).days, r.group): r["count"] for r in calculate_occupancy(df, cfg).collect()}
    assert got == plain
    got = {(r.age_group, (r.date - first).days, r.group): r["count"] for r in calculate_occupancy_aged(df, cfg).collect()}
    assert got == aged


# --- draws ------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("n", "part", "whole"), [(5, 1, 3), (40, 1, 2), (1000, 1, 200), (900, 7, 10), (100_000, 1, 2), (10**7, 1, 10**6), (10**9, 3, 10)])
def test_binomials_have_mean_variance_and_tails(spark, n, part, whole):
    draws = 4000
    u, v = (hashed_uniform(3, p, F.col("id"), F.lit(n), F.lit(part)) for p in ("u", "v"))
    k = sampling.binomial(F.lit(n).cast("bigint"), F.lit(part).cast("bigint"), F.lit(whole).cast("bigint"), u, v)
    got = np.array([r[0] for r in spark.range(draws).select(k).collect()])
    p = part / whole
    sd = math.sqrt(n * p * (1 - p))
    assert got.min() >= 0 and got.max() <= n
    assert abs(got.mean() - n * p) < 5 * sd / math.sqrt(draws)
    assert got.var() == pytest.approx(sd * sd, rel=0.15)
    wanted = np.random.default_rng(1).binomial(n, p, 200_000)
    for level in (0.01, 0.05, 0.5, 0.95, 0.99):
        assert abs(np.quantile(got, level) - np.quantile(wanted, level)) <= 0.2 * sd + 1


def test_binomials_at_the_ends(spark):
    rows = [(0, 1, 2, 0), (7, 3, 3, 7), (7, 0, 3, 0), (1, 1, 1, 1)]
    df = spark.createDataFrame(rows, "n long, part long, whole long, k long")
    got = df.select(sampling.binomial(F.col("n"), F.col("part"), F.col("whole"), F.lit(0.999999), F.lit(0.5)).alias("got"), "k").collect()
    assert all(r.got == r.k for r in got)


def test_split_counts_are_like_resampled_ones(spark):
    """Mean, variance and tails of every cell's count, split against drawn unit by unit."""
    weights = [1, 5, 0, 40, 200, 3, 700, 51]
    cells = spark.createDataFrame([("s", i, w) for i, w in enumerate(weights)] + [("t", 0, 9)], "s string, c int, n long")
    stats = {}
    for method in (sampling.multinomial_counts, sampling.bootstrap_counts):
        drawn = method(cells, ["s"], ["c"], "n", 1500, 11)
        assert drawn.groupBy("s", "bootstrap").agg(F.sum("n").alias("n")).groupBy("s").agg(F.min("n"), F.max("n"), F.count("*")).orderBy("s").collect() == [
            ("s", 1000, 1000, 1500), ("t", 9, 9, 1500),
        ]
        counts = drawn.where("s = 's'").groupBy("bootstrap").pivot("c", [i for i, w in enumerate(weights) if w]).agg(F.max("n")).fillna(0).drop("bootstrap")
        stats[method] = np.array(counts.collect(), float)
    a, b = stats.values()
    p = np.array([w for w in weights if w]) / 1000
    sd = np.sqrt(1000 * p * (1 - p))
    for got in (a, b):
        assert (abs(got.mean(axis=0) - 1000 * p) < 5 * sd / math.sqrt(1500)).all()
        assert np.allclose(got.var(axis=0), sd**2, rtol=0.25)
    assert (abs(np.quantile(a, [0.05, 0.95], axis=0) - np.quantile(b, [0.05, 0.95], axis=0)) <= 0.35 * sd + 1).all()
    # cells of one total move against each other
    assert np.corrcoef(a[:, 5], a[:, 3])[0, 1] == pytest.approx(-math.sqrt(p[5] * p[3] / (1 - p[5]) / (1 - p[3])), abs=0.08)


@pytest.mark.parametrize("weights", [[3, 1, 50, 7, 2000, 1], [5, 5, 5], [9], [1, 10**9, 1, 1], [0, 4, 0, 6], list(range(1, 60))])
def test_alias_slots_hold_each_weight_exactly(spark, weights):
    cells = spark.createDataFrame([("g", i, w) for i, w in enumerate(weights)] + [("h", 0, 2)], "g string, c int, n long")
    rows = sampling.alias_slots(cells, ["g"], ["c"], "n").where("g = 'g'").orderBy("_slot").collect()
    known = [w for w in weights if w]
    total = sum(known)
    held = [0] * len(known)
    for i, r in enumerate(rows):
        assert r._slot == i and 0 <= r._limit <= total and r._slots == len(known) and r._total == total
        held[i] += r._limit
        held[r._alias] += total - r._limit
    assert held == [w * len(known) for w in known]


def test_alias_draws_match_their_table(spark):
    cells = spark.createDataFrame([("g", c, w) for c, w in (("a", 1), ("b", 30), ("c", 969))] + [("h", "z", 4)], "g string, c string, n long")
    table = sampling.alias_arrays(cells, ["g"], ["c"], "n")
    units = spark.createDataFrame([("g", 1, 50_000), ("h", 2, 70), ("i", 3, 10)], "g string, k int, m long")
    got = sampling.draw_aliased(units, F.col("m"), ["g", "k"], table, ["g"], 5, "test").groupBy("g", "c").count()
    n = {(r.g, r.c): r["count"] for r in got.collect()}
    assert n["h", "z"] == 70 and sum(x for (g, _), x in n.items() if g == "g") == 50_000 and not any(g == "i" for g, _ in n)
    for c, w in (("a", 1), ("b", 30), ("c", 969)):
        p = w / 1000
        assert abs(n["g", c] - 50_000 * p) < 5 * math.sqrt(50_000 * p * (1 - p))
    plan = sampling.draw_aliased(units, F.col("m"), ["g", "k"], table, ["g"], 5, "test")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode(sequence(1, _size") < plan.index("BroadcastHashJoin")  # units are never joined


def test_drawn_patients_are_counted_by_pattern(spark):
    """Daily sums are those of every patient, of whom nothing is added up but how many drew a pattern."""
    cells = [("s", g, b, "0-9", day("2024-01-05"), 1.0, n) for g in ("ward", "ED") for b in (1, 2) for n in (0, 25_000)] + [("s", "ICU", 1, "80+", day("2024-01-09"), 1.0, 7)]
    expected = spark.createDataFrame(cells, "scenario_label string, group string, bootstrap int, age_group string, date_onset date, expected double, n long")
    masks = [("ward", "0-9", m, n) for m, n in ((0, 3), (0b111, 50), (0b100000000000001, 2), (0b110, 9))] + [("ED", "0-9", 1 << 14, 4), ("ED", "0-9", 0, 1), ("ICU", "80+", 0b1011, 1)]
    patterns = spark.createDataFrame(masks, "group string, age_group string, mask long, n long")
    cfg = StudyConfig()
    got = fc.daily_samples(expected, patterns, cfg)
    drawn = fc.drawn_patients(expected, patterns, cfg)
    days = drawn.select("*", F.explode(fc.mask_days(F.col("mask"))).alias("d"), F.array_min(fc.mask_days(F.col("mask"))).alias("first"))
    want = days.groupBy("scenario_label", "group", "bootstrap", "age_group", F.date_add("date_onset", "d").alias("date")).agg(
        F.count(F.lit(1)).alias("occupied"), F.sum((F.col("d") == F.col("first")).cast("bigint")).alias("admitted")
    )
    assert collected(got) == collected(want) and got.count() > 10
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    counts = next(line for line in plan.splitlines() if "_alike" in line and "Aggregate" in line and "count(1)" in line)
    assert "sum(" not in counts and "mask" in counts


def test_short_sequences_are_those_of_long_ones(spark):
    df = spark.range(1, 10_001).withColumns(sequence_seeds(key_text(3, "t", F.col("id") % 50)))
    df = df.select(sequence_uniform("id").alias("u"), sequence_uniform("id", 10_001).alias("v"), sequence_uniform("id", 1 << 20).alias("w"))
    assert df.where("u = v and u = w").count() == 10_000

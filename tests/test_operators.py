import math
import random

import pytest
from conftest import collected, day
from pyspark.sql import functions as F

from surgecast.functions import hashed_uniform
from surgecast.operators import reshape, sampling, series
from surgecast.operators.quantiles import central_intervals, median_band
from surgecast.operators.staging import lookup, stage, work_width


def numbered(spark, values, key="a"):
    rows = [(key, day("2023-01-01").replace(day=i + 1), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, date date, x double")


def column(df, name="x"):
    return [r[name] for r in df.orderBy("k", "date").collect()]


def test_expand_counts(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 3), ("d", None), ("e", -1)], "k string, n long")
    count = lambda d: collected(d.groupBy("k").count())
    assert count(reshape.expand_counts(df, "n")) == [("a", 2), ("b", 1), ("c", 3), ("e", 3)]
    assert count(reshape.expand_counts(df, "n", corrected=True)) == [("b", 1), ("c", 3)]


def test_chunks_split_a_hot_row(spark):
    df = spark.createDataFrame([("hot", 400_000), ("small", 5), ("none", 0)], "k string, n long")
    chunks = reshape.chunk_rows(df, F.col("n"), ["k"])
    sizes = [r["count"] for r in chunks.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 20
    units = reshape.number_chunks(chunks, "i")
    assert collected(units.groupBy("k").agg(F.count("*"), F.countDistinct("_chunk", "i"))) == [
        ("hot", 400_000, 400_000), ("small", 5, 5),
    ]


def test_work_width_follows_the_work(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [work_width(spark, n) for n in (0, 60_000, 10**6, 10**9, 10**13)] == [1, 2, cores, 1000, 10**7]


def test_stay_days_drops_reversed_and_open(spark):
    rows = [(1, "2023-01-01", "2023-01-03"), (2, "2023-01-02", "2023-01-01"), (3, "2023-01-02", None)]
    df = spark.createDataFrame([(i, day(a), day(b)) for i, a, b in rows], "id int, a date, b date")
    assert collected(reshape.stay_days(df, F.col("a"), F.col("b")), "id", "date") == [
        (1, day(f"2023-01-0{d}")) for d in (1, 2, 3)
    ]


def test_complete_daily(spark):
    rows = [("a", "2023-01-01", 1), ("b", "2023-01-03", None)]
    df = spark.createDataFrame([(k, day(d), n) for k, d, n in rows], "k string, date date, n long")
    got = collected(reshape.complete_daily(df, "date", ["k"], {"n": 0}))
    assert len(got) == 6 and sum(r[2] for r in got) == 1
    # rows outside given bounds are kept, existing NULLs stay without a fill
    bounded = reshape.complete_daily(df, "date", ["k"], start=F.lit(day("2023-01-01")), end=F.lit(day("2023-01-02")))
    assert collected(bounded, "k", "date") == [
        ("a", day("2023-01-01")), ("a", day("2023-01-02")), ("b", day("2023-01-01")), ("b", day("2023-01-02")), ("b", day("2023-01-03")),
    ]
    assert bounded.where("n is null").count() == 4


def test_fill_daily_gaps(spark):
    df = numbered(spark, [1.0, None, None, 4.0]).where("date in ('2023-01-01', '2023-01-04')")
    assert column(reshape.fill_daily_gaps(df, "date", ["x"], ["k"])) == [1.0, 0.0, 0.0, 4.0]
    assert column(reshape.fill_daily_gaps(df, "date", ["x"], ["k"], fill=None)) == [1.0, None, None, 4.0]
    assert column(reshape.fill_daily_gaps(df, "date", ["x"], drop_last=True)) == [1.0, 0.0, 0.0]


@pytest.mark.parametrize("n", [6, 7, 8, 13])
def test_rolling_extend(spark, n):
    values = [float(i * i) for i in range(n)]
    got = column(series.rolling_extend(numbered(spark, values), {"s": "x"}, 7, "sum", ["k"], "date"), "s")
    if n < 7:
        assert got == [None] * n
    else:
        full = [sum(values[i - 3 : i + 4]) for i in range(3, n - 3)]
        assert got == [full[0]] * 3 + full + [full[-1]] * 3


def test_rolling_mean_full(spark):
    df = numbered(spark, [float(i) for i in range(8)])
    got = column(df.withColumn("m", series.rolling_mean_full("x", 7, ["k"], "date")), "m")
    assert got == [None, None, None, 3.0, 4.0, None, None, None]


def test_fill_downup(spark):
    got = column(series.fill_downup(numbered(spark, [None, 1.0, None, 2.0, None]), ["x"], ["k"], "date"))
    assert got == [1.0, 1.0, 1.0, 2.0, 2.0]


@pytest.mark.parametrize(
    ("values", "inner", "extended"),
    [
        ([None, 1.0, None, None, 4.0, None], [None, 1.0, 2.0, 3.0, 4.0, None], [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]),
        ([None, 5.0, None], [None, 5.0, None], [5.0, 5.0, 5.0]),
        ([None, None], [None, None], [None, None]),
    ],
)
def test_interpolate(spark, values, inner, extended):
    df = numbered(spark, values)
    assert column(series.interpolate(df, ["x"], ["k"], "date")) == pytest.approx(inner)
    assert column(series.interpolate(df, ["x"], ["k"], "date", extend_ends=True)) == pytest.approx(extended)


def test_interpolate_by_row_or_by_day(spark):
    df = numbered(spark, [0.0, None, 9.0, 9.0, 4.0]).where("date not in ('2023-01-03', '2023-01-04')")
    assert column(series.interpolate(df, ["x"], ["k"], "date")) == pytest.approx([0, 2, 4])
    assert column(series.interpolate(df, ["x"], ["k"], "date", by_date=True)) == pytest.approx([0, 1, 4])


def test_first_per_group_limits_before_the_shuffle(spark):
    rows = [(1, "b", 1), (1, "a", 2), (2, None, 3), (2, "c", 4), (1, "a", 1)]
    df = spark.createDataFrame(rows, "p int, d string, row_id int")
    first = series.first_per_group(df, ["p"], [F.col("d").asc_nulls_last(), F.col("row_id")])
    assert collected(first) == [(1, "a", 1), (2, "c", 4)]
    plan = first._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def type7(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low = math.floor(at)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)


@pytest.mark.parametrize("n", [1, 2, 50])
def test_central_intervals(spark, n):
    rng = random.Random(n)
    values = [rng.random() for _ in range(n)]
    df = spark.createDataFrame([("a", v) for v in [*values, None]], "k string, x double")
    got = {r.quant: r for r in central_intervals(df, ["k"], "x", (50, 90), median=True).collect()}
    for level in (50, 90):
        assert got[level].lower == pytest.approx(type7(values, (100 - level) / 200))
        assert got[level].upper == pytest.approx(type7(values, (100 + level) / 200))
        assert got[level].median == pytest.approx(type7(values, 0.5))
    assert got[90].lower <= got[50].lower <= got[50].upper <= got[90].upper
    strict = central_intervals(df, ["k"], "x", (50,), ignore_nulls=False).collect()
    assert strict[0].lower is None


def test_central_intervals_frequency(spark):
    df = spark.createDataFrame([("a", 5.0, 1), ("a", 0.0, 3)], "k string, x double, n long")
    (row,) = central_intervals(df, ["k"], "x", (90,), frequency="n").collect()
    assert row.upper == pytest.approx(type7([5, 0, 0, 0], 0.95))


def test_median_band_null_rules(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0)], "k string, x double")
    row = lambda **kw: tuple(median_band(df, ["k"], "x", **kw).first())[1:]
    assert row() == (None, pytest.approx(1.1), pytest.approx(2.9))
    assert row(null_band=True) == (None, None, None)
    assert row(lenient=True)[0] == 2.0


@pytest.mark.parametrize(
    ("x", "u", "ward", "other"),
    [
        (0.0, 0.5, 0, 0), (0.3, 0.29, 1, 1), (0.3, 0.31, 0, 0), (1.0, 0.5, 0, 2), (1.2, 0.1, 2, 2),
        (1.2, 0.3, 1, 2), (2.5, 0.4, 3, 3), (2.5, 0.6, 2, 3), (3.0, 0.5, 2, 4), (2.0, 0.5, 2, 2),
    ],
)
def test_randomised_round(spark, x, u, ward, other):
    def rounded(by_fraction):
        return spark.range(1).select(sampling.randomised_round(F.lit(x), F.lit(u), by_fraction=by_fraction)).first()[0]

    assert (rounded(True), rounded(False)) == (ward, other)


def test_corrected_rounding_is_unbiased(spark):
    df = spark.range(40_000).select(hashed_uniform(1, "t", F.col("id")).alias("u"))
    n = sampling.randomised_round(F.lit(2.3), F.col("u"), by_fraction=True, corrected=True)
    assert df.select(F.avg(n)).first()[0] == pytest.approx(2.3, abs=0.01)


CELLS = [("s", "a", 700), ("s", "b", 1), ("s", "c", 299), ("t", "a", 20_000), ("t", "b", 0)]


@pytest.mark.parametrize("method", [sampling.bootstrap_counts, sampling.multinomial_counts])
def test_resamples_keep_totals_and_match_weights(spark, method):
    cells = spark.createDataFrame(CELLS, "stream string, cell string, n long")
    got = method(cells, ["stream"], ["cell"], "n", 40, 7).cache()
    totals = {tuple(r)[0]: tuple(r)[1:] for r in got.groupBy("stream", "bootstrap").agg(F.sum("n").alias("n"))
              .groupBy("stream").agg(F.min("n"), F.max("n"), F.count("*")).collect()}
    assert totals == {"s": (1000, 1000, 40), "t": (20_000, 20_000, 40)}
    drawn = {(r.stream, r.cell): (r.m, r.v) for r in got.groupBy("stream", "cell").agg(F.avg("n").alias("m"), F.stddev("n").alias("v")).collect()}
    assert drawn["s", "a"][0] == pytest.approx(700, abs=10)
    assert drawn["s", "a"][1] == pytest.approx(math.sqrt(1000 * 0.7 * 0.3), rel=0.4)
    assert ("t", "b") not in drawn


def test_draws_match_brute_force_lookup(spark):
    weights = [3, 1, 50, 7, 2000, 1]
    cells = spark.createDataFrame([("g", i, w) for i, w in enumerate(weights)], "g string, c int, n long")
    total = sum(weights)
    units = spark.range(5000).select(
        F.lit("g").alias("g"), F.lit(total).cast("long").alias("_total"), F.lit(1).cast("long").alias("_stratum"),
        ((F.col("id") + 0.5) / 5000).alias("u"),
    )
    got = sampling.draw_cells(units, sampling.weighted_index(cells, ["g"], ["c"], "n"), F.col("u")).collect()
    assert len(got) == 5000
    owner = [i for i, w in enumerate(weights) for _ in range(w)]
    assert all(r.c == owner[math.floor(r.u * total)] for r in got)


def test_draws_do_not_depend_on_partitioning(spark):
    cells = spark.createDataFrame(CELLS, "stream string, cell string, n long")

    def run():
        return collected(sampling.bootstrap_counts(cells, ["stream"], ["cell"], "n", 5, 7))

    width = spark.conf.get("spark.sql.shuffle.partitions")
    first = run()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert run() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_no_row_holds_more_numbers_than_a_block_and_none_start_in_one_task(spark):
    runs = sampling.strata(spark.createDataFrame([("a", 10**9), ("b", 5)], "g string, n long"), ["g"], "n")
    chunks = reshape.chunk_rows(runs, F.col("_total"), ["g"])
    assert chunks.groupBy("g").agg(F.count("*"), F.sum("_size")).orderBy("g").collect() == [("a", 10**5, 10**9), ("b", 1, 5)]
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Generate") < plan.index("REPARTITION_BY_COL") < plan.index("SinglePartition")
    assert f"{reshape.CHUNKS_PER_BLOCK}" in plan


def test_lookup_is_broadcast_only_up_to_its_bound(spark, monkeypatch):
    big, small = spark.range(100).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in big.join(lookup(small), "k")._jdf.queryExecution().toString()
        monkeypatch.setattr("surgecast.operators.staging.MOST_BROADCAST_ROWS", 5)
        assert "BroadcastHashJoin" not in big.join(lookup(small), "k")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("share", [0.01, 0.1, 0.5])
def test_chunk_sequences_draw_like_one_hash_per_unit(spark, share):
    """Mean, variance and both tails of a cell's count over 1000 replicates, against draws hashed one by one."""
    from surgecast.functions.hashing import key_text, sequence_seeds, sequence_uniform

    n, replicates = 2000, 1000
    runs = spark.range(replicates).select("id")
    chunked = runs.withColumns(sequence_seeds(key_text(5, "quality", F.col("id")))).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(n))))
    single = runs.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(n))))

    def counts(df, u):
        hits = df.groupBy("id").agg(F.sum((u <= share).cast("int")).alias("x"))
        return hits.agg(F.avg("x"), F.variance("x"), F.percentile("x", 0.05), F.percentile("x", 0.95)).first()

    a, b = counts(chunked, sequence_uniform("i")), counts(single, hashed_uniform(5, "quality", F.col("id"), F.col("i")))
    mean, sd = n * share, math.sqrt(n * share * (1 - share))
    for got in (a, b):
        assert got[0] == pytest.approx(mean, abs=5 * sd / math.sqrt(replicates))
        assert got[1] == pytest.approx(sd * sd, rel=0.25)
        assert got[2] == pytest.approx(mean - 1.645 * sd, abs=0.3 * sd + 1)
        assert got[3] == pytest.approx(mean + 1.645 * sd, abs=0.3 * sd + 1)


def test_stage_writes_to_the_checkpoint_folder_and_nowhere_else_without_one(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    assert before.startswith(f"file:{spark.conf.get('spark.checkpoint.dir')}") or spark.conf.get("spark.checkpoint.dir") in before
    assert stage(spark.range(5)).count() == 5
    code = (
        "import sys; sys.path.insert(0, {root!r})\n"
        "from checks.session import local_session\nfrom checks.spark_queries import QUERIES\n"
        "spark = local_session('2', **{{'spark.local.dir': {local!r}, 'spark.sql.warehouse.dir': {house!r}}})\n"
        "assert QUERIES['rate_numerators'](spark, '/root/testdata/sf0.001').count() > 0\n"
        "assert spark.sparkContext.getCheckpointDir() is None\n"
    )
    import os
    import subprocess
    import sys

    folders = {k: str(tmp_path / k) for k in ("local", "house", "tmp", "conf")}
    for f in folders.values():
        os.mkdir(f)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"TMPDIR": folders["tmp"], "SPARK_CONF_DIR": folders["conf"]}  # no defaults: no checkpoint folder
    subprocess.run([sys.executable, "-c", code.format(root=root, local=folders["local"], house=folders["house"])], check=True, env=env, timeout=300)
    written = [f for k in ("tmp", "house") for _, _, names in os.walk(folders[k]) for f in names if f.startswith("part-")]
    assert written == []

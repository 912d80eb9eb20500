"""One query per operator over the stand-in inputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from surgecast import StudyConfig
from surgecast.functions import age_band
from surgecast.operators.long_series import LongSeries, fill_downup_long, interpolate_long, long_series, rolling_extend_long, rolling_mean_full_long
from surgecast.operators.quantiles import central_intervals
from surgecast.operators.reshape import complete_daily, stay_days
from surgecast.operators.sampling import bootstrap_counts
from surgecast.operators.selection import exact_quantiles
from surgecast.operators.series import fill_downup, first_per_group, interpolate, rolling_extend
from surgecast.operators.staging import shared_folder, stage
from surgecast.plans import forecast as fc
from surgecast.plans import occupancy, rates, study, summaries
from surgecast.plans.trajectory import make_case_trajectory
from surgecast.sources import linelists, persons, readers
from surgecast.sources.results import broken_tables

Query = Callable[[SparkSession, str], DataFrame]
CFG = v.EV_CONFIG
# Tables of a stored study that are read back, and what is summed of each.
STORED = {
    "case_counts": "n",
    "hospital_linelist": "datediff(date_discharge, date_admit)",
    "ED_linelist": "datediff(date_presentation, date_onset)",
    "ascertainment": "asc",
    "case_forecast": "count",
    "forecast_dates": "datediff(date_hospital_linelist, date_estimates_start)",
    "time_varying_estimates": "pr_hosp + pr_ED",
    "case_trajectory": "count",
    "outputs": "count + 1000 * admissions",
}
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return keep


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 9) for c in columns})


def _dates(spark: SparkSession, sf: str, cfg: StudyConfig = CFG):
    return linelists.resolve_forecast_dates(v.cases(spark, sf, cfg), v.EV_HOSPITAL_PATH, v.EV_FORECAST_DATE, cfg)


# --- sources and cleaning ---------------------------------------------------------------------


def _case_file(spark: SparkSession, sf: str) -> str:
    """A file whose columns are in reverse order and whose dates use slashes in every second row."""
    day = F.col("ts").cast("date")
    text = F.when(F.col("event_id") % 2 == 0, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "yyyy/M/d"))
    bad_age = F.when(F.col("event_id") % 13 == 0, "unknown").otherwise((F.col("user_id") % 100).cast("string"))
    bad_day = F.when(F.col("event_id") % 17 == 0, "31/31/2024").otherwise(text)
    fields = [
        F.col("event_id").cast("string"), F.lit("Confirmed"), text, bad_day, text, bad_age, F.lit("F"),
        F.lit("Local"), F.col("event_type"), F.lit("NA"), F.lit("cough, fever"), F.lit("NA"),
        F.lit("Home"), F.lit("NA"), F.lit("No"), F.lit("Yes"), text, F.lit("NA"), F.lit("BA.5"), F.lit("PCR"),
    ]
    named = [f.alias(n) for f, n in zip(fields, readers.CASE_LINELIST_COLUMNS, strict=True)]
    path = _scratch(spark, "cases")
    v.table(spark, sf, "events").select(*reversed(named)).write.csv(path, header=True)
    return path


@query("read_case_linelist")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_case_linelist(spark, _case_file(spark, sf))


@query("reject_counts")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Unreadable cells, counted by the job that stores the line list."""
    rejects = Observation()
    readers.read_case_linelist(spark, _case_file(spark, sf), rejects).write.parquet(_scratch(spark, "stored"))
    return readers.observed_rejects(spark, {"cases": rejects})


def _export(df: DataFrame, name: str) -> str:
    """A sheet exported as text, its columns in another order and with one more."""
    path = _scratch(df.sparkSession, name)
    shuffled = sorted(df.columns, key=lambda c: c[::-1])
    texts = [F.col(c).cast("timestamp_ntz") if kind == "date" else F.col(c) for c, kind in df.select(*shuffled).dtypes]
    df.select(F.lit("x").alias("remark"), *(t.alias(c) for t, c in zip(texts, shuffled, strict=True))).write.csv(path, header=True)
    return path


@query("read_hospital_export")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_stays(spark, _export(v.view(spark, sf, "big_hospital"), "episodes"))


@query("read_ed_export")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_presentations(spark, _export(v.view(spark, sf, "ev_ed").drop("row_id"), "presentations"))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/surgecast/{name}-{uuid.uuid4().hex}"


def _wide_cases(spark: SparkSession, sf: str) -> DataFrame:
    bands = [f"[{low}, {low + 10})" for low in range(0, 80, 10)] + ["[80, 150)"]
    low = F.floor(F.col("AGE_AT_EVENT_YEARS") / 10) * 10
    band = F.when(low >= 80, bands[-1]).otherwise(
        F.concat(F.lit("["), low.cast("string"), F.lit(", "), (low + 10).cast("string"), F.lit(")"))
    )
    wide = (
        v.view(spark, sf, "ev_cases")
        .withColumn("band", band)
        .groupBy(F.date_format("CALCULATED_ONSET_DATE", "d/M/yyyy").alias("day_specimen_date"))
        .pivot("band", bands)
        .count()
        .fillna(0)
    )
    # counts as files write them: 3, 3.0 and 1,234
    day = F.dayofmonth(F.to_date("day_specimen_date", "d/M/yyyy")) % 3
    return wide.select(
        "day_specimen_date",
        *(
            F.when(day == 0, F.col(f"`{b}`").cast("string"))
            .when(day == 1, F.concat(F.col(f"`{b}`").cast("string"), F.lit(".0")))
            .otherwise(F.format_number(F.col(f"`{b}`"), 0))
            .alias(b)
            for b in bands
        ),
    )


@query("age_band_counts_to_linelist")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return readers.case_bands_to_linelist(_wide_cases(spark, sf))


@query("case_band_counts")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return readers.case_bands_to_counts(_wide_cases(spark, sf))


@query("ascertainment")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return v.ascertainment(spark, sf)


@query("scenario_forecast_long")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return v.forecast(spark, sf)


@query("age_band")
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.view(spark, sf, "big_hospital")
    return raw.groupBy(age_band(F.col("age")).alias("age_group")).agg(F.count(F.lit(1)).alias("n"))


@query("format_cases")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return v.cases(spark, sf)


@query("format_hospital")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return v.big_stays(spark, sf)


@query("format_hospital_corrected")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return v.stays(spark, sf, v.CORRECTED)


@query("format_ed")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return v.presentations(spark, sf)


@query("forecast_dates")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return linelists.forecast_dates_table(v.cases(spark, sf), v.EV_HOSPITAL_PATH, v.EV_FORECAST_DATE, CFG)


# --- reshaping and series ---------------------------------------------------------------------


@query("stay_days")
def _(spark: SparkSession, sf: str) -> DataFrame:
    days = stay_days(v.big_stays(spark, sf), F.col("date_admit"), F.col("date_discharge"))
    return days.groupBy("date", "age_group").agg(F.count(F.lit(1)).alias("n"))


def _daily_by_age(spark: SparkSession, sf: str) -> DataFrame:
    admitted = v.big_stays(spark, sf).groupBy("age_group", F.col("date_admit").alias("date"))
    return admitted.agg(F.count(F.lit(1)).alias("n"), F.count("date_ICU_admit").alias("n_icu"))


@query("complete_daily_grid")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return complete_daily(stage(_daily_by_age(spark, sf)), "date", ["age_group"], {"n": 0, "n_icu": 0})


@query("rolling_sum_extend")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rolling_extend(_daily_by_age(spark, sf), {"n_7": "n"}, 7, "sum", ["age_group"], "date")


@query("rolling_mean_extend")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        rolling_extend(_daily_by_age(spark, sf), {"n_3": "n"}, 3, "mean", ["age_group"], "date"), "n_3"
    )


def _gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Admissions by age with the days of few ICU admissions blanked, so that gaps are real."""
    known = F.when(F.col("n_icu") > 0, F.col("n").cast("double"))
    return _daily_by_age(spark, sf).select("age_group", "date", known.alias("x"))


@query("fill_downup")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return fill_downup(_gappy(spark, sf), ["x"], ["age_group"], "date")


@query("interpolate_linear")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(interpolate(_gappy(spark, sf), ["x"], ["age_group"], "date"), "x")


@query("interpolate_constant_ends")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(interpolate(_gappy(spark, sf), ["x"], ["age_group"], "date", extend_ends=True), "x")


@query("first_stay_per_person")
def _(spark: SparkSession, sf: str) -> DataFrame:
    df = v.big_stays(spark, sf)
    return first_per_group(df, ["person_id"], linelists.stay_order(df, "date_admit"))


@query("first_stay_from_store")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """From stays stored by person, where persons with more than 30 stays are kept apart."""
    stored = persons.store_by_person(v.big_stays(spark, sf), _scratch(spark, "stays"), 8, most_rows=30)
    return persons.per_person(stored, lambda rows: first_per_group(rows, ["person_id"], linelists.stay_order(rows, "date_admit")))


def _measured(spark: SparkSession, sf: str) -> LongSeries:
    """All events as one series in order of time, the values of errors blank."""
    value = F.when(F.col("event_type") != "error", F.col("value").cast("double"))
    events = v.table(spark, sf, "events").select("event_id", "ts", value.alias("x"))
    return long_series(events, ["ts", "event_id"], rows_a_block=1000)


@query("long_rolling_sum")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(rolling_extend_long(_measured(spark, sf), {"x_7": "x"}, 7, "sum"), "x_7").drop("x", "ts")


@query("long_rolling_mean")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(rolling_mean_full_long(_measured(spark, sf), {"x_3": "x"}, 3), "x_3").drop("x", "ts")


@query("long_fill_downup")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return fill_downup_long(_measured(spark, sf), ["x"]).drop("ts")


@query("long_interpolate")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(interpolate_long(_measured(spark, sf), ["x"], extend_ends=True), "x").drop("ts")


@query("line_quantiles")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles of single lines' prices: groups are a fifth of all lines."""
    orders = v.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    lines = v.table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return _rounded(exact_quantiles(joined, ["o_orderpriority"], "l_extendedprice", (0.01, 0.25, 0.5, 0.95)), "quantile")


@query("quantile_fan")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Default intervals over 50 members, each the order value of one share of the orders."""
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    ids = ["o_orderpriority", "o_orderstatus"]
    members = v.table(spark, sf, "orders").groupBy(*ids, (F.col("o_orderkey") % 50).alias("member")).agg(total.alias("x"))
    fan = central_intervals(members, ids, "x", median=True)
    return fan.select(*ids, "quant", *[F.round(c, 4).alias(c) for c in ("median", "lower", "upper")])


# --- observed series --------------------------------------------------------------------------


@query("occupancy")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return occupancy.observed_from(occupancy.calculate_occupancy(v.big_stays(spark, sf), v.BIG_CONFIG), v.BIG_CONFIG)


@query("occupancy_aged")
def _(spark: SparkSession, sf: str) -> DataFrame:
    aged = occupancy.calculate_occupancy_aged(v.big_mixed_stays(spark, sf), v.BIG_CONFIG)
    return occupancy.observed_from(aged, v.BIG_CONFIG)


@query("occupancy_long_stays")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """With a cap of 60 days."""
    return occupancy.observed_from(occupancy.calculate_occupancy(v.big_stays(spark, sf), v.LONG_CONFIG), v.LONG_CONFIG)


@query("occupancy_long_stays_aged")
def _(spark: SparkSession, sf: str) -> DataFrame:
    aged = occupancy.calculate_occupancy_aged(v.big_mixed_stays(spark, sf), v.LONG_CONFIG)
    return occupancy.observed_from(aged, v.LONG_CONFIG)


@query("admissions_observed")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.admissions_observed(v.stays(spark, sf), CFG)


@query("admissions_smoothed")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(summaries.admissions_smoothed(v.stays(spark, sf), CFG), "n")


@query("icu_admissions_observed")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.icu_admissions_observed(v.stays(spark, sf), CFG)


@query("ed_observed")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.ed_observed(v.presentations(spark, sf), _dates(spark, sf), CFG)


@query("admissions_observed_aged")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.admissions_observed_aged(v.stays(spark, sf), _dates(spark, sf), CFG)


@query("icu_admissions_observed_aged")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.icu_admissions_observed_aged(v.stays(spark, sf), _dates(spark, sf), CFG)


@query("ed_observed_aged")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.ed_observed_aged(v.presentations(spark, sf), _dates(spark, sf), CFG)


# --- rates ------------------------------------------------------------------------------------


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return stage(
        rates.rate_cells(
            v.cases(spark, sf), v.stays(spark, sf), v.presentations(spark, sf), _dates(spark, sf), CFG
        )
    )


def _rates(spark: SparkSession, sf: str, cfg: StudyConfig = CFG) -> DataFrame:
    return study.staged_rates(v.inputs(spark, sf, cfg), _dates(spark, sf, cfg), cfg)


def _trajectory(spark: SparkSession, sf: str, cfg: StudyConfig = CFG) -> DataFrame:
    return study.staged_trajectory(v.inputs(spark, sf, cfg), _dates(spark, sf, cfg), cfg)


def _odd_trajectory(spark: SparkSession, sf: str) -> DataFrame:
    """With a scenario that ends before the others and one that starts after the last rates."""
    plain = _trajectory(spark, sf)
    one = plain.where("scenario_label = '1-URGENT'")
    short = one.where(F.col("date_onset") <= F.lit(v.ODD_END)).withColumn("scenario_label", F.lit("0-SHORT"))
    late = one.withColumns({"scenario_label": F.lit("6-LATE"), "date_onset": F.date_add("date_onset", 200)})
    return stage(plain.unionByName(short).unionByName(late))


@query("bootstrap_cell_counts")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return bootstrap_counts(_cells(spark, sf), ["stream"], rates.CELL, "n", CFG.n_bootstraps, CFG.seed)


@query("rate_numerators")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rates.rate_numerators(rates.resample_cells(_cells(spark, sf), CFG))


@query("time_varying_estimates")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_rates(spark, sf), *rates.RATES)


for _key, _rate in (("age", "pr_age_given_case"), ("hosp", "pr_hosp"), ("icu", "pr_ICU"), ("ed", "pr_ED")):

    @query(f"rate_summary_{_key}")
    def _(spark: SparkSession, sf: str, rate: str = _rate) -> DataFrame:
        table = rates.summarise_rate(_rates(spark, sf), rate, _dates(spark, sf), CFG)
        return _rounded(table, "median", "lower_90", "upper_90")


@query("case_trajectory")
def _(spark: SparkSession, sf: str) -> DataFrame:
    i = v.inputs(spark, sf)
    trajectory = make_case_trajectory(i.forecast, i.ascertainment, i.cases, _dates(spark, sf), CFG)
    return _rounded(trajectory, "count")


@query("bootstrap_multinomial_cells")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell of replicates that are drawn by splitting."""
    return rates.resample_cells(_cells(spark, sf), replace(CFG, bootstrap_method="multinomial"))


@query("bootstrap_multinomial_totals")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of multinomial replicates, and whether they hold only cells that the data have."""
    cells = _cells(spark, sf)
    drawn = rates.resample_cells(cells, replace(CFG, bootstrap_method="multinomial"))
    known = cells.select("stream", *rates.CELL, F.lit(True).alias("known"))
    seen = drawn.join(known, ["stream", *rates.CELL], "left")
    return seen.groupBy("stream", "bootstrap").agg(F.sum("n").alias("n"), (F.count("known") == F.count(F.lit(1))).alias("supported"))


def _spans(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    estimates = _rates(spark, sf)
    return estimates, rates.horizons(estimates, _odd_trajectory(spark, sf))


@query("extend_rates_corrected")
def _(spark: SparkSession, sf: str) -> DataFrame:
    estimates = _rates(spark, sf, v.CORRECTED)
    spans = rates.horizons(estimates, _trajectory(spark, sf, v.CORRECTED))
    return _rounded(rates.per_scenario(rates.extend_rates(estimates, spans, v.CORRECTED), spans), *rates.RATES)


@query("extend_rates")
def _(spark: SparkSession, sf: str) -> DataFrame:
    estimates, spans = _spans(spark, sf)
    return _rounded(rates.per_scenario(rates.extend_rates(estimates, spans, CFG), spans), *rates.RATES)


@query("extend_ascertainment")
def _(spark: SparkSession, sf: str) -> DataFrame:
    _, spans = _spans(spark, sf)
    return rates.per_scenario(rates.extend_ascertainment(v.ascertainment(spark, sf), spans), spans)


# --- forecast ---------------------------------------------------------------------------------


def _patterns(spark: SparkSession, sf: str) -> DataFrame:
    dates = _dates(spark, sf)
    beds = fc.stay_patterns(v.stays(spark, sf), dates, CFG)
    return beds.unionByName(fc.ed_offsets(v.presentations(spark, sf), dates, CFG))


def _shown(patterns: DataFrame) -> DataFrame:
    """Masks as text, to compare across engines."""
    return patterns.withColumn("days", F.concat_ws(",", fc.mask_days(F.col("mask"), CFG.stay_cap_days))).drop("mask")


def _expected(spark: SparkSession, sf: str) -> DataFrame:
    i = v.inputs(spark, sf)
    return stage(fc.expected_table(_trajectory(spark, sf), _rates(spark, sf), i.ascertainment, CFG))


for _group in ("ward", "ICU", "ED"):

    @query(f"offsets_{_group.lower()}" if _group == "ED" else f"trajectories_{_group.lower()}")
    def _(spark: SparkSession, sf: str, group: str = _group) -> DataFrame:
        return _shown(_patterns(spark, sf).where(F.col("group") == group))

    @query(f"trajectory_weights_{_group.lower()}")
    def _(spark: SparkSession, sf: str, group: str = _group) -> DataFrame:
        weights = fc.pattern_weights(_patterns(spark, sf).where(F.col("group") == group))
        return _rounded(_shown(weights), "p", "p_age").drop("n")

    @query(f"expected_patients_{_group.lower()}")
    def _(spark: SparkSession, sf: str, group: str = _group) -> DataFrame:
        rows = _expected(spark, sf).where(F.col("group") == group)
        return rows.select("scenario_label", "bootstrap", "age_group", "date_onset", "expected", "n")

    @query(f"draw_{_group.lower()}")
    def _(spark: SparkSession, sf: str, group: str = _group) -> DataFrame:
        expected = _expected(spark, sf).where(F.col("group") == group)
        drawn = fc.drawn_patients(expected, stage(_patterns(spark, sf)), CFG)
        counted = drawn.groupBy("bootstrap", "age_group", "mask").agg(F.count(F.lit(1)).alias("n"))
        return _shown(counted)


@query("rejected_cells")
def _(spark: SparkSession, sf: str) -> DataFrame:
    trajectory, estimates = _odd_trajectory(spark, sf), _rates(spark, sf)
    expected = stage(fc.expected_table(trajectory, estimates, v.ascertainment(spark, sf), CFG))
    unrated = rates.scenarios_without_rates(trajectory, rates.horizons(estimates, trajectory))
    return fc.rejected_cells(expected, _patterns(spark, sf), unrated)


def _sampled(spark: SparkSession, sf: str):
    dates = _dates(spark, sf)
    return study.sampled(v.inputs(spark, sf), dates, CFG), dates


@query("sampled_occupancy")
def _(spark: SparkSession, sf: str) -> DataFrame:
    tables, dates = _sampled(spark, sf)
    return fc.sampled_occupancy(tables.samples, tables.trajectory, dates, CFG).select(*fc.KEYS, "occupied")


@query("sampled_admissions")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return fc.sampled_admissions(_sampled(spark, sf)[0].samples)


@query("sampled_ed")
def _(spark: SparkSession, sf: str) -> DataFrame:
    tables, dates = _sampled(spark, sf)
    return fc.sampled_ed(tables.samples, tables.trajectory, dates, CFG).select(*fc.KEYS, "admitted")


def _outputs(spark: SparkSession, sf: str, cfg: StudyConfig = CFG) -> DataFrame:
    return study.forecast_outputs(v.inputs(spark, sf, cfg), cfg)


@query("forecast_outputs_corrected")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _outputs(spark, sf, v.CORRECTED)


@query("fan_admissions_aged_corrected")
def _(spark: SparkSession, sf: str) -> DataFrame:
    fan = summaries.fan_table(stage(_outputs(spark, sf, v.CORRECTED)), "admissions", ["age_group"], v.CORRECTED)
    return _rounded(fan, "lower", "upper")


@query("stored_study")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and a total of tables that a whole study has stored, read back."""
    path = _scratch(spark, "study")
    study.run_study(v.inputs(spark, sf), path, CFG)
    counts = [
        spark.read.parquet(f"{path}/{name}").agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.round(F.sum(F.expr(total).cast("double")), 6).alias("total"))
        for name, total in STORED.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query("replaced_scenario")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The outputs of a stored forecast, one of whose scenarios has been run again with another seed."""
    path, inputs = _scratch(spark, "forecast"), v.inputs(spark, sf)
    study.store_forecast(inputs, path, CFG)
    again = replace(inputs, forecast=inputs.forecast.where(F.col("scenario_label") == v.RERUN_SCENARIO))
    study.rerun_scenarios(again, path, v.RERUN_CONFIG)
    if not broken_tables(spark, path).isEmpty():
        raise ValueError("a stored table is not what the manifest says")
    return spark.read.parquet(f"{path}/outputs")


@query("forecast_outputs")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _outputs(spark, sf)


@query("ensemble_totals")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.ensemble_totals(_outputs(spark, sf), "count")


@query("ensemble_totals_aged")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.ensemble_totals(_outputs(spark, sf), "admissions", ["age_group"])


for _value, _name in (("count", "occupancy"), ("admissions", "admissions")):
    for _by, _suffix in (([], ""), (["age_group"], "_aged")):

        @query(f"fan_{_name}{_suffix}")
        def _(spark: SparkSession, sf: str, value: str = _value, by: list[str] = _by) -> DataFrame:
            return _rounded(summaries.fan_table(stage(_outputs(spark, sf)), value, by, CFG), "lower", "upper")

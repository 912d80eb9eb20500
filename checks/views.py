"""Stand-in inputs derived from the whole test tables.

The SQL runs unchanged in Spark and DuckDB. Rows come out in raw form, so the cleaning operators
have work to do. ``{name}`` stands for a test table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast import StudyConfig
from surgecast.plans.study import Inputs
from surgecast.sources import readers
from surgecast.sources.linelists import data_date_of, format_cases, format_ed, format_hospital

# All events are of January 2024. Every bound lies inside, so that each removes rows: the study starts on
# the 3rd, reports from the 6th and estimates from the 8th; the hospital's data end on the 26th.
EV_CONFIG = StudyConfig(
    study_start=dt.date(2024, 1, 3),
    plot_start=dt.date(2024, 1, 6),
    anchor_date=dt.date(2024, 1, 15),
    lookback_days=18,
    losses="report",  # one age group has ICU patients but no ICU pattern
)
CORRECTED = replace(EV_CONFIG, semantics="corrected")
EV_HOSPITAL_PATH = "data/episodes_2024_01_26.xlsx"
#: Last day of a scenario that ends before the others.
ODD_END = dt.date(2024, 2, 10)
EV_FORECAST_DATE = dt.date(2024, 1, 31)
BIG_CONFIG = StudyConfig(study_start=dt.date(1995, 1, 1), plot_start=dt.date(1995, 1, 1))
LONG_CONFIG = replace(BIG_CONFIG, stay_cap_days=60)
#: A scenario that is run again, with other draws of patients but the rates of the first run.
RERUN_SCENARIO, RERUN_CONFIG = "3-MEDIUM", replace(EV_CONFIG, seed=7)

VIEWS = {
    "big_hospital": """
SELECT o_custkey AS person_id,
  CASE WHEN o_custkey % 41 = 0 THEN NULL ELSE o_custkey * 7 % 103 - 2 END AS age,
  CAST(l_shipdate AS date) AS ncims_calc_onset_dt,
  CAST(l_shipdate AS date) + CAST(l_linenumber - 3 AS int) AS admit_date,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE
    CAST(l_shipdate AS date) + CAST(l_linenumber - 3 AS int) + CAST(CAST(l_quantity AS int) % 21 - 1 AS int) END AS discharge_date,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS date) + CAST(l_linenumber - 2 AS int) END AS first_icu_date,
  CASE WHEN l_returnflag = 'R' AND l_suppkey % 10 <> 0 THEN
    CAST(l_shipdate AS date) + CAST(l_linenumber - 2 AS int) + CAST(l_suppkey % 7 - 1 AS int) END AS last_icu_date
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # as big_hospital, but a person's age differs between stays
    "big_hospital_mixed": """
SELECT o_custkey AS person_id,
  CASE WHEN o_custkey % 41 = 0 THEN NULL ELSE (o_custkey * 7 + l_partkey) % 103 - 2 END AS age,
  CAST(l_shipdate AS date) AS ncims_calc_onset_dt,
  CAST(l_shipdate AS date) + CAST(l_linenumber - 3 AS int) AS admit_date,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE
    CAST(l_shipdate AS date) + CAST(l_linenumber - 3 AS int) + CAST(CAST(l_quantity AS int) % 21 - 1 AS int) END AS discharge_date,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS date) + CAST(l_linenumber - 2 AS int) END AS first_icu_date,
  CASE WHEN l_returnflag = 'R' AND l_suppkey % 10 <> 0 THEN
    CAST(l_shipdate AS date) + CAST(l_linenumber - 2 AS int) + CAST(l_suppkey % 7 - 1 AS int) END AS last_icu_date
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "ev_cases": """
SELECT CAST(ts AS date) AS CALCULATED_ONSET_DATE,
  CASE WHEN user_id % 31 <> 0 THEN CAST(user_id * 7 % 103 - 2 AS double) END AS AGE_AT_EVENT_YEARS
FROM {events} WHERE event_type IN ('view', 'click', 'signup')""",
    "ev_hospital": """
SELECT event_id AS row_id, CAST(floor(event_id / 3) AS bigint) AS person_id,
  CASE WHEN user_id % 31 <> 0 THEN CAST(user_id * 7 % 103 - 2 AS double) END AS age,
  CAST(ts AS date) AS ncims_calc_onset_dt,
  CAST(ts AS date) + CAST(event_id % 5 - 1 AS int) AS admit_date,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE
    CAST(ts AS date) + CAST(event_id % 5 - 1 AS int) + CAST(CAST(floor(value) AS int) % 20 - 1 AS int) END AS discharge_date,
  CASE WHEN event_id % 4 = 0 AND (user_id * 7 % 103 - 2 >= 10 OR CAST(ts AS date) >= date '2024-01-12')
    THEN CAST(ts AS date) + CAST(event_id % 5 AS int) END AS first_icu_date,
  CASE WHEN event_id % 4 = 0 AND event_id % 11 <> 0 THEN
    CAST(ts AS date) + CAST(event_id % 5 AS int) + CAST(event_id % 6 - 1 AS int) END AS last_icu_date
FROM {events} WHERE event_type = 'purchase'""",
    "ev_ed": """
SELECT event_id AS row_id, CAST(floor(event_id / 3) AS bigint) AS person_id,
  CASE WHEN user_id % 31 <> 0 THEN CAST(user_id * 7 % 103 - 2 AS double) END AS age,
  CAST(ts AS date) AS ncims_calc_onset_dt,
  CASE WHEN event_id % 50 = 0 OR (user_id * 7 % 103 - 2 >= 70 AND CAST(ts AS date) >= date '2024-01-14') THEN NULL ELSE
    CAST(ts AS date) + CAST(event_id % 18 - 2 AS int) END AS presentation_date
FROM {events} WHERE event_type = 'error'""",
    # starts four days after the first case, so the trajectory is cut there
    "ev_ascertainment": """
SELECT date_onset, CAST(20 + day(date_onset) % 10 AS double) / 100 AS asc_rate
FROM (SELECT DISTINCT CAST(ts AS date) + 4 AS date_onset FROM {events}) AS days""",
    # five scenarios over 60 days; every ninth day is missing, the first days overlap the backcast, and
    # the last days of one scenario are blank
    "ev_forecast": """
SELECT o_orderpriority AS scenario_label,
  date '2024-01-20' + CAST(slot + floor(slot / 8) AS int) AS date_onset,
  CASE WHEN o_orderpriority <> '5-LOW' OR slot < 45 THEN CAST(count(*) AS double) * 16.5 END AS n
FROM (SELECT o_orderpriority, o_orderkey % 54 AS slot FROM {orders}) AS slots
GROUP BY o_orderpriority, slot""",
}

FORECAST_SCENARIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    used = [t for t in ("lineitem", "orders", "events") if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


def big_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_hospital(view(spark, sf_dir, "big_hospital"), BIG_CONFIG)


def big_mixed_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_hospital(view(spark, sf_dir, "big_hospital_mixed"), BIG_CONFIG)


def cases(spark: SparkSession, sf_dir: str, cfg: StudyConfig = EV_CONFIG) -> DataFrame:
    return format_cases(view(spark, sf_dir, "ev_cases"), cfg)


def stays(spark: SparkSession, sf_dir: str, cfg: StudyConfig = EV_CONFIG) -> DataFrame:
    return format_hospital(view(spark, sf_dir, "ev_hospital"), cfg, data_date_of(EV_HOSPITAL_PATH))


def presentations(spark: SparkSession, sf_dir: str, cfg: StudyConfig = EV_CONFIG) -> DataFrame:
    return format_ed(view(spark, sf_dir, "ev_ed"), cfg)


def ascertainment(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "ev_ascertainment").select(
        F.date_format("date_onset", "d/M/yyyy").alias("Var1"), F.col("asc_rate").alias("alpha")
    )
    return readers.ascertainment(raw)


def wide_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast as its file has it: text dates and one column per scenario."""
    long = view(spark, sf_dir, "ev_forecast").withColumn("Date", F.date_format("date_onset", "d/M/yyyy"))
    return long.groupBy("Date").pivot("scenario_label", FORECAST_SCENARIOS).agg(F.first("n"))


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.case_forecast_long(wide_forecast(spark, sf_dir), {s: s for s in FORECAST_SCENARIOS})


def inputs(spark: SparkSession, sf_dir: str, cfg: StudyConfig = EV_CONFIG) -> Inputs:
    return Inputs(
        cases=cases(spark, sf_dir, cfg),
        stays=stays(spark, sf_dir, cfg),
        presentations=presentations(spark, sf_dir, cfg),
        ascertainment=ascertainment(spark, sf_dir),
        forecast=forecast(spark, sf_dir),
        hospital_path=EV_HOSPITAL_PATH,
        forecast_date=EV_FORECAST_DATE,
    )

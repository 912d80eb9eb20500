"""Typed readers. Every schema is explicit: nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.config import SCENARIOS
from surgecast.functions import band_from_interval_label, parse_dmy
from surgecast.operators.reshape import expand_counts

# Columns and types of the typed case line-list file, in file order.
CASE_LINELIST_DDL = """
    CASE_ID double, CLASSIFICATION string, EARLIEST_CONFIRMED_OR_PROBABLE date,
    SYMPTOM_ONSET_DATE date, CALCULATED_ONSET_DATE date, AGE_AT_EVENT_YEARS double, GENDER string,
    PLACE_ACQUISITION string, LIKELY_SOURCE_OF_INFECTION string,
    LIKELY_SOURCE_OF_INFECTION_LOCAL string, SYMPTOMS string, DATE_ISOLATION_BEGAN date,
    SETTING_OF_TRANSMISSION_LOCATION string, SETTING_OF_TRANSMISSION_DATE date,
    SETTING_OF_TRANSMISSION_WORK_RELATED string, PATIENT_INTERVIEWED string, INTERVIEWED_DATE date,
    S_gene_result_date date, Omicron_Category string, TEST_TYPE string
"""

HOSPITAL_DDL = """
    person_id string, age double, ncims_calc_onset_dt timestamp_ntz, admit_date timestamp_ntz,
    discharge_date timestamp_ntz, first_icu_date timestamp_ntz, last_icu_date timestamp_ntz
"""

ED_DDL = "person_id string, age double, ncims_calc_onset_dt timestamp_ntz, presentation_date timestamp_ntz"

# An unreadable cell becomes NULL; the rest of its row is kept. Dates are written with either separator.
_CSV_OPTIONS = {"mode": "PERMISSIVE", "dateFormat": "[yyyy-M-d][yyyy/M/d]", "nullValue": "NA"}


CASE_LINELIST_COLUMNS = [field.split()[0] for field in CASE_LINELIST_DDL.split(",")]


def read_case_linelist(spark: SparkSession, path: str, rejects: Observation | None = None) -> DataFrame:
    """The 20-column case line list, by the names in its header.

    ``rejects`` gathers, while the rows are first written or counted, how many cells of each column
    could not be read.
    """
    return _typed(_read_text(spark, path), T.StructType.fromDDL(CASE_LINELIST_DDL), rejects)


def case_linelist_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(column, text, n): cells of the case line list that hold text but no value of the column's type."""
    return _unreadable(_read_text(spark, path), T.StructType.fromDDL(CASE_LINELIST_DDL))


def _read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**_CSV_OPTIONS).csv(path, header=True)


def _value(name: str, kind: T.DataType) -> Column:
    """The text of a column as its type; NULL if it cannot be read."""
    text = F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.coalesce(*(F.try_to_date(F.trim(text), p) for p in ("yyyy-M-d", "yyyy/M/d")))
    return text.try_cast(kind)


def _is_unreadable(field: T.StructField) -> Column:
    return F.col(f"`{field.name}`").isNotNull() & _value(field.name, field.dataType).isNull()


def _typed(raw: DataFrame, schema: T.StructType, rejects: Observation | None = None) -> DataFrame:
    """By header name, so extra or reordered columns do not matter."""
    if rejects is not None:
        counts = [F.count_if(_is_unreadable(f)).alias(f.name) for f in schema if not isinstance(f.dataType, T.StringType)]
        raw = raw.observe(rejects, *counts)
    return raw.select(*(_value(f.name, f.dataType).alias(f.name) for f in schema))


def _unreadable(raw: DataFrame, schema: T.StructType) -> DataFrame:
    cells = [
        F.when(_is_unreadable(f), F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("text")))
        for f in schema
        if not isinstance(f.dataType, T.StringType)
    ]
    bad = raw.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).select("cell.*")
    return bad.groupBy("column", "text").agg(F.count(F.lit(1)).alias("n"))


def parse_case_lines(lines: DataFrame, line: str) -> DataFrame:
    """The same typing applied to CSV text held in a column, as when lines arrive from a table."""
    ddl = " ".join(CASE_LINELIST_DDL.split())
    return lines.select(F.from_csv(F.col(line), ddl, _CSV_OPTIONS).alias("_row")).select("_row.*")


def read_stays(spark: SparkSession, path: str, fmt: str = "csv", rejects: Observation | None = None) -> DataFrame:
    """The hospital episode sheet exported as CSV or Parquet."""
    return _read_export(spark, path, fmt, HOSPITAL_DDL, rejects)


def read_presentations(spark: SparkSession, path: str, fmt: str = "csv", rejects: Observation | None = None) -> DataFrame:
    """The ED sheet exported as CSV or Parquet."""
    return _read_export(spark, path, fmt, ED_DDL, rejects)


def observed_rejects(spark: SparkSession, observed: Mapping[str, Observation]) -> DataFrame:
    """(input, column, n): unreadable cells by column, as gathered in the scan that an input was first used in.

    The driver holds one number a column.
    """
    rows = [(name, column, n) for name, rejects in observed.items() for column, n in rejects.get.items()]
    return spark.createDataFrame(rows, "input string, column string, n long")


def _read_export(spark: SparkSession, path: str, fmt: str, ddl: str, rejects: Observation | None) -> DataFrame:
    schema = T.StructType.fromDDL(ddl)
    if fmt == "csv":
        return _typed(_read_text(spark, path), schema, rejects)
    return spark.read.format(fmt).load(path).select(*schema.names)


def read_case_bands(spark: SparkSession, path: str, *, corrected: bool = False) -> DataFrame:
    """Wide daily case counts by age band, as a case line list."""
    return case_bands_to_linelist(spark.read.options(**_CSV_OPTIONS).csv(path, header=True), corrected=corrected)


def parse_count(text: Column) -> Column:
    """A whole number as a file may write it: 3, 3.0 or 1,234. NULL for anything else."""
    number = F.regexp_replace(F.trim(text.cast("string")), ",", "").try_cast("double")
    return F.when((number == F.floor(number)) & (F.abs(number) < 2**53), number.cast("bigint"))


def _band_cells(wide: DataFrame, corrected: bool) -> DataFrame:
    bands = [c for c in wide.columns if c.startswith("[")]
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in bands]
    long = wide.select("day_specimen_date", *texts).unpivot(
        "day_specimen_date", [f"`{c}`" for c in bands], "band", "text"
    )
    return long.select(
        "day_specimen_date",
        "band",
        "text",
        parse_dmy(F.col("day_specimen_date")).alias("date_onset"),
        band_from_interval_label(F.col("band"), strict=corrected).alias("age_group"),
        parse_count(F.col("text")).alias("count"),
    )


def case_bands_to_linelist(wide: DataFrame, *, corrected: bool = False) -> DataFrame:
    """``day_specimen_date`` plus one ``[lo, hi)`` count column per band -> one row per case."""
    cells = _band_cells(wide, corrected).select("date_onset", "age_group", "count")
    return expand_counts(cells.dropna(subset=["date_onset", "age_group"]), "count", corrected=corrected)


def case_bands_to_counts(wide: DataFrame, *, corrected: bool = False) -> DataFrame:
    """(date_onset, age_group, n): the same cases counted, without a row for each.

    A count of zero stands for two cases, as in :func:`expand_counts`, unless ``corrected``.
    """
    cells = _band_cells(wide, corrected).dropna(subset=["date_onset", "age_group", "count"])
    n = F.when(F.col("count") >= 1, F.col("count"))
    n = n if corrected else n.otherwise(F.lit(2) - F.col("count"))
    return cells.withColumn("n", n).where("n >= 1").groupBy("date_onset", "age_group").agg(F.sum("n").alias("n"))


def case_band_rejects(wide: DataFrame, *, corrected: bool = False) -> DataFrame:
    """(day_specimen_date, band, text, reason): cells whose cases are not counted because they cannot be read."""
    reason = (
        F.when(F.col("date_onset").isNull(), "unreadable date")
        .when(F.col("age_group").isNull(), "unknown band")
        .when(F.col("count").isNull(), "unreadable count")
    )
    cells = _band_cells(wide, corrected).where("text is not null").withColumn("reason", reason)
    return cells.where("reason is not null").select("day_specimen_date", "band", "text", "reason")


def read_ascertainment(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.options(**_CSV_OPTIONS).csv(path, header=True)
    return ascertainment(raw.withColumn("alpha", F.col("alpha").try_cast("double")))


def ascertainment(raw: DataFrame) -> DataFrame:
    """``Var1`` (day-first text) and ``alpha`` -> ``date_onset`` and ``asc``."""
    return raw.select(parse_dmy(F.col("Var1")).alias("date_onset"), F.col("alpha").alias("asc"))


def read_case_forecast(spark: SparkSession, path: str, scenarios: dict[str, str] = SCENARIOS) -> DataFrame:
    return case_forecast_long(spark.read.options(**_CSV_OPTIONS).csv(path, header=True), scenarios)


def case_forecast_long(wide: DataFrame, scenarios: dict[str, str] = SCENARIOS) -> DataFrame:
    """One column per scenario -> one row per scenario and day, so scenarios become a key."""
    columns = [F.col(f"`{name}`").try_cast("double").alias(label) for label, name in scenarios.items()]
    long = wide.select("Date", *columns).unpivot("Date", list(scenarios), "scenario_label", "count")
    date: Column = parse_dmy(F.col("Date"))
    return long.select("scenario_label", date.alias("date_onset"), "count")


def write_results(df: DataFrame, path: str, *partition_by: str) -> None:
    """Keep a result table as Parquet, one directory per partition value."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)

"""DuckDB SQL for every query, written from the definitions rather than from the Spark plans:
line lists are multiplied out, positions numbered row by row, and tables joined step by step."""

from __future__ import annotations

import re

from checks.views import (
    BIG_CONFIG,
    CORRECTED,
    EV_CONFIG,
    EV_FORECAST_DATE,
    EV_HOSPITAL_PATH,
    FORECAST_SCENARIOS,
    LONG_CONFIG,
    ODD_END,
    RERUN_CONFIG,
    RERUN_SCENARIO,
    VIEWS,
)
from surgecast import StudyConfig
from surgecast.functions import AGE_BANDS
from surgecast.sources.linelists import data_date_of
from surgecast.sources.readers import CASE_LINELIST_COLUMNS

CFG = EV_CONFIG
RATES = ["pr_hosp", "pr_ICU", "pr_ED", "pr_age_given_case"]
CTES: dict[str, str] = {
    name: sql.format(lineitem="lineitem", orders="orders", events="events") for name, sql in VIEWS.items()
}


def d(day) -> str:
    return f"DATE '{day}'"


def band(age: str) -> str:
    low = f"CAST(floor({age} / 10) * 10 AS INTEGER)"
    return (
        f"CASE WHEN {age} IS NULL THEN NULL WHEN {age} < 0 THEN 'invalid' WHEN {age} >= 80 THEN '80+' "
        f"ELSE CAST({low} AS VARCHAR) || '-' || CAST({low} + 9 AS VARCHAR) END"
    )


def uniform_of(seed: int, purpose: str, *keys: str) -> str:
    text = ", ".join([f"'{seed}'", f"'{purpose}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"((('0x' || substr(md5(concat_ws('|', {text})), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)"


PRIME = 2147483647


def seeds_of(seed: int, purpose: str, *keys: str) -> str:
    """Columns c0..c7 for the units of one chunk."""
    text = ", ".join([f"'{seed}'", f"'{purpose}'", *[f"CAST({k} AS VARCHAR)" for k in keys], "CAST(chunk AS VARCHAR)"])
    text = f"concat_ws('|', {text})"
    parts = [(text, k) for k in range(4)] + [(f"{text} || '|low'", k) for k in range(4)]
    return ", ".join(
        f"('0x' || substr(md5({t}), {8 * k + 1}, 8))::BIGINT % {PRIME} AS c{i}" for i, (t, k) in enumerate(parts)
    )


def seeded_uniform(i: str) -> str:
    def polynomial(c: int) -> str:
        return f"CAST((c{c + 3} * {i}**3 + c{c + 2} * {i}**2 + c{c + 1} * {i} + c{c}) % {PRIME} AS DOUBLE)"

    high, low = (polynomial(c).replace(f"{i}**3", f"({i} * {i} * {i})").replace(f"{i}**2", f"({i} * {i})") for c in (0, 4))
    return f"(({high} + ({low} + 0.5::DOUBLE) / {PRIME}::DOUBLE) / {PRIME}::DOUBLE)"


def chunks(n: str) -> str:
    """Chunk numbers of n units, and a chunk's units, both to be unnested."""
    return f"unnest(range(0, ({n} - 1) // 10000 + 1)) AS chunk"


def units(n: str) -> str:
    return f"unnest(range(1, least({n} - chunk * 10000, 10000) + 1))"


def days(start: str, end: str) -> str:
    return f"CAST(unnest(generate_series({start}, {end}, INTERVAL 1 DAY)) AS DATE)"


def build(final: str) -> str:
    """``final`` behind the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\b[a-z_0-9]+\b", sql):
            if name in CTES and name not in order and CTES[name] is not sql:
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(final)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order) + "\n" + final


def r9(*columns: str) -> str:
    return ", ".join(f"round({c}, 9) AS {c}" for c in columns)


# --- cleaning -----------------------------------------------------------------------------------


def hospital_sql(view: str, start, row_id: str = "", data_date: str | None = None) -> str:
    discharge, icu_end = "discharge_date", "last_icu_date"
    if data_date:  # corrected: open stays end on the data date
        discharge = f"CASE WHEN admit_date IS NOT NULL THEN coalesce(discharge_date, {data_date}) END"
        icu_end = f"CASE WHEN first_icu_date IS NOT NULL THEN coalesce(last_icu_date, {data_date}) END"
    known = " AND age >= 0" if data_date else ""
    return f"""
SELECT {row_id} person_id, date_onset, age_group, date_admit, date_discharge,
  CASE WHEN icu1 >= icu0 THEN icu0 END AS "date_ICU_admit",
  CASE WHEN icu1 >= icu0 THEN icu1 END AS "date_ICU_discharge"
FROM (
  SELECT {row_id} person_id, ncims_calc_onset_dt AS date_onset, {band("age")} AS age_group,
    CASE WHEN admit_date < ncims_calc_onset_dt THEN ncims_calc_onset_dt ELSE admit_date END AS date_admit,
    {discharge} AS date_discharge,
    CASE WHEN first_icu_date < ncims_calc_onset_dt THEN ncims_calc_onset_dt ELSE first_icu_date END AS icu0,
    {icu_end} AS icu1
  FROM {view} WHERE ncims_calc_onset_dt >= {d(start)}{known}) AS t
WHERE age_group IS NOT NULL AND date_discharge >= date_admit"""


# --- occupancy ------------------------------------------------------------------------------------


def occupancy_sql(stays: str, aged: bool, cap: int = 14) -> str:
    by = "age_group, " if aged else ""

    def person_days(start: str, end: str) -> str:
        return f"""
    SELECT {by}day, count(*) AS n FROM (
      SELECT *, row_number() OVER (PARTITION BY person_id, day ORDER BY date_admit, date_onset, age_group) AS rn
      FROM (SELECT person_id, age_group, date_admit, date_onset,
              {days(f"greatest({start}, date_onset)", "last_day")} AS day
            FROM (SELECT *, least({end}, date_onset + {cap}) AS last_day FROM {stays} WHERE {start} IS NOT NULL)
            WHERE last_day >= greatest({start}, date_onset)))
    WHERE rn = 1 GROUP BY {by}day"""

    keys = "day, age_group" if aged else "day"
    ages = "CROSS JOIN (SELECT DISTINCT age_group FROM occ_h)" if aged else ""
    CTES["occ_h"] = person_days("date_admit", "date_discharge")
    CTES["occ_i"] = person_days('"date_ICU_admit"', '"date_ICU_discharge"')
    sql = build(f"""
SELECT * FROM (
  SELECT {by}day AS date, g AS "group", CAST(CASE g WHEN 'ward' THEN hospital - icu ELSE icu END AS DOUBLE) AS count
  FROM (
    SELECT {by}day, coalesce(h.n, 0) AS hospital, coalesce(CASE WHEN h.n IS NOT NULL THEN i.n END, 0) AS icu
    FROM (SELECT * FROM (SELECT {days("min(day)", "max(day)")} AS day FROM occ_h) {ages}) AS grid
    LEFT JOIN occ_h AS h USING ({keys}) LEFT JOIN occ_i AS i USING ({keys}))
  CROSS JOIN (VALUES ('ward'), ('ICU')) AS groups(g))
WHERE date <= (SELECT max(day) - 1 FROM occ_h) AND date >= {d(BIG_CONFIG.plot_start)}""")
    del CTES["occ_h"], CTES["occ_i"]
    return sql


def rolling(table: str, value: str, out: str, width: int, agg: str, partition: str, order: str, keep: str) -> str:
    half = width // 2
    part = f"PARTITION BY {partition}" if partition else ""
    return f"""
SELECT {keep}, CASE WHEN len < {width} THEN NULL WHEN rn <= {half} THEN max(CASE WHEN rn = {half + 1} THEN w END) OVER ({part})
  WHEN rn > len - {half} THEN max(CASE WHEN rn = len - {half} THEN w END) OVER ({part}) ELSE w END AS {out}
FROM (SELECT *, {agg}({value}) OVER ({part} ORDER BY {order} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING) AS w,
  row_number() OVER ({part} ORDER BY {order}) AS rn, count(*) OVER ({part}) AS len FROM {table})"""


def interpolated(table: str, values: list[str], partition: str, order: str, keep: str, extend: bool, by_date: bool = False) -> str:
    part = f"PARTITION BY {partition}" if partition else ""
    before = f"OVER ({part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = f"OVER ({part} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    position = f"{order} - DATE '2000-01-01'" if by_date else f"row_number() OVER ({part} ORDER BY {order})"
    neighbours, filled = [], []
    for x in values:
        pos = f"CASE WHEN {x} IS NOT NULL THEN pos END"
        neighbours += [
            f"last_value({x} IGNORE NULLS) {before} AS v0_{x}",
            f"last_value({pos} IGNORE NULLS) {before} AS p0_{x}",
            f"first_value({x} IGNORE NULLS) {after} AS v1_{x}",
            f"first_value({pos} IGNORE NULLS) {after} AS p1_{x}",
        ]
        line = f"v0_{x} + (v1_{x} - v0_{x}) * (CAST(pos - p0_{x} AS DOUBLE) / CAST(p1_{x} - p0_{x} AS DOUBLE))"
        ends = f"coalesce(v0_{x}, v1_{x})" if extend else "NULL"
        filled.append(
            f"CASE WHEN {x} IS NOT NULL THEN {x} WHEN v0_{x} IS NOT NULL AND v1_{x} IS NOT NULL THEN {line} ELSE {ends} END AS {x}"
        )
    return f"""
SELECT {keep}, {", ".join(filled)} FROM (SELECT *, {", ".join(neighbours)} FROM (
  SELECT *, {position} AS pos FROM {table}))"""


MATURE = "(SELECT date_hospital_linelist - 14 FROM fc_dates)"
_labels = ", ".join(f"'{s}'" for s in FORECAST_SCENARIOS)
_bands = ", ".join(f"'{a}'" for a in AGE_BANDS)


def stay_rows(group: str, start: str, end: str) -> str:
    return f"""
SELECT '{group}' AS grp, age_group, person_id, list_sort(list(DISTINCT day) FILTER (day BETWEEN 0 AND 14)) AS days
FROM (SELECT age_group, person_id, unnest(range(CAST({start} - date_onset AS BIGINT), CAST({end} - date_onset AS BIGINT) + 1)) AS day
  FROM stays WHERE date_admit < {MATURE} AND {start} IS NOT NULL)
GROUP BY ALL"""


def define(CFG: StudyConfig, odd: bool = False, draw_seed: int | None = None) -> None:
    """The CTEs of a study. ``odd``: the trajectory has a scenario that ends early and one without rates.
    ``draw_seed``: of patients, if another than that of the rates."""
    SEED = CFG.seed
    DRAW_SEED = SEED if draw_seed is None else draw_seed
    data_date = d(data_date_of(EV_HOSPITAL_PATH)) if CFG.corrected else None

    def uniform(purpose: str, *keys: str) -> str:
        return uniform_of(DRAW_SEED, purpose, *keys)

    def seeds(purpose: str, *keys: str) -> str:
        return seeds_of(SEED if purpose == "boot" else DRAW_SEED, purpose, *keys)

    CTES["big_stays"] = hospital_sql("big_hospital", BIG_CONFIG.study_start)
    CTES["big_mixed_stays"] = hospital_sql("big_hospital_mixed", BIG_CONFIG.study_start)
    CTES["stays"] = hospital_sql("ev_hospital", CFG.study_start, "row_id,", data_date)
    known = "AND age_group <> 'invalid'" if CFG.corrected else ""
    CTES["cases"] = f"""
    SELECT * FROM (SELECT CALCULATED_ONSET_DATE AS date_onset, {band("AGE_AT_EVENT_YEARS")} AS age_group FROM ev_cases)
    WHERE date_onset >= {d(CFG.study_start)} AND age_group IS NOT NULL {known}"""
    CTES["presentations"] = f"""
    SELECT * FROM (SELECT row_id, person_id, ncims_calc_onset_dt AS date_onset, {band("age")} AS age_group,
      presentation_date AS date_presentation FROM ev_ed)
    WHERE date_onset >= {d(CFG.study_start)} AND age_group IS NOT NULL {known}"""
    CTES["asc_table"] = "SELECT date_onset, asc_rate AS a FROM ev_ascertainment"
    CTES["fc_dates"] = f"""
    SELECT least(h, c) - {CFG.lookback_days} AS date_estimates_start, h AS date_hospital_linelist,
      c AS date_case_linelist, {d(EV_FORECAST_DATE)} AS date_forecast
    FROM (SELECT strptime(regexp_extract('{EV_HOSPITAL_PATH}', '\\d{{4}}_\\d{{2}}_\\d{{2}}'), '%Y_%m_%d')::DATE AS h,
      max(date_onset) AS c FROM cases)"""

    # --- series helpers -------------------------------------------------------------------------------

    CTES["daily_by_age"] = """
    SELECT age_group, date_admit AS date, count(*) AS n, count("date_ICU_admit") AS n_icu FROM big_stays GROUP BY ALL"""
    CTES["gappy"] = "SELECT age_group, date, CASE WHEN n_icu > 0 THEN CAST(n AS DOUBLE) END AS x FROM daily_by_age"


    # --- rates ----------------------------------------------------------------------------------------

    CTES["first_stays"] = f"""
    SELECT * FROM stays, fc_dates
    WHERE date_onset >= date_estimates_start AND date_onset < date_hospital_linelist - {CFG.lag_days}
    QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY date_admit NULLS LAST, row_id) = 1"""
    CTES["first_visits"] = f"""
    SELECT * FROM presentations, fc_dates
    WHERE date_onset >= date_estimates_start AND date_onset < date_hospital_linelist - {CFG.lag_days}
    QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY date_presentation NULLS LAST, row_id) = 1"""
    CTES["stream_rows"] = f"""
    SELECT *, row_number() OVER (PARTITION BY stream ORDER BY age_group, date_onset, is_icu) - 1 AS pos FROM (
      SELECT 'case' AS stream, age_group, date_onset, 0 AS is_icu FROM cases, fc_dates
      WHERE date_onset >= date_estimates_start AND date_onset < date_case_linelist - {CFG.lag_days}
      UNION ALL SELECT 'hosp', age_group, date_onset, CASE WHEN "date_ICU_admit" IS NOT NULL THEN 1 ELSE 0 END FROM first_stays
      UNION ALL SELECT 'ed', age_group, date_onset, 0 FROM first_visits)"""
    CTES["boot_runs"] = f"""
    SELECT *, {seeds("boot", "stream", "bootstrap")} FROM (SELECT stream, n, bootstrap, {chunks("n")}
      FROM (SELECT stream, count(*) AS n FROM stream_rows GROUP BY stream)
      CROSS JOIN (SELECT CAST(unnest(range(1, {CFG.n_bootstraps + 1})) AS INTEGER) AS bootstrap))"""
    CTES["boot_draws"] = f"""
    SELECT stream, bootstrap, least(CAST(floor({seeded_uniform("i")} * n) AS BIGINT), n - 1) AS pos
    FROM (SELECT *, CAST({units("n")} AS HUGEINT) AS i FROM boot_runs)"""
    CTES["resamples"] = "SELECT stream, bootstrap, age_group, date_onset, is_icu FROM boot_draws JOIN stream_rows USING (stream, pos)"
    CTES["numerators"] = """
    SELECT bootstrap, age_group, date_onset, n_case, coalesce(n_hosp, 0) AS n_hosp, coalesce(n_icu, 0) AS n_icu, coalesce(n_ed, 0) AS n_ed
    FROM (SELECT bootstrap, age_group, date_onset, count(*) AS n_case FROM resamples WHERE stream = 'case' GROUP BY ALL)
    LEFT JOIN (SELECT bootstrap, age_group, date_onset, count(*) AS n_hosp FROM resamples WHERE stream = 'hosp' GROUP BY ALL)
      USING (bootstrap, age_group, date_onset)
    LEFT JOIN (SELECT bootstrap, age_group, date_onset, count(*) AS n_icu FROM resamples WHERE stream = 'hosp' AND is_icu = 1 GROUP BY ALL)
      USING (bootstrap, age_group, date_onset)
    LEFT JOIN (SELECT bootstrap, age_group, date_onset, count(*) AS n_ed FROM resamples WHERE stream = 'ed' GROUP BY ALL)
      USING (bootstrap, age_group, date_onset)"""
    CTES["recent_numerators"] = f"""
    SELECT * FROM numerators
    WHERE date_onset < (SELECT least(date_hospital_linelist, date_case_linelist) - {CFG.lag_days} FROM fc_dates)"""
    CTES["full_numerators"] = f"""
    SELECT bootstrap, age_group, date_onset, coalesce(n_case, 0) AS n_case, coalesce(n_hosp, 0) AS n_hosp,
      coalesce(n_icu, 0) AS n_icu, coalesce(n_ed, 0) AS n_ed
    FROM (SELECT DISTINCT bootstrap FROM recent_numerators) CROSS JOIN (SELECT DISTINCT age_group FROM recent_numerators)
    CROSS JOIN (SELECT {days("min(date_onset)", "max(date_onset)")} AS date_onset FROM recent_numerators)
    LEFT JOIN recent_numerators USING (bootstrap, age_group, date_onset)"""
    _previous = "full_numerators"
    for _c in ("n_case", "n_hosp", "n_icu", "n_ed"):
        CTES[f"rolled_{_c}"] = rolling(
            _previous, _c, f"{_c}_7", 7, "sum", "bootstrap, age_group", "date_onset",
            "* EXCLUDE (w, rn, len)",
        )
        _previous = f"rolled_{_c}"
    CTES["rates"] = f"""
    SELECT bootstrap, age_group, date_onset,
      CASE WHEN n_case_7 <> 0 THEN CAST(n_hosp_7 AS DOUBLE) / CAST(n_case_7 AS DOUBLE) END AS pr_hosp,
      CASE WHEN n_hosp_7 <> 0 THEN CAST(n_icu_7 AS DOUBLE) / CAST(n_hosp_7 AS DOUBLE) WHEN n_hosp_7 = 0 THEN 0.0::DOUBLE END AS "pr_ICU",
      CASE WHEN n_case_7 <> 0 THEN CAST(n_ed_7 AS DOUBLE) / CAST(n_case_7 AS DOUBLE) END AS "pr_ED",
      CASE WHEN total <> 0 THEN CAST(n_case_7 AS DOUBLE) / CAST(total AS DOUBLE) END AS pr_age_given_case
    FROM (SELECT *, sum(n_case_7) OVER (PARTITION BY bootstrap, date_onset) AS total FROM {_previous})"""

    # --- trajectory -----------------------------------------------------------------------------------

    CTES["padded_cases"] = f"""
    SELECT date_onset, coalesce(n, 0) AS n
    FROM (SELECT {days("date_estimates_start", f"date_case_linelist - {CFG.lag_days}")} AS date_onset FROM fc_dates)
    FULL JOIN (SELECT date_onset, count(*) AS n FROM cases
      WHERE date_onset < (SELECT date_case_linelist - {CFG.lag_days} FROM fc_dates) GROUP BY ALL) USING (date_onset)"""
    CTES["smooth_cases"] = rolling("padded_cases", "n", "smooth", 3, "avg", "", "date_onset", "date_onset")
    CTES["backcast"] = f"""
    SELECT date_onset, CASE WHEN row_number() OVER (ORDER BY date_onset DESC) > 2 THEN smooth / a END AS n
    FROM smooth_cases LEFT JOIN asc_table USING (date_onset) WHERE date_onset >= (SELECT min(date_onset) FROM asc_table)"""
    CTES["forecast_rows"] = f"""
    SELECT scenario_label, date_onset, n
    FROM (SELECT DISTINCT date_onset FROM ev_forecast) CROSS JOIN (SELECT unnest([{_labels}]) AS scenario_label)
    LEFT JOIN ev_forecast USING (scenario_label, date_onset)"""
    CTES["unimputed"] = """
    SELECT scenario_label, date_onset, round_even(n, 0) AS n FROM (
      SELECT scenario_label, date_onset, n FROM forecast_rows WHERE date_onset > (SELECT max(date_onset) FROM backcast)
      UNION ALL SELECT scenario_label, date_onset, n FROM backcast CROSS JOIN (SELECT DISTINCT scenario_label FROM ev_forecast))"""
    CTES["imputable"] = f"""
    SELECT scenario_label, date_onset, n
    FROM (SELECT scenario_label, {days("min(date_onset)", "max(date_onset)")} AS date_onset FROM unimputed GROUP BY scenario_label)
    LEFT JOIN unimputed USING (scenario_label, date_onset)"""
    CTES["plain_trajectory"] = interpolated("imputable", ["n"], "scenario_label", "date_onset", "scenario_label, date_onset", False)
    more = f"""
    UNION ALL SELECT '0-SHORT', date_onset, n FROM plain_trajectory WHERE scenario_label = '1-URGENT' AND date_onset <= {d(ODD_END)}
    UNION ALL SELECT '6-LATE', date_onset + 200, n FROM plain_trajectory WHERE scenario_label = '1-URGENT'"""
    CTES["trajectory"] = "SELECT * FROM plain_trajectory" + (more if odd else "")
    CTES["trajectory_range"] = """
    SELECT scenario_label, min(date_onset) AS first_day, max(date_onset) AS last_day FROM trajectory GROUP BY scenario_label"""
    CTES["rates_subset"] = """
    SELECT t.scenario_label, r.* FROM rates AS r JOIN trajectory_range AS t ON date_onset BETWEEN first_day AND last_day"""
    CTES["subset_range"] = """
    SELECT scenario_label, min(date_onset) AS first_rate, max(date_onset) AS last_rate FROM rates_subset GROUP BY scenario_label"""
    _cols = "bootstrap, age_group, pr_hosp, \"pr_ICU\", \"pr_ED\", pr_age_given_case"
    CTES["placed_rates"] = f"""
    SELECT scenario_label, date_onset, {_cols} FROM rates_subset
    UNION ALL SELECT scenario_label, date_onset + {CFG.hold_days}, {_cols} FROM rates_subset JOIN subset_range USING (scenario_label)
      WHERE date_onset = last_rate
    UNION ALL SELECT scenario_label, last_rate + {CFG.anchor_days}, {_cols} FROM rates_subset JOIN subset_range USING (scenario_label)
      WHERE date_onset = {d(CFG.anchor_date)}"""
    CTES["completed_rates"] = f"""
    SELECT scenario_label, date_onset, {_cols}
    FROM (SELECT scenario_label, {days("first_rate", "last_day")} AS date_onset FROM subset_range JOIN trajectory_range USING (scenario_label))
    JOIN (SELECT DISTINCT scenario_label, bootstrap FROM placed_rates) USING (scenario_label)
    JOIN (SELECT DISTINCT scenario_label, age_group FROM placed_rates) USING (scenario_label)
    FULL JOIN placed_rates USING (scenario_label, date_onset, bootstrap, age_group)"""
    CTES["filled_rates"] = interpolated(
        "completed_rates", RATES, "scenario_label, bootstrap, age_group", "date_onset",
        "scenario_label, bootstrap, age_group, date_onset", True, CFG.corrected,
    )
    whole = "true" if CFG.corrected else "count(*) OVER w = count(pr_age_given_case) OVER w"
    CTES["rates_ahead"] = f"""
    SELECT scenario_label, bootstrap, age_group, date_onset, pr_hosp, "pr_ICU", "pr_ED",
      pr_age_given_case / CASE WHEN {whole} THEN nullif(sum(pr_age_given_case) OVER w, 0) END
        AS pr_age_given_case
    FROM filled_rates WINDOW w AS (PARTITION BY scenario_label, bootstrap, date_onset)"""
    CTES["asc_ahead"] = f"""
    SELECT scenario_label, date_onset, coalesce(
      last_value(a IGNORE NULLS) OVER (PARTITION BY scenario_label ORDER BY date_onset ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(a IGNORE NULLS) OVER (PARTITION BY scenario_label ORDER BY date_onset ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS a
    FROM (SELECT scenario_label, {days("first_rate", "last_day")} AS date_onset FROM subset_range JOIN trajectory_range USING (scenario_label))
    LEFT JOIN asc_table USING (date_onset)"""

    # --- simulation -----------------------------------------------------------------------------------



    CTES["pattern_rows"] = f"""
    SELECT grp, age_group, days, CAST(coalesce(list_sum(list_transform(days, lambda x: 1 << x)), 0) AS BIGINT) AS mask FROM (
      {stay_rows("ward", "date_admit", "date_discharge")}
      UNION ALL {stay_rows("ICU", '"date_ICU_admit"', '"date_ICU_discharge"')}
      UNION ALL SELECT DISTINCT 'ED', age_group, person_id, CASE WHEN date_presentation - date_onset BETWEEN 0 AND 14
        THEN [CAST(date_presentation - date_onset AS BIGINT)] END FROM presentations WHERE date_presentation < {MATURE})"""
    # An alias table: what a slot lacks is owed by the heavy pattern whose summed surplus exceeds the deficits before.
    CTES["weighed_patterns"] = """
    SELECT *, row_number() OVER w - 1 AS slot, count(*) OVER (PARTITION BY grp, age_group) AS slots,
      CAST(sum(n) OVER (PARTITION BY grp, age_group) AS BIGINT) AS total
    FROM (SELECT grp, age_group, mask, any_value(days) AS days, count(*) AS n FROM pattern_rows GROUP BY grp, age_group, mask)
    WINDOW w AS (PARTITION BY grp, age_group ORDER BY mask)"""
    CTES["light_patterns"] = """
    SELECT *, sum(total - n * slots) OVER (PARTITION BY grp, age_group ORDER BY slot) AS owed FROM weighed_patterns WHERE n * slots <= total"""
    CTES["heavy_patterns"] = """
    SELECT *, sum(n * slots - total) OVER w AS surplus, lead(slot) OVER w AS further
    FROM weighed_patterns WHERE n * slots > total WINDOW w AS (PARTITION BY grp, age_group ORDER BY slot)"""
    CTES["alias_table"] = """
    SELECT l.grp, l.age_group, l.slot, l.slots, l.total, l.n * l.slots AS own, coalesce(min(h.slot), l.slot) AS alias
    FROM light_patterns l LEFT JOIN heavy_patterns h ON l.grp = h.grp AND l.age_group = h.age_group AND h.surplus > l.owed - (l.total - l.n * l.slots)
    GROUP BY l.grp, l.age_group, l.slot, l.slots, l.total, l.n
    UNION ALL SELECT h.grp, h.age_group, h.slot, h.slots, h.total, h.total + h.surplus - min(l.owed), coalesce(h.further, h.slot)
    FROM heavy_patterns h JOIN light_patterns l ON l.grp = h.grp AND l.age_group = h.age_group AND l.owed >= h.surplus
    GROUP BY h.grp, h.age_group, h.slot, h.slots, h.total, h.surplus, h.further"""
    CTES["pattern_sizes"] = "SELECT grp, age_group, count(*) AS total FROM pattern_rows GROUP BY ALL"
    CTES["expected"] = """
    SELECT scenario_label, grp, bootstrap, age_group, date_onset, round(CASE grp
        WHEN 'ward' THEN n * pr_age_given_case * pr_hosp * a
        WHEN 'ICU' THEN n * pr_age_given_case * pr_hosp * "pr_ICU" * a
        ELSE n * pr_age_given_case * "pr_ED" * a END, 9) AS x
    FROM trajectory JOIN rates_ahead USING (scenario_label, date_onset) JOIN asc_ahead USING (scenario_label, date_onset)
    CROSS JOIN (VALUES ('ward'), ('ICU'), ('ED')) AS g(grp)"""
    _u = uniform("round", "scenario_label", "grp", "bootstrap", "age_group", "date_onset")
    rounded = "CAST(floor(x) AS BIGINT) + CASE WHEN x - floor(x) > u THEN 1 ELSE 0 END"
    if not CFG.corrected:
        rounded = """CAST(CASE WHEN (CASE grp WHEN 'ward' THEN x - floor(x) ELSE x END) >= u
          THEN round_even(x + 0.5, 0) ELSE round_even(x - 0.5, 0) END AS BIGINT)"""
    CTES["realised"] = f"SELECT *, {rounded} AS n FROM (SELECT *, {_u} AS u FROM expected)"
    CTES["patient_chunks"] = f"""
    SELECT *, {seeds("draw", "scenario_label", "grp", "bootstrap", "age_group", "date_onset")} FROM (
      SELECT scenario_label, grp, bootstrap, age_group, date_onset, total, n, {chunks("n")}
      FROM realised JOIN pattern_sizes USING (grp, age_group) WHERE n > 0 AND age_group IN ({_bands}))"""
    CTES["patients"] = f"""
    SELECT scenario_label, grp, bootstrap, age_group, date_onset, days, mask
    FROM (SELECT *, least(CAST(floor({seeded_uniform("i")} * CAST(slots * total AS DOUBLE)) AS BIGINT), slots * total - 1) AS pos
      FROM (SELECT *, CAST({units("n")} AS HUGEINT) AS i FROM patient_chunks) JOIN (SELECT DISTINCT grp, age_group, slots FROM alias_table) USING (grp, age_group))
    JOIN (SELECT grp AS g, age_group AS a, slot, own, alias FROM alias_table) ON g = grp AND a = age_group AND slot = pos // total
    JOIN (SELECT grp AS wg, age_group AS wa, slot AS drawn, days, mask FROM weighed_patterns)
      ON wg = grp AND wa = age_group AND drawn = CASE WHEN pos % total < own THEN slot ELSE alias END"""
    CTES["occupied"] = """
    SELECT scenario_label, grp, bootstrap, age_group, date, count(*) AS n
    FROM (SELECT scenario_label, grp, bootstrap, age_group, date_onset + CAST(unnest(days) AS INTEGER) AS date
      FROM patients WHERE grp <> 'ED') GROUP BY ALL"""
    CTES["admitted"] = """
    SELECT scenario_label, grp, bootstrap, age_group, date_onset + CAST(days[1] AS INTEGER) AS date, count(*) AS n
    FROM patients WHERE len(days) > 0 GROUP BY ALL"""
    _clip = "date >= (SELECT date_estimates_start + 14 FROM fc_dates) AND date <= last_day"
    CTES["beds"] = f"""
    SELECT scenario_label, grp, bootstrap, age_group, date, coalesce(n, 0) AS n
    FROM (SELECT scenario_label, grp, {days("min(date)", "max(date)")} AS date FROM occupied GROUP BY scenario_label, grp)
    JOIN (SELECT DISTINCT scenario_label, grp, bootstrap FROM occupied) USING (scenario_label, grp)
    JOIN (SELECT DISTINCT scenario_label, grp, age_group FROM occupied) USING (scenario_label, grp)
    LEFT JOIN occupied USING (scenario_label, grp, bootstrap, age_group, date)
    JOIN trajectory_range USING (scenario_label) WHERE {_clip}"""
    CTES["ed_rows"] = f"""
    SELECT scenario_label, bootstrap, age_group, date, n FROM admitted JOIN trajectory_range USING (scenario_label)
    WHERE grp = 'ED' AND {_clip}"""
    seen = "scenario_label, date, age_group" + (", bootstrap" if CFG.corrected else "")
    members = "JOIN (SELECT DISTINCT scenario_label, bootstrap FROM ed_rows) USING (scenario_label)" if CFG.corrected else ""
    bootstrap = "bootstrap" if CFG.corrected else "e.bootstrap"
    group = "'ED'" if CFG.corrected else "CASE WHEN e.n IS NOT NULL THEN 'ED' END"
    CTES["outputs"] = f"""
    SELECT scenario_label, bootstrap, date, age_group, grp, coalesce(n, 0) AS count, coalesce(adm, 0) AS admissions FROM (
      SELECT b.*, a.n AS adm FROM beds AS b LEFT JOIN admitted AS a USING (scenario_label, grp, bootstrap, age_group, date)
      UNION ALL BY NAME
      SELECT scenario_label, {bootstrap}, date, age_group, {group} AS grp, 0 AS n, e.n AS adm
      FROM (SELECT scenario_label, {days("min(date)", "max(date)")} AS date FROM beds WHERE grp = 'ward' GROUP BY scenario_label)
      JOIN (SELECT DISTINCT scenario_label, age_group FROM ed_rows) USING (scenario_label) {members}
      FULL JOIN ed_rows AS e USING ({seen}))"""


define(CFG)

# --- queries --------------------------------------------------------------------------------------

ORACLE: dict[str, str] = {}


def _case_lines() -> str:
    day, text = "CAST(ts AS DATE)", "CAST(NULL AS VARCHAR)"
    none = "CAST(NULL AS DATE)"
    values = [
        "CAST(event_id AS DOUBLE)", "'Confirmed'", day, f"CASE WHEN event_id % 17 <> 0 THEN {day} END", day,
        "CASE WHEN event_id % 13 <> 0 THEN CAST(user_id % 100 AS DOUBLE) END", "'F'", "'Local'", "event_type", text,
        "'cough, fever'", none, "'Home'", none, "'No'", "'Yes'", day, none, "'BA.5'", "'PCR'",
    ]
    return "SELECT " + ", ".join(f'{v} AS "{n}"' for v, n in zip(values, CASE_LINELIST_COLUMNS, strict=True)) + " FROM events"


def _counted_units() -> str:
    """Every band on every case day, zeros counting twice."""
    onset = "SELECT DISTINCT CALCULATED_ONSET_DATE AS date_onset FROM ev_cases"
    # negative ages have no column in the file
    return build(f"""
SELECT date_onset, age_group FROM (
  SELECT date_onset, age_group, unnest(range(CASE WHEN n IS NULL THEN 2 ELSE n END)) AS i
  FROM ({onset}) CROSS JOIN (SELECT unnest([{_bands}]) AS age_group)
  LEFT JOIN (SELECT CALCULATED_ONSET_DATE AS date_onset, {band("AGE_AT_EVENT_YEARS")} AS age_group, count(*) AS n
    FROM ev_cases GROUP BY ALL) USING (date_onset, age_group))""")


ORACLE["read_case_linelist"] = _case_lines()
ORACLE["reject_counts"] = "SELECT 'cases' AS input, * FROM (VALUES " + ", ".join(
    f"('{name}', (SELECT count(*) FROM events WHERE {'event_id % 13 = 0' if name == 'AGE_AT_EVENT_YEARS' else 'event_id % 17 = 0' if name == 'SYMPTOM_ONSET_DATE' else 'false'}))"
    for name in (
        "CASE_ID", "EARLIEST_CONFIRMED_OR_PROBABLE", "SYMPTOM_ONSET_DATE", "CALCULATED_ONSET_DATE", "AGE_AT_EVENT_YEARS",
        "DATE_ISOLATION_BEGAN", "SETTING_OF_TRANSMISSION_DATE", "INTERVIEWED_DATE", "S_gene_result_date",
    )
) + ') AS t("column", n)'
_known_person = "CAST(person_id AS VARCHAR) AS person_id, CAST(age AS DOUBLE) AS age, "
ORACLE["read_hospital_export"] = build(f"SELECT {_known_person}" + ", ".join(
    f"CAST({c} AS TIMESTAMP) AS {c}" for c in ("ncims_calc_onset_dt", "admit_date", "discharge_date", "first_icu_date", "last_icu_date")
) + " FROM big_hospital")
ORACLE["read_ed_export"] = build(f"""SELECT {_known_person}
CAST(ncims_calc_onset_dt AS TIMESTAMP) AS ncims_calc_onset_dt, CAST(presentation_date AS TIMESTAMP) AS presentation_date FROM ev_ed""")
ORACLE["age_band_counts_to_linelist"] = _counted_units()
ORACLE["ascertainment"] = build('SELECT date_onset, a AS "asc" FROM asc_table')
ORACLE["scenario_forecast_long"] = build("SELECT scenario_label, date_onset, n AS count FROM forecast_rows")
ORACLE["age_band"] = build(f"SELECT {band('age')} AS age_group, count(*) AS n FROM big_hospital GROUP BY 1")
ORACLE["format_cases"] = build("SELECT * FROM cases")
ORACLE["format_hospital"] = build("SELECT * FROM big_stays")
ORACLE["format_ed"] = build("SELECT * FROM presentations")
ORACLE["forecast_dates"] = build("SELECT * FROM fc_dates")
ORACLE["stay_days"] = build(f"""
SELECT date, age_group, count(*) AS n FROM (
  SELECT age_group, {days("date_admit", "date_discharge")} AS date FROM big_stays) GROUP BY ALL""")
ORACLE["complete_daily_grid"] = build(f"""
SELECT age_group, date, coalesce(n, 0) AS n, coalesce(n_icu, 0) AS n_icu
FROM (SELECT {days("min(date)", "max(date)")} AS date FROM daily_by_age)
CROSS JOIN (SELECT DISTINCT age_group FROM daily_by_age) LEFT JOIN daily_by_age USING (age_group, date)""")
_keep = "age_group, date, n, n_icu"
ORACLE["rolling_sum_extend"] = build(
    f"SELECT {_keep}, CAST(n_7 AS BIGINT) AS n_7 FROM ({rolling('daily_by_age', 'n', 'n_7', 7, 'sum', 'age_group', 'date', _keep)})"
)
ORACLE["rolling_mean_extend"] = build(
    f"SELECT {_keep}, {r9('n_3')} FROM ({rolling('daily_by_age', 'n', 'n_3', 3, 'avg', 'age_group', 'date', _keep)})"
)
ORACLE["fill_downup"] = build("""
SELECT age_group, date, coalesce(
  last_value(x IGNORE NULLS) OVER (PARTITION BY age_group ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(x IGNORE NULLS) OVER (PARTITION BY age_group ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x
FROM gappy""")
for _name, _extend in (("interpolate_linear", False), ("interpolate_constant_ends", True)):
    ORACLE[_name] = build(
        f"SELECT age_group, date, {r9('x')} FROM ({interpolated('gappy', ['x'], 'age_group', 'date', 'age_group, date', _extend)})"
    )
ORACLE["first_stay_per_person"] = build("""
SELECT * FROM big_stays QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY date_admit NULLS LAST, date_onset NULLS LAST,
  age_group NULLS LAST, date_discharge NULLS LAST, "date_ICU_admit" NULLS LAST, "date_ICU_discharge" NULLS LAST) = 1""")
CTES["order_members"] = """
SELECT o_orderpriority, o_orderstatus, o_orderkey % 50 AS member, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS x
FROM orders GROUP BY ALL"""
ORACLE["quantile_fan"] = build(
    " UNION ALL ".join(
        f"""SELECT o_orderpriority, o_orderstatus, {p} AS quant, round(median(x), 4) AS median,
  round(quantile_cont(x, {(100 - p) / 200}), 4) AS lower, round(quantile_cont(x, {(100 + p) / 200}), 4) AS upper
FROM order_members GROUP BY ALL"""
        for p in (20, 30, 40, 50, 60, 70, 80, 90)
    )
)
ORACLE["occupancy"] = occupancy_sql("big_stays", aged=False)
ORACLE["occupancy_aged"] = occupancy_sql("big_mixed_stays", aged=True)
ORACLE["occupancy_long_stays"] = occupancy_sql("big_stays", aged=False, cap=LONG_CONFIG.stay_cap_days)
ORACLE["occupancy_long_stays_aged"] = occupancy_sql("big_mixed_stays", aged=True, cap=LONG_CONFIG.stay_cap_days)
ORACLE["first_stay_from_store"] = ORACLE["first_stay_per_person"]
CTES["measured"] = "SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN value END AS x FROM events"
ORACLE["long_rolling_sum"] = build(f"SELECT event_id, {r9('x_7')} FROM ({rolling('measured', 'x', 'x_7', 7, 'sum', '', 'ts, event_id', 'event_id')})")
ORACLE["long_rolling_mean"] = build("""
SELECT event_id, CASE WHEN count(x) OVER w = 3 THEN round(avg(x) OVER w, 9) END AS x_3
FROM measured WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)""")
ORACLE["long_fill_downup"] = build("""
SELECT event_id, coalesce(
  last_value(x IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(x IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x
FROM measured""")
ORACLE["long_interpolate"] = build(f"SELECT event_id, {r9('x')} FROM ({interpolated('measured', ['x'], '', 'ts, event_id', 'event_id', True)})")
ORACLE["line_quantiles"] = " UNION ALL ".join(
    f"""SELECT o_orderpriority, {p}::DOUBLE AS p, count(*) AS n, round(quantile_cont(l_extendedprice, {p}), 9) AS quantile
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority"""
    for p in (0.01, 0.25, 0.5, 0.95)
)
_listed = f"""(SELECT * FROM stays WHERE date_onset >= {d(CFG.plot_start)}
  QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY row_id) = 1)"""
_earliest = f"""(SELECT * FROM stays WHERE date_onset >= {d(CFG.plot_start)}
  AND date_admit < (SELECT date_hospital_linelist - {CFG.lag_days} FROM fc_dates)
  QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY date_admit, row_id) = 1)"""
_presented = f"""(SELECT * FROM presentations WHERE date_onset >= {d(CFG.plot_start)}
  AND date_presentation < (SELECT date_hospital_linelist - {CFG.lag_days} FROM fc_dates)
  AND date_presentation BETWEEN date_onset AND date_onset + 14
  QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY date_presentation, row_id) = 1)"""


def _counts(rows: str, day: str, by: str = "") -> str:
    return build(f"""
SELECT {by}"{day}", count(*) AS n FROM {rows}
WHERE "{day}" >= {d(CFG.plot_start)} + {CFG.plot_warmup_days} GROUP BY ALL""")


ORACLE["admissions_observed"] = _counts(_listed, "date_admit")
ORACLE["icu_admissions_observed"] = _counts(_listed, "date_ICU_admit")
ORACLE["ed_observed"] = _counts(_presented, "date_presentation")
ORACLE["admissions_observed_aged"] = _counts(_earliest, "date_admit", "age_group, ")
ORACLE["icu_admissions_observed_aged"] = _counts(_earliest, "date_ICU_admit", "age_group, ")
ORACLE["ed_observed_aged"] = _counts(_presented, "date_presentation", "age_group, ")
ORACLE["admissions_smoothed"] = build(f"""
SELECT date_admit, CASE WHEN count(*) OVER w = 7 THEN round(avg(n) OVER w, 9) END AS n FROM (
  SELECT date_admit, count(*) AS n FROM {_listed} WHERE date_admit >= {d(CFG.plot_start)} + {CFG.plot_warmup_days} GROUP BY ALL)
WINDOW w AS (ORDER BY date_admit ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")

_rounded_rates = ", ".join(f'round("{c}", 9) AS "{c}"' for c in RATES)
ORACLE["bootstrap_cell_counts"] = build(
    "SELECT stream, bootstrap, age_group, date_onset, is_icu, count(*) AS n FROM resamples GROUP BY ALL"
)
ORACLE["rate_numerators"] = build(
    'SELECT bootstrap, age_group, date_onset, n_case, n_hosp, n_icu AS "n_ICU", n_ed AS "n_ED" FROM numerators'
)
ORACLE["time_varying_estimates"] = build(f"SELECT bootstrap, age_group, date_onset, {_rounded_rates} FROM rates")
for _key, _rate in (("age", "pr_age_given_case"), ("hosp", "pr_hosp"), ("icu", "pr_ICU"), ("ed", "pr_ED")):
    _known = f'count("{_rate}") = count(*)'
    _band = _known if _key == "age" else "true"
    _where = "" if _key == "age" else "WHERE date_onset >= (SELECT date_estimates_start FROM fc_dates)"
    ORACLE[f"rate_summary_{_key}"] = build(f"""
SELECT date_onset, age_group, CASE WHEN {_known} THEN round(median("{_rate}"), 9) END AS median,
  CASE WHEN {_band} THEN round(quantile_cont("{_rate}", 0.05), 9) END AS lower_90,
  CASE WHEN {_band} THEN round(quantile_cont("{_rate}", 0.95), 9) END AS upper_90
FROM rates {_where} GROUP BY ALL""")
ORACLE["case_trajectory"] = build("SELECT scenario_label, date_onset, round(n, 9) AS count FROM trajectory")
_text = "coalesce(array_to_string(days, ','), '')"
for _group in ("ward", "ICU", "ED"):
    _name = _group.lower()
    ORACLE["offsets_ed" if _group == "ED" else f"trajectories_{_name}"] = build(f"""
SELECT grp AS "group", age_group, {_text} AS days, count(*) AS n FROM pattern_rows WHERE grp = '{_group}' GROUP BY ALL""")
    ORACLE[f"trajectory_weights_{_name}"] = build(f"""
SELECT "group", age_group, days, round(CAST(n AS DOUBLE) / sum(n) OVER (), 9) AS p,
  round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY age_group), 9) AS p_age
FROM (SELECT grp AS "group", age_group, {_text} AS days, count(*) AS n FROM pattern_rows WHERE grp = '{_group}' GROUP BY ALL)""")
    ORACLE[f"expected_patients_{_name}"] = build(f"""
SELECT scenario_label, bootstrap, age_group, date_onset, x AS expected, n FROM realised WHERE grp = '{_group}'""")
    ORACLE[f"draw_{_name}"] = build(f"""
SELECT bootstrap, age_group, {_text} AS days, count(*) AS n FROM patients WHERE grp = '{_group}' GROUP BY ALL""")
_out_keys = 'scenario_label, grp AS "group", bootstrap, age_group, date'
ORACLE["sampled_occupancy"] = build(f"SELECT {_out_keys}, n AS occupied FROM beds")
ORACLE["sampled_admissions"] = build(f"SELECT {_out_keys}, n AS admitted FROM admitted WHERE grp <> 'ED'")
ORACLE["sampled_ed"] = build("SELECT scenario_label, 'ED' AS \"group\", bootstrap, age_group, date, n AS admitted FROM ed_rows")
ORACLE["forecast_outputs"] = build(f"SELECT {_out_keys}, count, admissions FROM outputs")
ORACLE["ensemble_totals"] = build("""
SELECT scenario_label, bootstrap, date, grp AS "group", CAST(sum(count) AS BIGINT) AS count FROM outputs GROUP BY ALL""")
ORACLE["ensemble_totals_aged"] = build("""
SELECT scenario_label, bootstrap, date, grp AS "group", age_group, CAST(sum(admissions) AS BIGINT) AS admissions
FROM outputs GROUP BY ALL""")


def _fan(value: str, by: str, corrected: bool = False) -> str:
    ids = f"scenario_label, date, grp{by}"
    totals = f"SELECT {ids}, bootstrap, sum({value}) AS x FROM outputs GROUP BY ALL"
    if corrected or by and value == "admissions":
        totals = f"""
SELECT {ids}, coalesce(x, 0) AS x FROM (SELECT DISTINCT {ids} FROM outputs) AS i
CROSS JOIN (SELECT DISTINCT bootstrap FROM outputs) AS m
LEFT JOIN (SELECT {", ".join(f"{c} AS k_{c}" for c in ids.split(", "))}, bootstrap AS k_bootstrap, x FROM ({totals})) AS t
ON {" AND ".join(f"i.{c} IS NOT DISTINCT FROM k_{c}" for c in ids.split(", "))} AND m.bootstrap IS NOT DISTINCT FROM k_bootstrap"""
    CTES["member_totals"] = totals
    parts = [
        f"""SELECT {ids.replace("grp", 'grp AS "group"')}, {p} AS quant,
  round(quantile_cont(x, {(100 - p) / 200}), 9) AS lower, round(quantile_cont(x, {(100 + p) / 200}), 9) AS upper
FROM member_totals GROUP BY ALL"""
        for p in (50, 70, 90)
    ]
    sql = build(" UNION ALL ".join(parts))
    del CTES["member_totals"]
    return sql


for _value, _name in (("count", "occupancy"), ("admissions", "admissions")):
    for _by, _suffix in (("", ""), (", age_group", "_aged")):
        ORACLE[f"fan_{_name}{_suffix}"] = _fan(_value, _by)

# --- a trajectory with a scenario that ends early and one without rates ----------------------------

define(CFG, odd=True)
ORACLE["extend_rates"] = build(
    f"SELECT scenario_label, bootstrap, age_group, date_onset, {_rounded_rates} FROM rates_ahead"
)
ORACLE["extend_ascertainment"] = build('SELECT scenario_label, date_onset, a AS "asc" FROM asc_ahead')
ORACLE["rejected_cells"] = build(f"""
SELECT * FROM (SELECT scenario_label, grp AS "group", bootstrap, age_group, date_onset, x AS expected, n,
  CASE WHEN x IS NULL THEN 'no expected count' WHEN age_group NOT IN ({_bands}) THEN 'age outside the model'
    WHEN n > 0 AND total IS NULL THEN 'no pattern for age group' END AS reason
  FROM realised LEFT JOIN pattern_sizes USING (grp, age_group)) WHERE reason IS NOT NULL
UNION ALL SELECT scenario_label, NULL, NULL, NULL, NULL, NULL, NULL, 'no rates for scenario'
FROM trajectory_range ANTI JOIN subset_range USING (scenario_label)""")

# --- corrected semantics --------------------------------------------------------------------------

define(CORRECTED)
ORACLE["format_hospital_corrected"] = build("SELECT * FROM stays")
ORACLE["extend_rates_corrected"] = build(
    f"SELECT scenario_label, bootstrap, age_group, date_onset, {_rounded_rates} FROM rates_ahead"
)
ORACLE["forecast_outputs_corrected"] = build(f"SELECT {_out_keys}, count, admissions FROM outputs")
ORACLE["fan_admissions_aged_corrected"] = _fan("admissions", ", age_group", corrected=True)
define(CFG)

# --- stored and counted ---------------------------------------------------------------------------

ORACLE["case_band_counts"] = f"SELECT date_onset, age_group, count(*) AS n FROM ({ORACLE['age_band_counts_to_linelist']}) GROUP BY ALL"
ORACLE["bootstrap_multinomial_totals"] = build(f"""
SELECT stream, bootstrap, n, true AS supported FROM (SELECT stream, count(*) AS n FROM stream_rows GROUP BY stream)
CROSS JOIN (SELECT CAST(unnest(range(1, {CFG.n_bootstraps + 1})) AS INTEGER) AS bootstrap)""")


def _splits() -> str:
    """Multinomial draws of all cells: a node's count is split between its halves, from 2^16 cells down."""
    levels = 16
    ctes = ["""cells AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY stream ORDER BY age_group, date_onset, is_icu) - 1 AS leaf
  FROM (SELECT stream, age_group, date_onset, is_icu, count(*) AS n FROM stream_rows GROUP BY ALL))""",
        f"""rows{levels} AS (SELECT stream, CAST(sum(n) AS BIGINT) AS n, bootstrap, CAST(0 AS BIGINT) AS node FROM cells
  CROSS JOIN (SELECT CAST(unnest(range(1, {CFG.n_bootstraps + 1})) AS INTEGER) AS bootstrap) GROUP BY stream, bootstrap)"""]  # fmt: skip
    for at in range(levels, 0, -1):
        u, v = (uniform_of(CFG.seed, purpose, "stream", "bootstrap", str(at), "node") for purpose in ("split", "split2"))
        mass = "exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(p) + (n - k) * ln(1 - p))"
        ctes.append(f"""halves{at} AS (
  SELECT stream, leaf >> {at} AS node, CAST(sum(n) AS BIGINT) AS whole, CAST(sum(CASE WHEN (leaf >> {at - 1}) & 1 = 0 THEN n ELSE 0 END) AS BIGINT) AS part
  FROM cells GROUP BY ALL
), asked{at} AS (
  SELECT *, CAST(least(part, whole - part) AS DOUBLE) / CAST(whole AS DOUBLE) AS p, {u} AS u, {v} AS v FROM rows{at} JOIN halves{at} USING (stream, node)
), summed{at} AS (
  SELECT *, CASE WHEN n * p <= 32 AND p > 0 THEN
    list_transform(range(0, CAST(least(n, ceil(n * p + 12 * sqrt(n * p) + 24)) AS BIGINT)), lambda k: {mass}) END AS f,
    sqrt(-2 * ln(u)) * cos(2 * pi() * v) AS z
  FROM asked{at}
), drawn{at} AS MATERIALIZED (
  SELECT *, CASE WHEN p = 0 THEN 0
    WHEN f IS NOT NULL THEN len(list_filter(range(1, len(f) + 1), lambda i: list_sum(f[1:i]) < u))
    ELSE CAST(least(greatest(floor(n * p + sqrt(n * p * (1 - p)) * z + (1 - 2 * p) * (z * z - 1) / 6 + 0.5::DOUBLE), 0), n) AS BIGINT) END AS few
  FROM summed{at}
), rows{at - 1} AS (
  SELECT stream, bootstrap, node * 2 + side AS node, n FROM (
    SELECT stream, bootstrap, node, side, CASE WHEN (2 * part > whole) = (side = 1) THEN few ELSE n - few END AS n
    FROM drawn{at} CROSS JOIN (VALUES (0), (1)) AS s(side)) WHERE n > 0
)""")
    return ", ".join(ctes)


_stream_rows = build("SELECT * FROM stream_rows")
ORACLE["bootstrap_multinomial_cells"] = f"""
WITH stream_rows AS MATERIALIZED ({_stream_rows}), {_splits()}
SELECT stream, bootstrap, age_group, date_onset, is_icu, CAST(rows0.n AS BIGINT) AS n FROM rows0 JOIN cells USING (stream) WHERE node = leaf"""
_kept = {
    "case_counts": ("(SELECT date_onset, age_group, count(*) AS n FROM cases GROUP BY ALL)", "n"),
    "hospital_linelist": ("stays", "date_discharge - date_admit"),
    "ED_linelist": ("presentations", "date_presentation - date_onset"),
    "ascertainment": ("asc_table", "a"),
    "case_forecast": ("forecast_rows", "n"),
    "forecast_dates": ("fc_dates", "date_hospital_linelist - date_estimates_start"),
    "time_varying_estimates": ("rates", 'pr_hosp + "pr_ED"'),
    "case_trajectory": ("trajectory", "n"),
    "outputs": ("outputs", "count + 1000 * admissions"),
}
ORACLE["stored_study"] = build(" UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n, round(sum(CAST({total} AS DOUBLE)), 6) AS total FROM {table}" for name, (table, total) in _kept.items()))
_first = build(f"SELECT {_out_keys}, count, admissions FROM outputs WHERE scenario_label <> '{RERUN_SCENARIO}'")
define(CFG, draw_seed=RERUN_CONFIG.seed)
_again = build(f"SELECT {_out_keys}, count, admissions FROM outputs WHERE scenario_label = '{RERUN_SCENARIO}'")
ORACLE["replaced_scenario"] = f"SELECT * FROM ({_first}) UNION ALL SELECT * FROM ({_again})"
define(CFG)

"""Column expressions with the null rules of the line-list pipeline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The age bands of the model, and the label for negative ages.
AGE_BANDS = ["0-9", "10-19", "20-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80+"]
INVALID_AGE = "invalid"

# Day-first date layouts accepted in text files.
_DMY_PATTERNS = ["d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d MMM yyyy", "d-MMM-yyyy", "d MMMM yyyy", "ddMMyyyy"]
_DMY_SHORT_PATTERNS = ["d/M/yy", "d-M-yy", "d MMM yy", "d-MMM-yy"]


def age_band(age: Column) -> Column:
    """Ten-year band of an age: ``"0-9"`` .. ``"70-79"``, ``"80+"``; ``"invalid"`` below zero."""
    decade = (F.floor(age / 10) * 10).cast("int")
    return (
        F.when(age < 0, INVALID_AGE)
        .when(age >= 80, AGE_BANDS[-1])
        .otherwise(F.concat(decade.cast("string"), F.lit("-"), (decade + 9).cast("string")))
    )


def band_from_interval_label(label: Column, *, strict: bool = False) -> Column:
    """``"[10, 20)"`` -> ``"10-19"``. Any other label is ``"80+"``, or NULL when ``strict``."""
    out = F.when(label.isNull(), F.lit(None).cast("string"))
    for band in AGE_BANDS[:-1]:
        low, high = (int(part) for part in band.split("-"))
        out = out.when(label == f"[{low}, {high + 1})", band)
    if strict:
        return out.when(label.rlike(r"^\[(8\d|9\d|1\d\d), "), AGE_BANDS[-1])
    return out.otherwise(AGE_BANDS[-1])


def parse_dmy(text: Column) -> Column:
    """Day-month-year text to date; unreadable text is NULL. Two-digit years pivot at 68/69."""
    text = F.trim(text)
    full = [F.try_to_date(text, p) for p in _DMY_PATTERNS]
    short = []
    for pattern in _DMY_SHORT_PATTERNS:
        day = F.try_to_date(text, pattern)
        short.append(F.when(F.year(day) > 2068, F.add_months(day, -1200)).otherwise(day))
    return F.coalesce(*full, *short)


def date_from_file_name(path: Column) -> Column:
    """The ``yyyy_MM_dd`` date in a file name, NULL when there is none."""
    stamp = F.nullif(F.regexp_extract(path, r"\d{4}_\d{2}_\d{2}", 0), F.lit(""))
    return F.try_to_date(stamp, "yyyy_MM_dd")


def counted_days(first: str, last: str, onset: str, cap: int) -> Column:
    """Days 0..cap after onset that lie in the interval, as the bits of a 64-bit integer; 0 for none.

    Both ends must be known. The two powers of two keep the expression, and so the compiled code of
    the scans it is part of, small.
    """
    low = f"least(greatest(datediff({first}, {onset}), 0), {cap + 1})"
    high = f"least(datediff({last}, {onset}), {cap}) + 1"
    return F.expr(f"shiftleft(1L, greatest({low}, {high})) - shiftleft(1L, {low})")

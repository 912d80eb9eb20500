"""Run parameters. Everything that varies per row lives in a DataFrame instead."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Names and display names of the scenario columns in the forecast file.
SCENARIOS = {
    "xbb_null": "XBB.1.16 No waning or seasonality",
    "xbb_no_season": "XBB.1.16 Waning no seasonality",
    "xbb_waning_season_10": "XBB.1.16 Waning, 10% Seasonal effect",
    "xbb_waning_season_20": "XBB.1.16 Waning, 20% Seasonal effect",
}


@dataclass(frozen=True)
class StudyConfig:
    """Constants of a study.

    ``semantics="reference"`` reproduces the reference's result tables including their quirks;
    ``"corrected"`` switches to the repaired behaviour described in the README.
    """

    study_start: dt.date = dt.date(2022, 1, 1)
    plot_start: dt.date = dt.date(2022, 12, 1)
    anchor_date: dt.date = dt.date(2023, 5, 15)
    n_bootstraps: int = 50
    seed: int = 20230712
    semantics: str = "reference"
    #: "hashed" draws every case of every replicate by itself; "multinomial" draws a replicate's counts at
    #: once, with the same distribution, at a cost that does not grow with the cases.
    bootstrap_method: str = "hashed"
    #: What a forecast does about patients it has no pattern for and scenarios it has no rates for:
    #: "stop" with an error, or "report" them in ``rejected_cells`` and forecast the rest.
    losses: str = "stop"

    lookback_days: int = 90  # estimation window before the earlier data date
    lag_days: int = 2  # most recent days dropped as incomplete
    stay_cap_days: int = 14  # a stay counts from onset to onset + 14
    rate_window: int = 7
    case_window: int = 3
    admission_window: int = 7
    hold_days: int = 14  # last rates are held this long ...
    anchor_days: int = 60  # ... and drift to the anchor day's rates by then
    plot_warmup_days: int = 5

    def __post_init__(self) -> None:
        if self.semantics not in ("reference", "corrected"):
            raise ValueError(f"unknown semantics {self.semantics!r}")
        if self.bootstrap_method not in ("hashed", "multinomial"):
            raise ValueError(f"unknown bootstrap method {self.bootstrap_method!r}")
        if self.losses not in ("stop", "report"):
            raise ValueError(f"unknown rule for losses {self.losses!r}")
        if not 0 < self.stay_cap_days <= 60:
            raise ValueError("a pattern's days must fit the bits of a 64-bit integer")

    @property
    def corrected(self) -> bool:
        return self.semantics == "corrected"


@dataclass(frozen=True)
class ForecastDates:
    """The four dates every later step is bounded by."""

    estimates_start: dt.date
    hospital_linelist: dt.date
    case_linelist: dt.date
    forecast: dt.date

    @property
    def data_min(self) -> dt.date:
        return min(self.hospital_linelist, self.case_linelist)

"""Experiment definitions.

An experiment is parameters, not data: id, treatment share, eligible
population (a SQL predicate over the user table), and its calendar.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Experiment:
    experiment_id: str
    ratio: float                 # share of eligible users sent to treatment
    population: str = "true"     # SQL predicate over the users table, e.g. "is_host"
    start_date: dt.date = dt.date(2024, 1, 1)   # first day of the treatment period
    end_date: dt.date = dt.date(2024, 12, 31)   # last day (inclusive)
    pre_days: int = 0            # days of pre-period shown before start (rank form of the day index)

    def __post_init__(self):
        if not 0.0 <= self.ratio <= 1.0:
            raise ValueError(f"ratio must be in [0, 1], got {self.ratio}")
        if "|" in self.experiment_id:
            raise ValueError("experiment_id may not contain '|', the hash separator")


# The experiments run on the driver-generated fixtures (FIXTURES.md §3).
# exp1 mirrors the first notebook experiment (hosts, 50/50, ten pre days),
# exp2 the second (everyone, 20 % treatment, one pre day).
FIXTURE_EXPERIMENTS = (
    Experiment("exp1", 0.5, "is_host", dt.date(2024, 1, 11), dt.date(2024, 1, 30), 10),
    Experiment("exp2", 0.2, "true", dt.date(2024, 1, 2), dt.date(2024, 1, 30), 1),
    Experiment("exp_all", 0.5, "true", dt.date(2024, 1, 11), dt.date(2024, 1, 30), 10),
)

DEFAULT_ACTIVITIES = ("view", "click", "save", "comment", "purchase")

"""Run parameters shared by the jobs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunParams:
    """One run of a job. ``as_of`` replaces the wall clock, so that a run can be repeated."""

    as_of: dt.date
    lookback_days: int = 7
    daily_days: int = 1
    page_size: int = 15
    subject_cap: int = 5
    first_year: int = 2024
    digest_grade: str = "Q1"
    base_url: str = "https://digest.example"
    file_prefix: str = "research_update_"
    max_attempts: int = 3

    @property
    def last_year(self) -> int:
        return self.as_of.year

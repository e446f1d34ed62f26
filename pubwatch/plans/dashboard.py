"""The dashboard: one filtered view of the archive and the widgets that read it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from pubwatch.operators import aggregates, rendering
from pubwatch.operators.filters import dashboard_filter


@dataclass(frozen=True)
class Dashboard:
    """Controls that are not set do not filter. Each widget reads only the columns it shows."""

    archive: DataFrame
    subjects: Sequence[str] | None = None
    grades: Sequence[str] | None = None
    start: dt.date | None = None
    end: dt.date | None = None
    journals: Sequence[str] | None = None

    @property
    def view(self) -> DataFrame:
        return dashboard_filter(
            self.archive, self.subjects, self.grades, self.start, self.end, self.journals
        )

    @property
    def article_count(self) -> DataFrame:
        return aggregates.count_rows(self.view)

    @property
    def distribution(self) -> DataFrame:
        return aggregates.subject_distribution(self.view)

    def volume(self, period: str = "month") -> DataFrame:
        return aggregates.volume_by(self.view, period)

    def table(self, limit: int | None = None) -> DataFrame:
        return rendering.main_table(self.view, limit)

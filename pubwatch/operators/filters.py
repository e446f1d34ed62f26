"""Filters. Date predicates are plain ranges on the column, so that they reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grade_gate(df: DataFrame, grade: str = "Q1") -> DataFrame:
    """Rows of exactly this grade; a mixed grade such as ``Q1/Q2`` is out."""
    return df.where(F.col("grade") == grade)


def recent_works(works: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """Works published on or after ``as_of - days``; there is no upper bound."""
    return works.where(F.col("publication_date") >= F.lit(as_of - dt.timedelta(days=days)))


def works_in_years(works: DataFrame, first: int, last: int) -> DataFrame:
    """Works published in the years ``first`` to ``last``, both inclusive."""
    date = F.col("publication_date")
    return works.where((date >= F.lit(dt.date(first, 1, 1))) & (date < F.lit(dt.date(last + 1, 1, 1))))


def has_abstract(df: DataFrame) -> DataFrame:
    return df.where(F.col("abstract").isNotNull() & (F.col("abstract") != ""))


def dashboard_filter(
    archive: DataFrame,
    subjects: Sequence[str] | None = None,
    grades: Sequence[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    journals: Sequence[str] | None = None,
) -> DataFrame:
    """The dashboard's current view; a control that is not set does not filter."""
    if subjects is not None:
        archive = archive.where(F.col("subject").isin(*subjects))
    if grades is not None:
        archive = archive.where(F.col("grade").isin(*grades))
    if journals is not None:
        archive = archive.where(F.col("journal_name").isin(*journals))
    if start is not None:
        archive = archive.where(F.col("publication_date") >= F.lit(start))
    if end is not None:
        archive = archive.where(F.col("publication_date") <= F.lit(end))
    return archive

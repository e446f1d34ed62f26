"""Archive jobs: full refresh, daily update and the metadata table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pubwatch.operators.filters import recent_works, works_in_years
from pubwatch.operators.joins import dimension_join, enrich
from pubwatch.operators.projections import archive_rows, fill_text
from pubwatch.operators.ranking import number_rows
from pubwatch.params import RunParams
from pubwatch.session import materialise
from pubwatch.sources.landing import (
    chain_stops,
    fetch_completeness,
    index_pages,
    indexed_pages,
    is_page,
    journal_metadata,
    valid_prefix,
    works_from_pages,
)
from pubwatch.sources.tables import NEWEST_PULL, archive_table, replace_table
from pubwatch.streaming.jobs import append_stream, upsert_stream


def archive_order() -> list[Column]:
    """Journal name, then newest first; the work id makes the order total."""
    return [F.asc("journal_name"), F.desc("publication_date"), F.asc("work_id")]


def sorted_archive(rows: DataFrame) -> DataFrame:
    """Archive rows in publishing order, numbered."""
    return number_rows(fill_text(rows), archive_order(), "archive-sorted")


def registry_columns(journals: DataFrame) -> DataFrame:
    return journals.select("issn", "subject", "grade")


KEY = ["work_id"]


def refresh_archive(
    landed: DataFrame, journals: DataFrame, params: RunParams, path: str, counts: bool = False
) -> bool:
    """Rebuild the archive from landed pages; tells whether it was rebuilt.

    A journal whose pull broke off, or that landed nothing, keeps its old rows; all others are
    replaced. A line that cannot be read, or a pull without any row, leaves the whole archive alone.
    The landed pages are scanned twice: for their index, and for the works of the pages it leaves.
    """
    spark = landed.sparkSession
    index = index_pages(landed)
    if index.unreadable:
        return False
    stops = chain_stops(index.pages)
    report = fetch_completeness(index.pages, journals, stops)
    failed = materialise(report.where("failed").select("issn"), "failed-journals")
    works = works_from_pages(valid_prefix(indexed_pages(landed, index), stops), abstracts=False)
    in_range = works_in_years(works, params.first_year, params.last_year)
    rows = enrich(in_range, registry_columns(journals))
    rows = dimension_join(rows, failed, "issn", "left_anti")
    rows = fill_text(archive_rows(rows, keep=("work_id", "issn")))
    pulled = Observation("pulled-rows")
    rows = rows.withColumn("pulled_on", F.lit(params.as_of)).observe(pulled, F.count("*").alias("n"))
    table = archive_table(spark, path, counts)
    old = table.read()
    if old is not None:
        held = dimension_join(old, failed, "issn", "left_semi")
        rows = rows.unionByName(held, allowMissingColumns=True)
    return table.replace(rows, accept=lambda: pulled.get["n"] > 0)


def daily_append(
    landed: DataFrame, journals: DataFrame, params: RunParams, path: str, counts: bool = False
) -> bool:
    """Append the rows of the last day's pull as they are; overlapping pulls repeat rows."""
    rows = _daily_rows(landed, journals, params)
    if rows.isEmpty():
        return False
    archive_table(landed.sparkSession, path, counts).append(rows)
    return True


def daily_upsert(
    landed: DataFrame, journals: DataFrame, params: RunParams, path: str, counts: bool = False
) -> None:
    """Merge the last day's pull into the archive by work id."""
    archive_table(landed.sparkSession, path, counts).merge(_daily_rows(landed, journals, params))


def ingest_pages(pages: DataFrame, journals: DataFrame, path: str, checkpoint: str) -> None:
    """Append the works of newly landed pages to a table of landed works, each page exactly once.

    ``pages`` is a stream. A page that failed has no works; pages after it are still taken, as each
    holds whole works. What is missing shows in the completeness report. The archive itself takes
    new pages through :func:`merge_pages`.
    """
    append_stream(_page_rows(pages, journals).drop("issn"), path, checkpoint)


def merge_pages(
    pages: DataFrame, journals: DataFrame, params: RunParams, path: str, checkpoint: str
) -> None:
    """Merge the works of newly landed pages into the archive by work id, as the pull of ``as_of``."""
    rows = _page_rows(pages, journals).withColumn("pulled_on", F.lit(params.as_of))
    upsert_stream(rows, path, checkpoint, KEY, NEWEST_PULL)


def _page_rows(pages: DataFrame, journals: DataFrame) -> DataFrame:
    works = works_from_pages(pages.where(is_page() & (F.col("status") == 200)), abstracts=False)
    return fill_text(archive_rows(enrich(works, registry_columns(journals)), keep=("work_id", "issn")))


def _daily_rows(landed: DataFrame, journals: DataFrame, params: RunParams) -> DataFrame:
    works = works_from_pages(valid_prefix(landed), abstracts=False)
    works = recent_works(works, params.as_of, params.daily_days)
    rows = archive_rows(enrich(works, registry_columns(journals)), keep=("work_id", "issn"))
    return fill_text(rows).withColumn("pulled_on", F.lit(params.as_of))


def replace_metadata(landed: DataFrame, journals: DataFrame, path: str) -> None:
    """Create or replace the table of journal names and grades."""
    works = works_from_pages(valid_prefix(landed), abstracts=False)
    replace_table(journal_metadata(works, journals), path)

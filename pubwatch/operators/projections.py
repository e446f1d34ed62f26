"""Projections to the archive row and the digest article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubwatch.functions import fixed
from pubwatch.sources import schemas

TEXT_COLUMNS = ["subject", "journal_name", "title", "grade", "link"]


def link() -> Column:
    """DOI of a work, else its id."""
    return F.coalesce(F.col("doi"), F.col("id"))


def title() -> Column:
    return F.coalesce(F.col("title"), F.lit(fixed.UNTITLED))


def journal_name() -> Column:
    return F.coalesce(F.col("journal_name"), F.lit(fixed.UNKNOWN_JOURNAL))


def archive_rows(enriched: DataFrame, with_grade: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Archive rows of enriched works; without the grade they have the older six-column layout."""
    rows = enriched.select(
        *keep,
        F.col("subject"),
        journal_name().alias("journal_name"),
        title().alias("title"),
        F.col("publication_date"),
        F.col("grade"),
        F.coalesce(F.col("cited_by_count"), F.lit(0)).cast("long").alias("citations"),
        link().alias("link"),
    )
    return rows if with_grade else rows.drop("grade")


def article_links(works: DataFrame) -> DataFrame:
    return works.select("work_id", link().alias("link"))


def article_nodes(selected: DataFrame) -> DataFrame:
    """Digest articles of numbered, selected works; the abstract stays for the summaries."""
    return selected.select(
        F.concat(F.lit(fixed.ANCHOR_PREFIX), F.col("article_no").cast("string")).alias("article_id"),
        "article_no",
        "subject",
        "section_ord",
        "paper_no",
        "work_id",
        title().alias("title"),
        journal_name().alias("journal_name"),
        link().alias("link"),
        "abstract",
    )


def fill_text(rows: DataFrame) -> DataFrame:
    """Empty strings for missing text; numbers and dates keep their NULLs."""
    return rows.na.fill("", [c for c in TEXT_COLUMNS if c in rows.columns])


def align_archive(rows: DataFrame) -> DataFrame:
    """Columns in archive order, by name; a missing one is NULL."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.ARCHIVE.fields
        ]
    )

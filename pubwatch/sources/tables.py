"""Sinks: snapshot, append, upsert, metadata table, digest and page files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pubwatch.operators.projections import align_archive
from pubwatch.sources import schemas
from pubwatch.sources.versioned import Layout, VersionedTable

def write_snapshot(
    rows: DataFrame,
    path: str,
    completeness: DataFrame | None = None,
    order: Sequence[Column] = (),
    drop: Sequence[str] = (),
    fmt: str = "parquet",
) -> bool:
    """Replace the table at ``path``; tells whether it was replaced.

    An empty result, or a completeness report with a failed journal, leaves the old table alone.
    Rows are sorted only after these checks; columns to ``drop`` may still take part in the order.
    A parquet table is replaced by its pointer (:mod:`versioned`), so it is whole at any time, and is
    read by :func:`read_snapshot`. A CSV file set is cleared and written anew, for other programs.
    """
    if completeness is not None and not completeness.where("failed").isEmpty():
        return False
    if rows.isEmpty():
        return False
    ordered = rows.orderBy(*order) if order else rows
    ordered = ordered.drop(*drop)
    if fmt == "parquet":
        VersionedTable(rows.sparkSession, path).replace(ordered, keep_order=bool(order))
    else:
        ordered.write.mode("overwrite").format(fmt).options(**_text_options(fmt)).save(path)
    return True


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest whole snapshot at ``path``, or None where there is none yet."""
    return VersionedTable(spark, path).read()


def append_rows(rows: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Add rows to the snapshot at ``path``, by column name; nothing is cleared."""
    if rows.isEmpty():
        return False
    aligned = align_archive(rows)
    if fmt == "parquet":
        VersionedTable(rows.sparkSession, path).append(aligned)
    else:
        aligned.write.mode("append").format(fmt).options(**_text_options(fmt)).save(path)
    return True


#: Of several versions of a work the last pulled one counts; the rest makes the order total.
NEWEST_PULL = ("-pulled_on", "-citations", "-publication_date", "link")
#: The dashboard filters by date, subject and grade; works and journals are looked up.
ARCHIVE_LAYOUT = Layout(
    bits={"publication_date": 6, "subject": 3, "grade": 2}, lookups=("work_id", "issn")
)


def archive_counts() -> dict[str, Column]:
    """What the dashboard's widgets count by."""
    month = F.trunc("publication_date", "month")
    return {"subject": F.col("subject"), "grade": F.col("grade"), "journal_name": F.col("journal_name"),
            "month": month}


def archive_table(spark: SparkSession, path: str, counts: bool = False) -> VersionedTable:
    """The archive at ``path``; with ``counts`` its writers also keep what the dashboard counts."""
    kept = archive_counts if counts else None
    return VersionedTable(spark, path, ["work_id"], NEWEST_PULL, ARCHIVE_LAYOUT, kept)


def read_archive(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a merged table, the newest version of each; None where there is no table yet."""
    return VersionedTable(spark, path).read()


def published(spark: SparkSession, path: str) -> DataFrame:
    """The archive as it is published: its seven columns."""
    return read_archive(spark, path).select(*schemas.ARCHIVE.names)


def upsert_table(path: str, new: DataFrame, key: Sequence[str], newest: Sequence[str]) -> None:
    """Merge ``new`` into the table at ``path``: the newest version of each key counts.

    Only the batch is written. A repeated call changes nothing.
    """
    VersionedTable(new.sparkSession, path, key, newest).merge(new)


def replace_table(rows: DataFrame, path: str) -> None:
    """Create the table or replace its content."""
    rows.write.mode("overwrite").parquet(path)


def write_digest(digest: DataFrame, path: str) -> None:
    """One UTF-8 text file per run date. ``digest`` has ``run_date`` and ``html``."""
    (
        digest.select(F.col("run_date").cast("string").alias("run_date"), F.col("html").alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .text(path)
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """HTML files as ``(url, html)``, one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("url"), F.col("value").alias("html")
    )


def write_pages(pages: DataFrame, path: str) -> None:
    """Rewritten pages as a new table; an existing one is an error, so a source is never replaced."""
    pages.write.mode("errorifexists").parquet(path)


def _text_options(fmt: str) -> dict[str, str]:
    return {"header": "true"} if fmt == "csv" else {}

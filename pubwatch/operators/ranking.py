"""Ranks, top-k cuts and numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubwatch.operators.joins import dimension_join
from pubwatch.session import materialise

POSITION_MASK = (1 << 33) - 1


def first_page(works: DataFrame, size: int = 15) -> DataFrame:
    """The newest ``size`` works per journal, with their position.

    The rank is cut right after it is computed, so each map task sends at most ``size`` rows per
    journal into the shuffle, however large the journal is.
    """
    newest = Window.partitionBy("issn").orderBy(F.desc("publication_date"), F.asc("work_id"))
    return works.withColumn("pos", F.row_number().over(newest)).where(F.col("pos") <= size)


def subject_cap(paged: DataFrame, cap: int = 5) -> DataFrame:
    """At most ``cap`` works with an abstract per subject, filled journal by journal in registry order.

    ``section_ord`` places the subject: it is the order of its first journal with any result, even
    one without an abstract. So the cut is made for works with and without abstract alike, in the
    map tasks, and the subject's first journal is found among the few rows that are left.
    """
    usable = F.coalesce(F.col("abstract") != "", F.lit(False))
    greedy = Window.partitionBy("subject", "_usable").orderBy("journal_ord", "pos")
    return (
        paged.withColumn("_usable", usable)
        .withColumn("paper_no", F.row_number().over(greedy))
        .where(F.col("paper_no") <= cap)
        .withColumn("section_ord", F.min("journal_ord").over(Window.partitionBy("subject")))
        .where("_usable")
        .drop("_usable")
    )


def number_articles(selected: DataFrame) -> DataFrame:
    """Number the selected works across subjects. One task, for at most cap x subjects rows."""
    return selected.withColumn(
        "article_no", F.row_number().over(Window.orderBy("journal_ord", "pos")).cast("long")
    )


def number_rows(df: DataFrame, order: Sequence[Column], label: str = "sorted") -> DataFrame:
    """``row_no`` from 1 over the whole table in a total order, without one task seeing it all.

    The table is range-sorted and written once together with each row's place in its partition.
    Offsets then come from one count per partition. ``order`` must end in a unique column, so that
    a task that runs twice writes the same rows in the same places.
    """
    place = F.monotonically_increasing_id()
    placed = materialise(
        df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_place", place), label
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    row_no = F.col("_offset") + F.col("_place").bitwiseAND(F.lit(POSITION_MASK)) + 1
    return (
        dimension_join(placed, offsets, "_part")
        .withColumn("row_no", row_no)
        .drop("_part", "_place", "_offset")
    )

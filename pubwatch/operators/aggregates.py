"""Counts, distributions and the contexts sent to a summariser.

Every grouping here aggregates before it shuffles, so a hot journal costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_rows(view: DataFrame, name: str = "n_articles") -> DataFrame:
    return view.agg(F.count("*").alias(name))


def subject_distribution(view: DataFrame) -> DataFrame:
    """Articles per subject and their share of the view. The total adds up one row per subject."""
    counts = view.groupBy("subject").agg(F.count("*").alias("n_articles"))
    total = F.sum("n_articles").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.col("n_articles") / total, 6))


def articles_per_journal(works: DataFrame) -> DataFrame:
    return works.groupBy("issn").agg(F.count("*").alias("n_articles"))


def volume_by(works: DataFrame, period: str) -> DataFrame:
    """Articles per ``month``, ``quarter`` or ``year``, named by the first day of the period."""
    start = F.trunc("publication_date", period)
    return works.groupBy(start.alias("period_start")).agg(F.count("*").alias("n_articles"))


def counted_distribution(counts: DataFrame) -> DataFrame:
    """:func:`subject_distribution` from counts by subject, grade, journal and month."""
    sums = counts.groupBy("subject").agg(F.sum("n_rows").alias("n_articles"))
    total = F.sum("n_articles").over(Window.partitionBy())
    return sums.withColumn("share", F.round(F.col("n_articles") / total, 6))


def counted_volume(counts: DataFrame, period: str) -> DataFrame:
    """:func:`volume_by` from counts by subject, grade, journal and month."""
    start = F.trunc("month", period)
    return counts.groupBy(start.alias("period_start")).agg(F.sum("n_rows").alias("n_articles"))


def journals_by_domain(journals: DataFrame, grades: Sequence[str] = ("Q1", "Q2", "Q1/Q2")) -> DataFrame:
    """Journals per subject, in total and per grade."""
    per_grade = [
        F.count_if(F.col("grade") == grade).alias(grade.lower().replace("/", "_")) for grade in grades
    ]
    return journals.groupBy("subject").agg(F.count("*").alias("n_journals"), *per_grade)


def run_summary(articles: DataFrame) -> DataFrame:
    """Run totals of a digest, as one row for the run log."""
    return articles.agg(
        F.count("*").alias("n_articles"),
        F.count_distinct("subject").alias("n_subjects"),
        F.count_distinct("journal_name").alias("n_journals"),
    )


def ordered_concat(order: Column, text: Column, separator: str = "") -> Column:
    """Aggregate: ``text`` of a bounded group, joined in ``order``."""
    pairs = F.sort_array(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(pairs, lambda pair: pair["t"]), separator)


def domain_context(articles: DataFrame) -> DataFrame:
    """Per subject its numbered findings. A subject has at most as many as the digest cap."""
    # Fixed value: the format of one finding.
    finding = F.format_string(
        "Paper %d: %s\nKey Finding: %s\n\n", F.col("paper_no"), F.col("title"), F.col("summary_en")
    )
    return articles.groupBy("subject").agg(ordered_concat(F.col("paper_no"), finding).alias("context"))


def global_context(articles: DataFrame) -> DataFrame:
    """All findings of the digest in article order, in one row; none for an empty digest."""
    # Fixed value: the format of one finding.
    finding = F.format_string(
        "-[ID: %s] Title: %s. Core Discovery: %s\n",
        F.col("article_id"),
        F.col("title"),
        F.col("summary_en"),
    )
    context = articles.agg(
        ordered_concat(F.col("article_no"), finding).alias("context"), F.count("*").alias("n_articles")
    )
    return context.where(F.col("n_articles") > 0)

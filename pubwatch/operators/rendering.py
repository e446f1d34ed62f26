"""Digest documents: cards, sections, page, teaser, links and file names.

Page-sized strings are only ever built from the capped selection.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubwatch.functions import fixed
from pubwatch.functions.text import absolutise_links, escape_html, extract_anchors, fill, title_preview
from pubwatch.operators.aggregates import ordered_concat


@dataclass(frozen=True)
class Templates:
    """The look of a digest. Slots in braces are filled; the rest is free."""

    card: str = (
        '<div id="{article_id}"><h4>{title}</h4><p>Journal: {journal}</p>'
        '<p>{summary_en}</p><p dir="rtl">{summary_he}</p><a href="{link}">Read the article</a></div>\n'
    )
    heading: str = "<h3>{subject}</h3>\n"
    executive: str = '<div><p>{summary_en}</p><p dir="rtl">{summary_he}</p></div>\n'
    page: str = (
        '<html><body dir="ltr"><h2>Research update</h2>\n'
        '<div><p>{briefing_en}</p><p dir="rtl">{briefing_he}</p></div>\n'
        "{sections}<p>Generated automatically.</p></body></html>\n"
    )
    teaser: str = (
        '<html><body><h2>Research update</h2><p>{briefing_en}</p><p dir="rtl">{briefing_he}</p>'
        '<a href="{page_url}">Read the full update</a></body></html>\n'
    )


DEFAULT = Templates()


def article_cards(articles: DataFrame, templates: Templates = DEFAULT) -> DataFrame:
    """One HTML fragment per article, with its anchor id."""
    card = fill(
        templates.card,
        article_id=F.col("article_id"),
        title=escape_html(F.col("title")),
        journal=escape_html(F.col("journal_name")),
        summary_en=escape_html(F.col("summary_en")),
        summary_he=escape_html(F.col("summary_he")),
        link=escape_html(F.col("link")),
    )
    return articles.select("article_id", "article_no", "subject", "section_ord", card.alias("card"))


def digest_sections(
    cards: DataFrame, summaries: DataFrame, templates: Templates = DEFAULT
) -> DataFrame:
    """One HTML section per subject with articles; the summary block only where there is a text."""
    bodies = cards.groupBy("subject", "section_ord").agg(
        ordered_concat(F.col("article_no"), F.col("card")).alias("cards"),
        F.count("*").alias("n_articles"),
    )
    en, he = F.col("domain_summary_en"), F.col("domain_summary_he")
    has_summary = (F.coalesce(en, F.lit("")) != "") | (F.coalesce(he, F.lit("")) != "")
    executive = fill(templates.executive, summary_en=escape_html(en), summary_he=escape_html(he))
    section = F.concat(
        fill(templates.heading, subject=escape_html(F.col("subject"))),
        F.when(has_summary, executive).otherwise(""),
        F.col("cards"),
    )
    return bodies.join(summaries, "subject", "left").select(
        "subject", "section_ord", "n_articles", section.alias("section")
    )


def digest_page(
    sections: DataFrame, briefing: DataFrame, run_date: dt.date, templates: Templates = DEFAULT
) -> DataFrame:
    """The whole digest of one run as one row; no row for a run without articles.

    ``sections`` has one row per subject and ``briefing`` at most one row, so that both fit into
    one aggregation.
    """
    parts = sections.select("section_ord", "section", "n_articles").unionByName(
        briefing.select("briefing_en", "briefing_he"), allowMissingColumns=True
    )
    whole = parts.agg(
        ordered_concat(F.col("section_ord"), F.col("section")).alias("sections"),
        F.sum("n_articles").alias("n_articles"),
        F.max("briefing_en").alias("briefing_en"),
        F.max("briefing_he").alias("briefing_he"),
    )
    page = fill(
        templates.page,
        briefing_en=F.col("briefing_en"),
        briefing_he=F.col("briefing_he"),
        sections=F.col("sections"),
    )
    return whole.where(F.col("n_articles") > 0).select(
        F.lit(run_date).alias("run_date"), "n_articles", page.alias("html")
    )


def digest_teaser(briefing: DataFrame, page_url: str, templates: Templates = DEFAULT) -> DataFrame:
    """The mail body of a run: the briefing with its links pointed at the published page."""
    teaser = fill(
        templates.teaser,
        briefing_en=absolutise_links(F.col("briefing_en"), page_url),
        briefing_he=absolutise_links(F.col("briefing_he"), page_url),
        page_url=F.lit(page_url),
    )
    return briefing.select(teaser.alias("html"))


def file_name(run_date: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.date_format(run_date, "yyyy-MM-dd"), F.lit(".html"))


def run_artifacts(runs: DataFrame, base_url: str, prefix: str) -> DataFrame:
    """File name and page address of every run date."""
    name = file_name(F.col("run_date"), prefix)
    return runs.select(
        "run_date", name.alias("file_name"), F.concat(F.lit(base_url + "/"), name).alias("page_url")
    )


def title_previews(works: DataFrame) -> DataFrame:
    return works.select(
        "work_id", title_preview(F.coalesce(F.col("title"), F.lit(fixed.UNTITLED))).alias("preview")
    )


def dangling_anchors(articles: DataFrame, briefing: DataFrame) -> DataFrame:
    """Links of the briefing that lead nowhere, and articles that it never links to."""
    links = briefing.select(F.explode(extract_anchors(F.col("briefing_en"))).alias("anchor")).distinct()
    targets = articles.select(F.col("article_id").alias("anchor"))
    missing = links.join(targets, "anchor", "left_anti").withColumn("problem", F.lit("no article"))
    unlinked = targets.join(links, "anchor", "left_anti").withColumn("problem", F.lit("never linked"))
    return missing.unionByName(unlinked)


def main_table(view: DataFrame, limit: int | None = None) -> DataFrame:
    """The dashboard's table, newest first, with the title as a link."""
    linked = F.concat(
        F.lit('<a href="'),
        escape_html(F.col("link")),
        F.lit('">'),
        escape_html(F.col("title")),
        F.lit("</a>"),
    )
    table = view.select("publication_date", "journal_name", linked.alias("title_link")).orderBy(
        F.desc("publication_date"), "journal_name", "title_link"
    )
    return table if limit is None else table.limit(limit)

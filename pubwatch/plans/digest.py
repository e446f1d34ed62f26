"""The weekly digest, from works and registry to documents."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubwatch.operators import ranking, rendering, summaries
from pubwatch.operators.filters import grade_gate, recent_works
from pubwatch.operators.joins import dimension_join, enrich
from pubwatch.operators.projections import article_nodes
from pubwatch.params import RunParams
from pubwatch.session import materialise
from pubwatch.sources.landing import with_abstract
from pubwatch.sources.tables import write_digest


def select_works(works: DataFrame, journals: DataFrame, params: RunParams) -> DataFrame:
    """The works of a digest, whose abstracts come as text or as inverted indexes.

    The page cut comes before the abstract filter, and the subject cap after both, so a page full
    of works without abstract uses up its journal's turn. The cut is made on keys alone; texts and
    indexes are fetched for the works that it leaves, a page per journal, and only then sorted.
    """
    graded = grade_gate(journals, params.digest_grade)
    recent = recent_works(works, params.as_of, params.lookback_days)
    key = ["issn", "work_id", "publication_date"]
    first = ranking.first_page(enrich(recent.select(*key), graded), params.page_size)
    first = materialise(first.select(*key).distinct(), "first-pages")
    chosen = dimension_join(recent, first, key, "left_semi")
    paged = ranking.first_page(enrich(chosen, graded), params.page_size)
    if "abstract_inverted_index" in paged.columns:
        paged = with_abstract(paged)
    return ranking.subject_cap(paged, params.subject_cap)


@dataclass(frozen=True)
class Digest:
    """The tables of one run. The selection is written once; all that follows reads it.

    Summaries are extractive, or come from a caller's ``summariser``. Its answers are written too, so
    that no text is sent again for another reader. A ``ledger`` keeps them over failures and runs.
    """

    works: DataFrame
    journals: DataFrame
    params: RunParams
    templates: rendering.Templates = rendering.DEFAULT
    summariser: summaries.Summariser | None = None
    tasks: int | None = None
    ledger: str | None = None

    def _summarise(self, requests: DataFrame, tier: summaries.Tier, en: str, he: str) -> DataFrame:
        answers = summaries.summarise_with(
            requests, self.summariser, tier, self.params.max_attempts, tasks=self.tasks, ledger=self.ledger
        )
        named = answers.withColumnsRenamed({"en": en, "he": he})
        return materialise(named.drop("request", "attempts", "status"), "summaries")

    @cached_property
    def articles(self) -> DataFrame:
        """Numbered articles with their summaries: at most cap x subjects rows."""
        selected = select_works(self.works, self.journals, self.params)
        nodes = article_nodes(ranking.number_articles(selected))
        if self.summariser is None:
            return materialise(summaries.article_summaries(nodes), "digest-articles")
        requests = summaries.article_requests(materialise(nodes, "digest-articles"))
        return self._summarise(requests, summaries.ARTICLE, "summary_en", "summary_he")

    @cached_property
    def domain_summaries(self) -> DataFrame:
        if self.summariser is None:
            return summaries.domain_summaries(self.articles)
        requests = summaries.domain_requests(self.articles)
        return self._summarise(requests, summaries.DOMAIN, "domain_summary_en", "domain_summary_he")

    @cached_property
    def briefing(self) -> DataFrame:
        if self.summariser is None:
            return summaries.global_briefing(self.articles)
        requests = summaries.global_requests(self.articles)
        return self._summarise(requests, summaries.GLOBAL, "briefing_en", "briefing_he")

    @property
    def sections(self) -> DataFrame:
        cards = rendering.article_cards(self.articles, self.templates)
        return rendering.digest_sections(cards, self.domain_summaries, self.templates)

    @property
    def page(self) -> DataFrame:
        return rendering.digest_page(self.sections, self.briefing, self.params.as_of, self.templates)

    @property
    def page_url(self) -> str:
        p = self.params
        return f"{p.base_url}/{p.file_prefix}{p.as_of.isoformat()}.html"

    @property
    def teaser(self) -> DataFrame:
        return rendering.digest_teaser(self.briefing, self.page_url, self.templates)

    def publish(self, path: str) -> bool:
        """Write the page; an empty run publishes nothing."""
        if self.articles.isEmpty():
            return False
        write_digest(self.page, path)
        return True


def dangling(digest: Digest) -> DataFrame:
    return rendering.dangling_anchors(digest.articles, digest.briefing)


def run_log(digest: Digest) -> DataFrame:
    """Article numbers and title previews of a run."""
    return digest.articles.select(
        "article_no", "subject", rendering.title_preview(F.col("title")).alias("preview")
    )

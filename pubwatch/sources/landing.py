"""Landed API pages: reading, the valid part of each journal's page chain, works, completeness."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from pubwatch.functions import fixed
from pubwatch.functions.abstracts import restore_abstract
from pubwatch.operators.joins import dimension_join
from pubwatch.operators.ranking import first_page
from pubwatch.operators.sets import latest_versions
from pubwatch.session import materialise
from pubwatch.sources import schemas

WORK_FIELDS = ("id", "title", "publication_date", "cited_by_count", "doi")
GROUP_BYTES = 8 << 20
#: How landed pages are written. A task that reads them decodes thousands of rows at once, but never
#: more than a row group, so groups are cut by their bytes. Values are plain and pages compressed
#: with their group, as dictionaries and compression hide what the values take once they are read.
PAGE_GROUPS = {
    "parquet.block.size": GROUP_BYTES,
    "parquet.page.size": GROUP_BYTES,
    "parquet.page.size.row.check.min": 1,
    "parquet.page.size.row.check.max": 1,
    "parquet.enable.dictionary": False,
}


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed page envelopes of one pull, one JSON object per line, against the declared schema.

    A line that is no whole object keeps its text in ``corrupt_line``; nothing vanishes unseen.
    """
    reader = spark.read.schema(schemas.LANDED_PAGE)
    return reader.option("columnNameOfCorruptRecord", schemas.CORRUPT).json(path)


def land_pages(spark: SparkSession, json_path: str, path: str) -> None:
    """Turn landed JSON into a parquet table, so that later passes read only what they need."""
    read_landed_pages(spark, json_path).write.mode("overwrite").options(**PAGE_GROUPS).parquet(path)


def is_page() -> Column:
    """Whether a landed row is a page that could be read."""
    return F.col("issn").isNotNull() & F.col("page_no").isNotNull() & F.col(schemas.CORRUPT).isNull()


def unreadable_lines(landed: DataFrame) -> int:
    """Landed lines that are no page. Whose works they held is not known."""
    return landed.select("issn", "page_no", schemas.CORRUPT).where(~is_page()).count()


@dataclass(frozen=True)
class PageIndex:
    """What one scan tells about landed pages, without their works.

    ``pages``: each (journal, page number) once, by the copy that counts, with its number of works,
    how many copies landed and how many of them are alike in all but their works.
    """

    pages: DataFrame
    unreadable: int


INDEX = ("issn", "page_no", "request_cursor", "next_cursor", "status", "attempt")


def index_pages(landed: DataFrame) -> PageIndex:
    """Scan the landed pages once, for their keys, cursors and sizes and the lines that are no page."""
    seen = Observation("landed-lines")
    scanned = landed.select(*INDEX, _works_of(landed).alias("n_works"), is_page().alias("readable"))
    scanned = scanned.observe(seen, F.count_if(~F.col("readable")).alias("unreadable"))
    copies = scanned.where("readable").groupBy(*INDEX, "n_works").agg(F.count("*").alias("alike"))
    copies = materialise(copies, "landed-index")
    times = F.sum("alike").over(Window.partitionBy("issn", "page_no")).alias("times")
    pages = latest_versions(copies.select("*", times), ["issn", "page_no"], _best_copy(F.col("n_works")))
    return PageIndex(materialise(pages, "landed-pages"), seen.get["unreadable"])


def indexed_pages(landed: DataFrame, index: PageIndex) -> DataFrame:
    """The landed pages that the index names, each once, in one scan.

    Only the pages that landed several times take part in the join. A second scan is needed where
    copies are alike in all but their works; of those one is taken.
    """
    readable = landed.where(is_page())
    repeated = index.pages.where("times > 1")
    if repeated.isEmpty():
        return readable
    key = ["issn", "page_no"]
    told = [*INDEX[2:], "n_works"]
    wanted = repeated.select(*key, *[F.col(c).alias(f"_{c}") for c in told], "alike", "times")
    sized = readable.withColumn("n_works", _works_of(landed))
    joined = dimension_join(sized, wanted, key, "left")
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in told))
    chosen = joined.where(F.col("times").isNull() | same)
    if repeated.where("alike > 1").isEmpty():
        return chosen.select(*landed.columns)
    several = F.coalesce(F.col("alike") > 1, F.lit(False))
    single = chosen.where(~several).select(*landed.columns)
    return single.unionByName(chosen.where(several).select(*landed.columns).dropDuplicates(key))


def whole_pages(landed: DataFrame) -> DataFrame:
    """Readable pages, each (journal, page number) once.

    Of a page that landed several times, one that came back whole wins, then the later attempt,
    then the one with more works. The choice is made on an index, so the works stay where they are.
    """
    return indexed_pages(landed, index_pages(landed))


def _best_copy(works: Column) -> list[Column]:
    return [
        F.desc(F.coalesce(F.col("status") == 200, F.lit(False))),
        F.desc_nulls_last("attempt"),
        F.desc(works),
        F.asc_nulls_last("request_cursor"),
        F.asc_nulls_last("next_cursor"),
    ]


def _works_of(pages: DataFrame) -> Column:
    """Works per page, of pages, of raw pages or of their index."""
    return F.col("n_works") if "n_works" in pages.columns else n_results()


def n_results() -> Column:
    """Works on a page. Counted over one nested field, so the works themselves are not read."""
    return F.greatest(F.coalesce(F.size(F.col("results.id")), F.lit(0)), F.lit(0)).cast("long")


def page_chain(landed: DataFrame) -> DataFrame:
    """Per page: whether it belongs to its journal's chain, and if not, whether that is a clean end.

    A page belongs if it came back whole, has results, and was asked for with the cursor of the
    page before. Only page keys and cursors are shuffled, by journal and page, so a journal with
    very many pages is spread over all tasks. ``landed`` has each page once, or is their index.
    """
    pages = landed.select(
        "issn",
        "page_no",
        "request_cursor",
        "next_cursor",
        F.coalesce(F.col("status") == 200, F.lit(False)).alias("fetched"),
        (_works_of(landed) == 0).alias("empty"),
    )
    before = landed.select(
        "issn",
        (F.col("page_no") + 1).alias("page_no"),
        F.col("next_cursor").alias("expected_cursor"),
        F.lit(True).alias("has_before"),
    )
    expected = F.when(F.col("page_no") == 1, F.lit(fixed.FIRST_CURSOR)).otherwise(F.col("expected_cursor"))
    linked = F.coalesce(expected == F.col("request_cursor"), F.lit(False))
    past_the_end = F.coalesce(F.col("has_before"), F.lit(False)) & F.col("expected_cursor").isNull()
    return pages.join(before, ["issn", "page_no"], "left").select(
        "issn",
        "page_no",
        "next_cursor",
        (linked & F.col("fetched") & ~F.col("empty")).alias("in_chain"),
        ((linked & F.col("fetched") & F.col("empty")) | past_the_end).alias("clean_end"),
    )


def chain_stops(landed: DataFrame) -> DataFrame:
    """Per journal its first page outside the chain, and whether the pull broke off there.

    An empty page, or a last page without a next cursor, is a clean end. A failed or missing page,
    or a next cursor that nobody followed, is not. The stops are written, as several readers share
    them. ``landed`` has each page once (:func:`whole_pages`).
    """
    stop = F.min(F.when(~F.col("in_chain"), F.struct("page_no", "clean_end")))
    stops = (
        page_chain(landed)
        .groupBy("issn")
        .agg(
            stop.alias("stop"),
            F.max("page_no").alias("last_page"),
            F.max_by(F.col("next_cursor").isNotNull(), F.col("page_no")).alias("open_end"),
        )
        .select(
            "issn",
            F.coalesce(F.col("stop.page_no"), F.col("last_page") + 1).alias("stop_page"),
            "last_page",
            F.coalesce(~F.col("stop.clean_end"), F.col("open_end")).alias("failed"),
        )
    )
    return materialise(stops, "chain-stops")


def valid_prefix(landed: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """Pages of each journal up to its first failed, empty or unlinked one.

    ``stops`` are those of ``landed``, if they are known; then ``landed`` has each page once. Only
    journals whose chain is cut take part in the join, so the pages themselves stay where they are.
    """
    if stops is None:
        index = index_pages(landed)
        landed, stops = indexed_pages(landed, index), chain_stops(index.pages)
    cut = stops.where("stop_page <= last_page").select("issn", "stop_page")
    kept = dimension_join(landed, cut, "issn", "left")
    return kept.where(F.col("stop_page").isNull() | (F.col("page_no") < F.col("stop_page"))).drop("stop_page")


def fetch_completeness(
    landed: DataFrame, journals: DataFrame, stops: DataFrame | None = None
) -> DataFrame:
    """Per registered journal: pages landed and kept, works kept, and whether the pull broke off.

    Every registered journal is asked for, so one without a landed page has failed; a journal
    without works lands an empty page. ``stops`` as for :func:`valid_prefix`.
    """
    if stops is None:
        landed = index_pages(landed).pages
        stops = chain_stops(landed)
    sizes = landed.select("issn", "page_no", _works_of(landed).alias("n_works"))
    pages = dimension_join(sizes, stops.select("issn", "stop_page"), "issn")
    kept = F.col("page_no") < F.col("stop_page")
    counts = pages.groupBy("issn").agg(
        F.count("*").alias("pages_landed"),
        F.count_if(kept).alias("pages_kept"),
        F.sum(F.when(kept, F.col("n_works"))).alias("works_kept"),
    )
    report = journals.select("issn").join(counts, "issn", "left")
    report = report.join(stops.select("issn", "failed"), "issn", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts.columns[1:]]
    return report.select("issn", *numbers, F.coalesce("failed", F.lit(True)).alias("failed"))


def works_from_pages(pages: DataFrame, abstracts: bool = True) -> DataFrame:
    """Works of landed pages, one row each, with null-safe nested access.

    The wanted fields are zipped before they are exploded, as Spark prunes a nested scan to the
    fields named before an explode. Without ``abstracts`` the indexes, by far the largest field, are
    not read.
    """
    fields = {name: F.col(f"results.{name}") for name in WORK_FIELDS}
    fields["journal_name"] = F.col("results.primary_location.source.display_name")
    if abstracts:
        fields["abstract_inverted_index"] = F.col("results.abstract_inverted_index")
    zipped = F.arrays_zip(*[field.alias(name) for name, field in fields.items()])
    work = F.col("work")
    return pages.select("issn", F.explode(zipped).alias("work")).select(
        work["id"].alias("work_id"),
        "issn",
        work["title"].alias("title"),
        F.expr("try_cast(work.publication_date as date)").alias("publication_date"),
        F.coalesce(work["cited_by_count"], F.lit(0)).alias("cited_by_count"),
        work["doi"].alias("doi"),
        work["id"].alias("id"),
        F.coalesce(work["journal_name"], F.lit(fixed.UNKNOWN_JOURNAL)).alias("journal_name"),
        *([work["abstract_inverted_index"].alias("abstract_inverted_index")] if abstracts else []),
    )


def with_abstract(works: DataFrame) -> DataFrame:
    """Works with their abstract as text in place of the inverted index."""
    return works.withColumn("abstract", restore_abstract(F.col("abstract_inverted_index"))).drop(
        "abstract_inverted_index"
    )


def journal_metadata(works: DataFrame, journals: DataFrame) -> DataFrame:
    """Journal name and grade, the name as the journal's newest work spells it."""
    newest = first_page(works.select("issn", "work_id", "publication_date", "journal_name"), 1)
    named = dimension_join(newest, journals.select("issn", "grade"), "issn")
    return named.select(
        F.coalesce(F.col("journal_name"), F.lit(fixed.UNKNOWN_JOURNAL)).alias("journal_name"),
        F.col("grade").alias("journal_grade"),
    )

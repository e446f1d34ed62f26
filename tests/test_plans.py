"""Physical plans: what is pushed down, broadcast and limited."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import fixtures.queries
import fixtures.views
from pubwatch.operators import joins
from pubwatch.sources import landing
from pubwatch.streaming import jobs
from tests.compare import TESTDATA

SF_DIR = str(TESTDATA / "sf0.01")


def plan(spark, name):
    df = fixtures.queries.all_queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_registry_is_broadcast(spark):
    text = plan(spark, "works_enriched")
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["digest_selection", "first_page_per_journal", "dedup_works"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


@pytest.mark.parametrize("name", ["recent_works", "works_in_years"])
def test_dates_reach_the_scan(spark, name):
    text = plan(spark, name)
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate," in text
    assert "l_extendedprice" not in text


@pytest.mark.parametrize(
    "name", ["subject_distribution", "articles_per_journal", "volume_by_month"]
)
def test_groups_are_merged_before_the_shuffle(spark, name):
    text = plan(spark, name)
    tree = text[: text.index("\n\n")]
    assert tree.count("HashAggregate") >= 2
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_no_query_has_a_cross_join(spark):
    for name in fixtures.queries.all_queries():
        text = plan(spark, name)
        assert "CartesianProduct" not in text
        assert "NestedLoop" not in text


def test_streams_have_no_cross_join(spark, tmp_path):
    """The plans of the streaming jobs themselves, before they start."""
    works = fixtures.queries.works_stream(spark, SF_DIR)
    events = fixtures.queries.event_stream(spark, SF_DIR)
    known = fixtures.views.view(spark, SF_DIR, "journals_big").select("issn", "subject", "grade")
    plans = [
        jobs.enrich_stream(works, known, fixtures.queries.BIG_KEY),
        jobs.dedup_stream(events, ["user_id", "event_type", "day"], "ts", "1 day"),
        jobs.window_counts(events, "event_type", "ts", "7 days", "1 day"),
    ]
    for df in plans:
        text = df._jdf.queryExecution().analyzed().toString()
        assert "Join Cross" not in text
        assert "Python" not in text and "InArrow" not in text


def test_pages_stay_where_they_are_for_a_large_registry(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 2_000)
    landed = fixtures.views.landed_pages(spark, SF_DIR)
    pages = landing.whole_pages(landed)
    stops = landing.chain_stops(pages)
    once = landed.where(landing.is_page() & (F.col("attempt") == 2))
    kept = landing.valid_prefix(once, stops)
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert kept.count() == landing.valid_prefix(landed).count()


def test_the_chain_prefix_reads_one_nested_field(spark):
    lines = plan(spark, "cursor_chain_prefix").splitlines()
    scans = [line for line in lines if "ReadSchema" in line and "results" in line]
    assert scans and all("results:array<struct<id:string>>" in s for s in scans)


def test_texts_come_after_the_page_cut(spark):
    """Above the scan that reads texts there is the semi-join with the chosen works, then a sort."""
    text = plan(spark, "digest_selection")
    tree = text[: text.index("\n\n")].splitlines()
    joins_ = [i for i, line in enumerate(tree) if "LeftSemi" in line or "BroadcastHashJoin" in line]
    sorts = [i for i, line in enumerate(tree) if "Sort" in line]
    assert joins_ and max(sorts, default=0) < max(joins_)

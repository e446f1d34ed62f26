from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pubwatch.operators import joins, ranking, sets
from pubwatch.sources import registry


@pytest.fixture(scope="module")
def facts(spark):
    # One key holds half of the rows, some have no key, some match nothing.
    key = (
        F.when(F.col("id") % 2 == 0, "hot")
        .when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    )
    return spark.range(5000).select("id", key.alias("issn"))


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("hot", "H"), *[(f"k{i}", f"S{i}") for i in range(40)], (None, "N"), ("unused", "U")]
    return spark.createDataFrame(rows, "issn string, subject string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_large_dimension_gives_the_same_rows(facts, dim, how, monkeypatch):
    plain = facts.join(dim, "issn", how)
    small = joins.dimension_join(facts, dim, "issn", how, ["id"])
    salted = joins.spread_join(facts, dim, ["issn"], how, ["id"])
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    assert joins.dimension_join(facts, dim, "issn", how, ["id"]).count() == plain.count()
    order = ["id", "issn"]
    assert plain.columns == salted.columns == small.columns
    expected = plain.orderBy(order).collect()
    assert salted.orderBy(order).collect() == expected
    assert small.orderBy(order).collect() == expected


def test_a_dimension_is_broadcast_by_its_bytes(facts, dim):
    assert joins.fits_broadcast(dim)
    assert not joins.fits_broadcast(dim, max_bytes=10)
    # a row counts for more than its text
    assert not joins.fits_broadcast(dim, max_bytes=dim.count() * 16)


def test_full_outer_is_refused(facts, dim):
    with pytest.raises(ValueError, match="not a facts-side join"):
        joins.dimension_join(facts, dim, "issn", "full_outer")


def test_grade_conflicts_of_default_registry(spark):
    journals = registry.default_journals(spark)
    assert joins.grade_conflicts(journals, registry.uniform_grade(journals)).count() == 15
    shorter = journals.where("journal_ord > 0")
    assert [tuple(r) for r in joins.grade_conflicts(journals, shorter).collect()] == [
        ("0355-3140", "Q1", None)
    ]


def test_archive_with_grade_keeps_row_count(spark):
    archive = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "z")], "journal_name string, link string")
    metadata = spark.createDataFrame([("A", "Q2"), ("A", "Q1")], "journal_name string, journal_grade string")
    rows = joins.archive_with_grade(archive, metadata).orderBy("link").collect()
    assert [r["journal_grade"] for r in rows] == ["Q1", "Q1", None]


def test_number_rows_is_the_global_row_number(spark, facts):
    order = [F.asc("issn"), F.desc("id")]
    numbered = ranking.number_rows(facts.repartition(7), order)
    rows = numbered.orderBy("row_no").collect()
    assert [r["row_no"] for r in rows] == list(range(1, 5001))
    assert [r["id"] for r in rows] == [r["id"] for r in facts.orderBy(*order).collect()]


def test_number_rows_of_nothing(facts):
    assert ranking.number_rows(facts.where("id < 0"), [F.asc("id")]).count() == 0


def test_upsert_rows_is_idempotent(spark):
    archive = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, version int, v string")
    new = spark.createDataFrame([(2, 2, "c"), (3, 2, "d")], "k int, version int, v string")
    newest = [F.desc("version"), F.asc("v")]
    once = sets.upsert_rows(archive, new, ["k"], newest)
    twice = sets.upsert_rows(once, new, ["k"], newest)
    expected = [(1, 1, "a"), (2, 2, "c"), (3, 2, "d")]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == expected

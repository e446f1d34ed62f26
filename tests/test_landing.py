from __future__ import annotations

import datetime as dt
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pubwatch.params import RunParams
from pubwatch.plans import archive as plan
from pubwatch.sources import landing, raw, registry, schemas, tables


def work(i, **fields):
    base = {
        "id": f"W{i}",
        "doi": f"d{i}",
        "title": f"Title {i}",
        "publication_date": "2024-05-01",
        "cited_by_count": i,
        "primary_location": {"source": {"display_name": "Journal"}},
        "abstract_inverted_index": {"b": [1], "a": [0]},
    }
    return {**base, **fields}


def page(issn, no, cursor, following, status=200, works=(1,)):
    return {
        "issn": issn,
        "page_no": no,
        "request_cursor": cursor,
        "status": status,
        "next_cursor": following,
        "results": [work(f"{issn}-{no}-{i}", cited_by_count=i) for i in works],
    }


PAGES = [
    # whole chain, last page without a next cursor
    page("whole", 1, "*", "c2"),
    page("whole", 2, "c2", None, works=(1, 2)),
    # ends with an empty page
    page("empty", 1, "*", "c2"),
    page("empty", 2, "c2", "c3", works=()),
    # breaks in the middle; later pages do not count
    page("broken", 1, "*", "c2"),
    page("broken", 2, "c2", "c3", status=500),
    page("broken", 3, "c3", None),
    # a page never landed
    page("gap", 1, "*", "c2"),
    page("gap", 3, "c3", None),
    # a page of another chain
    page("mixed", 1, "*", "c2"),
    page("mixed", 2, "z9", None),
    # the next cursor was never followed
    page("open", 1, "*", "c2"),
    # nothing usable at all
    page("dead", 1, "*", None, status=429),
    # a page behind the end of the chain
    page("beyond", 1, "*", None),
    page("beyond", 2, "c2", None),
]


@pytest.fixture(scope="module")
def json_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("landed")
    (path / "pages.json").write_text("\n".join(json.dumps(p) for p in PAGES))
    return str(path)


@pytest.fixture(scope="module")
def landed(spark, json_path):
    return landing.read_landed_pages(spark, json_path)


def test_valid_prefix(landed):
    kept = landing.valid_prefix(landed).select("issn", "page_no").collect()
    assert sorted(map(tuple, kept)) == [
        ("beyond", 1),
        ("broken", 1),
        ("empty", 1),
        ("gap", 1),
        ("mixed", 1),
        ("open", 1),
        ("whole", 1),
        ("whole", 2),
    ]


def registry_of(spark, *names):
    return spark.createDataFrame([(n, i, "S", "Q1") for i, n in enumerate(names)], schemas.JOURNAL)


def test_completeness(spark, landed):
    names = "whole empty broken gap mixed open dead beyond never".split()
    journals = registry_of(spark, *names)
    report = {r["issn"]: r for r in landing.fetch_completeness(landed, journals).collect()}
    assert set(report) == set(names)
    assert {i for i, r in report.items() if r["failed"]} == {"broken", "gap", "mixed", "open", "dead", "never"}
    assert report["never"][1:] == (0, 0, 0, True)
    assert report["whole"][1:] == (2, 2, 3, False)
    assert report["dead"][1:] == (1, 0, 0, True)
    assert report["empty"][1:] == (2, 1, 1, False)


def read_schema(spark, df):
    """The nested fields that a plan reads of the landed pages."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return [line for line in text.splitlines() if "ReadSchema" in line and "results" in line]


@pytest.fixture
def parquet(spark, json_path, tmp_path):
    landing.land_pages(spark, json_path, str(tmp_path / "pages"))
    return spark.read.schema(schemas.LANDED_PAGE).parquet(str(tmp_path / "pages"))


def test_chain_checks_read_one_nested_field(spark, parquet):
    scans = read_schema(spark, landing.page_chain(parquet))
    assert scans and all(s.endswith("results:array<struct<id:string>>>") for s in scans)
    assert parquet.select(landing.n_results().alias("n")).agg(F.sum("n")).first()[0] == 15


def test_archive_never_reads_abstracts(spark, parquet):
    works = landing.works_from_pages(landing.valid_prefix(parquet), abstracts=False)
    journals = spark.createDataFrame([("whole", 0, "S", "Q1")], schemas.JOURNAL)
    for df in (works, landing.journal_metadata(works, journals)):
        scans = read_schema(spark, df)
        assert scans and not any("abstract_inverted_index" in s for s in scans)
    with_index = landing.works_from_pages(landing.valid_prefix(parquet))
    assert "abstract_inverted_index" in read_schema(spark, with_index)[0]
    assert works.count() == with_index.count()


def with_copies(path):
    """A folder of the pages, some of which landed once more, at an earlier attempt without works."""
    first = [{**p, "status": 500, "results": None, "attempt": 1} for p in PAGES if p["issn"] in ("whole", "empty")]
    lines = [json.dumps(p) for p in [*({**p, "attempt": 2} for p in PAGES), *first]]
    (path / "copies.json").write_text("\n".join(lines))
    return str(path / "copies.json")


@pytest.mark.parametrize("abstracts", [False, True])
def test_works_of_repeated_pages_stay_where_they_are(spark, landed, tmp_path, abstracts):
    landing.land_pages(spark, with_copies(tmp_path), str(tmp_path / "pages"))
    copies = spark.read.schema(schemas.LANDED_PAGE).parquet(str(tmp_path / "pages"))
    works = landing.works_from_pages(landing.valid_prefix(copies), abstracts)
    (scan,) = read_schema(spark, works)
    assert ("abstract_inverted_index" in scan) == abstracts
    assert "Exchange hashpartitioning" not in works._jdf.queryExecution().executedPlan().toString()
    plain = landing.works_from_pages(landing.valid_prefix(landed), abstracts)
    assert sorted(map(str, works.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("land", [landing.land_pages, raw.land_raw_pages])
def test_a_row_group_holds_bounded_works(spark, tmp_path, land):
    """Words repeat, so that a dictionary would make two million of them look small."""
    index = {f"w{i}": [i] for i in range(2000)}
    made = page("j", 0, "*", None)
    made["results"] = [work(i, abstract_inverted_index=index) for i in range(10)]
    line = json.dumps(made)
    (tmp_path / "pages.json").write_text("\n".join(line.replace('"page_no": 0', f'"page_no": {n}') for n in range(100)))
    land(spark, str(tmp_path / "pages.json"), str(tmp_path / "pages"))
    groups = []
    for file in (tmp_path / "pages").glob("*.parquet"):
        stored = pq.ParquetFile(file).metadata
        groups += [stored.row_group(i) for i in range(stored.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 100
    assert max(g.num_rows for g in groups) <= 60
    assert max(g.total_byte_size for g in groups) < 1.1 * landing.GROUP_BYTES
    pages = spark.read.parquet(str(tmp_path / "pages"))
    assert pages.agg(F.sum(landing._works_of(pages)), F.countDistinct("page_no")).first()[:] == (1000, 100)


def test_works_survive_missing_parts(spark, tmp_path):
    odd = page("j", 1, "*", None)
    odd["results"] = [
        work(1, title=None, doi=None, cited_by_count=None, primary_location=None),
        work(2, primary_location={"source": None}, publication_date="not a date"),
        {"id": "W3"},
    ]
    (tmp_path / "p.json").write_text(json.dumps(odd))
    pages = landing.read_landed_pages(spark, str(tmp_path))
    works = landing.with_abstract(landing.works_from_pages(pages)).orderBy("work_id").collect()
    assert [w["journal_name"] for w in works] == ["Unknown Journal"] * 3
    assert [w["cited_by_count"] for w in works] == [0, 0, 0] or works[0]["cited_by_count"] == 0
    assert [w["publication_date"] for w in works] == [dt.date(2024, 5, 1), None, None]
    assert [w["abstract"] for w in works] == ["a b", "a b", None]


def test_failed_journals_keep_their_rows(spark, landed, tmp_path):
    journals = registry_of(spark, "whole", "empty", "broken", "silent")
    path = str(tmp_path / "archive")
    before = spark.createDataFrame(
        [(f"{i}-old", i, "S", "J", "T", dt.date(2020, 1, 1), "Q1", 1, "l") for i in ("whole", "broken", "silent")],
        "work_id string, issn string, subject string, journal_name string, title string,"
        " publication_date date, grade string, citations long, link string",
    )
    tables.archive_table(spark, path).replace(before)
    assert plan.refresh_archive(landed, journals, RunParams(as_of=dt.date(2025, 1, 1)), path)
    kept = {r["work_id"] for r in tables.read_archive(spark, path).collect()}
    assert kept == {"Wwhole-1-1", "Wwhole-2-1", "Wwhole-2-2", "Wempty-1-1", "broken-old", "silent-old"}
    assert tables.published(spark, path).columns == schemas.ARCHIVE.names
    # a pull without any row of a whole journal leaves the archive alone
    assert not plan.refresh_archive(landed.where("issn = 'dead'"), journals, RunParams(as_of=dt.date(2025, 1, 1)), path)
    assert tables.read_archive(spark, path).count() == 6


def test_metadata_table_is_replaced(spark, landed, tmp_path):
    journals = spark.createDataFrame([("whole", 0, "S", "Q1"), ("none", 1, "S", "Q2")], schemas.JOURNAL)
    path = str(tmp_path / "metadata")
    for _ in range(2):
        plan.replace_metadata(landed, journals, path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("Journal", "Q1")]


def test_default_registry(spark):
    journals = registry.default_journals(spark)
    assert journals.count() == 39
    grades = dict(journals.groupBy("grade").count().collect())
    assert grades == {"Q1": 24, "Q2": 12, "Q1/Q2": 3}
    subjects = journals.groupBy("subject").agg(F.count("*").alias("n"), F.min("journal_ord").alias("o"))
    assert [r["n"] for r in subjects.orderBy("o").collect()] == [7, 6, 4, 2, 5, 5, 5, 5]


def test_registry_round_trip(spark, tmp_path):
    journals = registry.default_journals(spark)
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        journals.write.format(fmt).option("header", True).save(path)
        assert sorted(registry.load_journals(spark, path, fmt).collect()) == sorted(journals.collect())


def land_lines(spark, tmp_path, pages, cut=()):
    lines = [json.dumps(p) for p in pages]
    for i in cut:
        lines[i] = lines[i][:-20]
    (tmp_path / "p.json").write_text("\n".join(lines))
    return landing.read_landed_pages(spark, str(tmp_path))


def test_broken_line_is_counted_and_gates(spark, tmp_path):
    pages = [page("j", 1, "*", "c2"), page("j", 2, "c2", None), page("k", 1, "*", None)]
    landed = land_lines(spark, tmp_path, pages, cut=[1])
    journals = registry_of(spark, "j", "k")
    report = {r["issn"]: r["failed"] for r in landing.fetch_completeness(landed, journals).collect()}
    assert report["j"] and not report["k"]
    assert landing.valid_prefix(landed).count() == 2
    assert landing.unreadable_lines(landed) == 1
    path = str(tmp_path / "archive")
    assert not plan.refresh_archive(landed, journals, RunParams(as_of=dt.date(2025, 1, 1)), path)
    assert tables.read_archive(spark, path) is None


def test_two_line_pull_with_a_cut_line_keeps_the_archive(spark, tmp_path):
    journals, params = registry_of(spark, "j", "k"), RunParams(as_of=dt.date(2025, 1, 1))
    pages, path = [page("j", 1, "*", None), page("k", 1, "*", None)], str(tmp_path / "archive")
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    assert plan.refresh_archive(land_lines(spark, tmp_path / "a", pages), journals, params, path)
    assert not plan.refresh_archive(land_lines(spark, tmp_path / "b", pages, cut=[1]), journals, params, path)
    assert tables.read_archive(spark, path).count() == 2


def test_a_page_that_landed_twice_counts_once(spark, tmp_path):
    pages = [
        page("twice", 1, "*", "c2"), page("twice", 1, "*", "c2"), page("twice", 2, "c2", None),
        {**page("retry", 1, "*", None, status=500), "attempt": 1}, {**page("retry", 1, "*", None), "attempt": 2},
        {**page("late", 1, "*", None, works=(1, 2)), "attempt": 1}, {**page("late", 1, "*", None), "attempt": 2},
    ]
    landed = land_lines(spark, tmp_path, pages)
    works = landing.works_from_pages(landing.valid_prefix(landed), abstracts=False)
    assert sorted(r["work_id"] for r in works.collect()) == ["Wlate-1-1", "Wretry-1-1", "Wtwice-1-1", "Wtwice-2-1"]
    report = landing.fetch_completeness(landed, registry_of(spark, "twice", "retry", "late")).collect()
    assert not any(r["failed"] for r in report)


def counted(df):
    """``df`` with a count of the rows that its scans give out."""
    counter = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), counter


def test_a_refresh_scans_the_pages_twice(spark, tmp_path):
    pages = [page(f"j{i}", n, "*" if n == 1 else f"c{n}", f"c{n + 1}" if n < 4 else None) for i in range(6) for n in range(1, 5)]
    pages += [{**page("j0", 2, "c2", "c3", status=500), "attempt": 0}]
    landed, counter = counted(land_lines(spark, tmp_path, [{"attempt": 1, **p} for p in pages]))
    journals, path = registry_of(spark, *(f"j{i}" for i in range(7))), str(tmp_path / "archive")
    for _ in range(2):
        before = counter.value
        assert plan.refresh_archive(landed, journals, RunParams(as_of=dt.date(2025, 1, 1)), path)
        assert counter.value - before <= 2 * len(pages)
    assert tables.read_archive(spark, path).count() == 24


def test_index_and_plain_reading_choose_the_same_pages(spark, landed, tmp_path):
    extra = [
        page("whole", 1, "*", "c2", status=500), page("open", 1, "*", "c2"), page("open", 1, "*", "c2", works=(4,)),
        {**page("empty", 1, "*", "c2", works=(7, 8)), "attempt": 3}, page("broken", 2, "c2", "c3", works=(5,)),
    ]
    several = land_lines(spark, tmp_path, [*PAGES, *extra], cut=[3])
    for pages in (landed, several):
        index = landing.index_pages(pages)
        assert index.unreadable == landing.unreadable_lines(pages)
        once = landing.whole_pages(pages)
        names = ("issn", "page_no", "status", "attempt")
        assert sorted(index.pages.select(*names).collect(), key=str) == sorted(once.select(*names).collect(), key=str)
        chosen = landing.indexed_pages(pages, index)
        assert sorted(chosen.select(*names).collect(), key=str) == sorted(once.select(*names).collect(), key=str)
        stops = landing.chain_stops(index.pages)
        assert sorted(stops.collect(), key=str) == sorted(landing.chain_stops(once).collect(), key=str)

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pubwatch.sources import landing, raw, schemas
from tests.test_landing import PAGES, page, work


def land(spark, tmp_path, lines):
    (tmp_path / "pages.json").write_text("\n".join(lines))
    raw.land_raw_pages(spark, str(tmp_path / "pages.json"), str(tmp_path / "raw"))
    return spark.read.parquet(str(tmp_path / "raw"))


def test_raw_pages_give_the_same_works(spark, tmp_path):
    pages = land(spark, tmp_path, map(json.dumps, PAGES))
    typed = landing.read_landed_pages(spark, str(tmp_path / "pages.json"))
    works = [
        landing.with_abstract(w).drop("work").orderBy("work_id").collect()
        for w in (
            raw.works_from_raw(landing.valid_prefix(pages)),
            landing.works_from_pages(landing.valid_prefix(typed)),
        )
    ]
    assert works[0] == works[1] and len(works[0]) > 5
    stops = [sorted(landing.chain_stops(landing.whole_pages(p)).collect()) for p in (pages, typed)]
    assert stops[0] == stops[1]
    index = landing.index_pages(pages)
    assert index.unreadable == 0 and landing.indexed_pages(pages, index).count() == len(PAGES)


def test_missing_differs_from_null(spark, tmp_path):
    odd = page("j", 1, "*", None)
    odd["results"] = [work(1), work(2, title=None), {"id": "W3"}, {"id": "W4", "title": ""}, None]
    works = raw.works_from_raw(land(spark, tmp_path, [json.dumps(odd)]))
    told = works.select(
        "work_id", raw.field_state(F.col("work"), "$.title"), raw.title_as_sent(F.col("work"))
    ).collect()
    assert sorted(map(tuple, told), key=str) == [
        ("W1", "set", "Title 1"),
        ("W2", "null", ""),
        ("W3", "missing", "Untitled"),
        ("W4", "set", ""),
        (None, "missing", "Untitled"),
    ]


def test_unknown_fields_survive(spark, tmp_path):
    odd = page("j", 1, "*", None) | {"meta": {"count": 2}}
    odd["results"] = [
        work(1, type="article", primary_location={"source": {"display_name": "J", "issn_l": "x"}, "pdf": [1]}),
        work(2, primary_location=None),
        {"id": "W3", "primary_location": 7, "type": None},
    ]
    pages = land(spark, tmp_path, [json.dumps(odd)])
    works = raw.works_from_raw(pages, abstracts=False)
    found = raw.undeclared_fields(works, "work", schemas.WORK, "work_id").collect()
    assert sorted(map(tuple, found)) == [
        ("W1", "primary_location.pdf", "[1]"),
        ("W1", "primary_location.source.issn_l", '"x"'),
        ("W1", "type", '"article"'),
        ("W3", "type", "null"),
    ]
    of_page = raw.undeclared_fields(pages, "envelope", schemas.LANDED_PAGE, "issn").collect()
    assert [tuple(r) for r in of_page] == [("j", "meta", '{"count":2}')]


def test_odd_lines_and_values(spark, tmp_path):
    lines = [
        "no json", "[1]", "7", "null", '{"issn":"a","issn":"b"}', "  ",
        '{"issn":"a","page_no":"x","results":[{"id":"W0"}]}',
        '{"issn":"b","page_no":1,"status":200,"request_cursor":"*","results":5}',
        '{"issn":"c","page_no":1,"status":200,"request_cursor":"*","results":[{"id":9,"cited_by_count":"z","title":"T"}]}',
    ]
    pages = land(spark, tmp_path, lines)
    rows = {r["issn"]: r for r in pages.where("issn is not null").collect()}
    corrupt = {r[0] for r in pages.where(F.col(schemas.CORRUPT).isNotNull()).select(schemas.CORRUPT).collect()}
    assert corrupt == set(lines[:5])
    assert (rows["a"]["page_no"], rows["a"]["n_works"], rows["b"]["n_works"]) == (None, 1, 0)
    works = raw.works_from_raw(landing.valid_prefix(pages)).collect()
    assert [(w["work_id"], w["title"], w["cited_by_count"]) for w in works] == [("9", "T", 0)]
    assert landing.index_pages(pages).unreadable == 6


@pytest.mark.parametrize("wanted", [landing.page_chain, lambda p: p.select(landing.is_page())])
def test_chain_checks_do_not_read_envelopes(spark, tmp_path, wanted):
    pages = land(spark, tmp_path, map(json.dumps, PAGES))
    assert "envelope" not in wanted(pages)._jdf.queryExecution().executedPlan().toString()

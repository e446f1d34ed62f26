"""How the stand-in pages are built: no step sorts whole texts, and no task holds them all."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import queries, views
from pubwatch.sources import landing, raw
from tests.compare import TESTDATA

SF_DIR = str(TESTDATA / "sf0.01")


@pytest.fixture
def tables(spark, tmp_path):
    """Works that share a key, two orders of one key, and a null text."""
    texts = [(i, f"word{i} and some more", "en", f"src{i % 2}", 20 + i) for i in range(1, 40)]
    texts += [(5, "another text of five", "fr", "src1", 20), (5, "a third", "de", "src0", 7), (7, None, "en", "src1", 0)]
    orders = [(i, dt.datetime(1999, 1, 1 + i % 28), 1000.0 * i) for i in range(1, 35)]
    orders += [(5, dt.datetime(2000, 2, 2), 9000.0)]
    made = {
        "documents": (texts, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        "orders": (orders, "o_orderkey bigint, o_orderdate timestamp_ntz, o_totalprice double"),
        "nation": ([(i, f"N{i}", 0) for i in range(3)], "n_nationkey bigint, n_name string, n_regionkey bigint"),
        "region": ([(0, "R")], "r_regionkey bigint, r_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def told(works):
    return Counter(tuple(r) for r in works.select("id", "issn", F.col("publication_date").cast("date"), "abstract").collect())


def test_pages_hold_the_texts_of_their_works(spark, tables):
    pages = views.landed_pages(spark, tables)
    found = told(landing.with_abstract(landing.works_from_pages(pages)))
    assert found == told(views.view(spark, tables, "works")) and found.total() == 40
    works = landing.with_abstract(raw.works_from_raw(land_raw(spark, tables)))
    assert told(works) == found


def land_raw(spark, tables):
    raw.land_raw_pages(spark, views.raw_json(spark, tables), f"{tables}/raw")
    return spark.read.parquet(f"{tables}/raw")


def test_works_are_numbered_without_their_texts(spark, tables):
    plan = views._cut_pages(spark, tables)._jdf.queryExecution().executedPlan().toString()
    numbered = [s for s in re.findall(r"ReadSchema: (\S+)", plan) if "_place:" in s]
    assert numbered and not any("abstract" in s or "text" in s for s in numbered)


@pytest.mark.parametrize("landed", [views.landed_json, views.raw_json])
def test_landed_lines_are_compressed(spark, tables, landed):
    files = [p.name for p in Path(landed(spark, tables)).glob("part-*")]
    assert files and all(name.endswith(".gz") for name in files)


def test_late_first_pages_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    names = iter(range(100))
    monkeypatch.setattr(queries, "new_path", lambda _, label: f"{tmp_path}/{label}-{next(names)}")
    kept = queries.all_queries()["stream_cursor_chain"](spark, SF_DIR)
    assert kept.count() > 90
    (folder,) = tmp_path.glob("landed-late-first-*")
    assert sorted(p.name for p in folder.iterdir()) == ["0", "1", "2", "3"]
    assert len(list((folder / "3").glob("*.parquet"))) > 1

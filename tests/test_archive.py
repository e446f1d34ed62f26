from __future__ import annotations

import datetime as dt
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pubwatch.operators import projections, sets
from pubwatch.params import RunParams
from pubwatch.plans import archive as plan
from pubwatch.session import new_path, shared_dir
from pubwatch.sources import landing, schemas, tables
from tests.test_landing import page

def newest():
    return [F.desc("version"), F.asc("v")]

SCHEMA = "k int, publication_date date, version int, v string"


def rows(spark, *items):
    return spark.createDataFrame(
        [(k, dt.date.fromisoformat(d) if d else None, n, v) for k, d, n, v in items], SCHEMA
    )


def content(spark, path):
    return sorted(
        (r["k"], str(r["publication_date"]), r["version"], r["v"]) for r in tables.read_archive(spark, path).collect()
    )


def test_snapshot_guards(spark, tmp_path):
    path = str(tmp_path / "s")
    full = rows(spark, (1, "2024-01-05", 1, "a"))
    failed = spark.createDataFrame([("j", True)], "issn string, failed boolean")
    assert tables.write_snapshot(full, path)
    assert not tables.write_snapshot(full.where("k > 9"), path)
    assert not tables.write_snapshot(rows(spark, (2, "2024-01-05", 1, "b")), path, failed)
    assert content(spark, path) == [(1, "2024-01-05", 1, "a")]


def test_csv_snapshot_has_a_header_and_order(spark, tmp_path):
    path = tmp_path / "c"
    full = rows(spark, (2, "2024-01-05", 1, "b"), (1, "2024-01-05", 1, "a"))
    assert tables.write_snapshot(full.coalesce(1), str(path), order=[F.asc("k")], fmt="csv")
    lines = [line for p in sorted(path.glob("part-*")) for line in p.read_text().splitlines()]
    assert lines[0] == "k,publication_date,version,v"
    assert [line for line in lines if not line.startswith("k,")] == ["1,2024-01-05,1,a", "2,2024-01-05,1,b"]


def test_append_aligns_by_name(spark, tmp_path):
    path = str(tmp_path / "a")
    archive = spark.createDataFrame(
        [("S", "J", "T", dt.date(2024, 1, 1), "Q1", 3, "l")], schemas.ARCHIVE
    )
    legacy = archive.select("link", "citations", "publication_date", "title", "journal_name", "subject")
    assert tables.append_rows(archive, path)
    assert tables.append_rows(legacy, path)
    assert not tables.append_rows(archive.where("citations > 9"), path)
    got = tables.read_snapshot(spark, path)
    assert got.columns == schemas.ARCHIVE.names
    assert {(r["title"], r["grade"], r["citations"]) for r in got.collect()} == {
        ("T", "Q1", 3),
        ("T", None, 3),
    }


def test_fill_text_leaves_numbers_alone(spark):
    df = spark.createDataFrame([(None, None, None)], "title string, citations long, publication_date date")
    assert tuple(projections.fill_text(df).first()) == ("", None, None)


def test_pages_are_never_replaced(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.html").write_text("<body>\nx</body>", encoding="utf-8")
    pages = tables.read_pages(spark, str(source))
    assert [r["html"] for r in pages.collect()] == ["<body>\nx</body>"]
    tables.write_pages(pages, out)
    with pytest.raises(Exception, match="already exists"):
        tables.write_pages(pages, out)


def test_latest_versions_sends_one_row_per_key_and_task(spark):
    df = rows(spark, (1, "2024-01-05", 1, "a"))
    text = sets.latest_versions(df, ["k"], newest())._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text
    assert "Partial" in text


def fake_session(configured, master, made):
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: made[-1] if made else None,
        setCheckpointDir=made.append,
        applicationId="app",
    )
    conf = SimpleNamespace(get=lambda key, default: configured)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_a_session_has_to_name_its_folder():
    assert shared_dir(fake_session("s3a://bucket/cp/", "yarn", [])) == "s3a://bucket/cp"
    for master in ("yarn", "local[2]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(fake_session(None, master, []))
    named = fake_session(None, "local[2]", ["/x/"])
    assert shared_dir(named) == "/x"
    assert new_path(named, "y").startswith("/x/pubwatch/app/y-")


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    else:
        assert shared_dir(spark) == spark.sparkContext.getCheckpointDir().rstrip("/")


def test_daily_runs(spark, tmp_path):
    pages = [
        page("j", 1, "*", "c2", works=(1, 2)),
        page("j", 2, "c2", None, works=(3,)),
        page("other", 1, "*", None),
    ]
    pages[0]["results"][0]["publication_date"] = "2024-04-29"
    (tmp_path / "p.json").write_text("\n".join(json.dumps(p) for p in pages))
    landed = landing.read_landed_pages(spark, str(tmp_path / "p.json"))
    journals = spark.createDataFrame([("j", 0, "S", "Q2")], schemas.JOURNAL)
    params = RunParams(as_of=dt.date(2024, 5, 1))
    appended, merged = str(tmp_path / "appended"), str(tmp_path / "merged")
    for _ in range(2):
        assert plan.daily_append(landed, journals, params, appended)
        plan.daily_upsert(landed, journals, params, merged)
    # Two works are recent enough; a repeated append repeats them, a repeated upsert does not.
    assert tables.read_archive(spark, appended).count() == 4
    rows_ = tables.read_archive(spark, merged).collect()
    assert sorted(r["link"] for r in rows_) == ["dj-1-2", "dj-2-3"]
    assert {(r["subject"], r["grade"], str(r["pulled_on"])) for r in rows_} == {("S", "Q2", "2024-05-01")}


def test_one_layout_for_all_jobs(spark, tmp_path):
    pages = [page("j", 1, "*", None, works=(1, 2, 3))]
    for work, day in zip(pages[0]["results"], ("2024-01-01", "2024-03-01", "2023-01-01"), strict=True):
        work["publication_date"] = day
    (tmp_path / "p.json").write_text(json.dumps(pages[0]))
    landed = landing.read_landed_pages(spark, str(tmp_path / "p.json"))
    journals = spark.createDataFrame([("j", 0, "S", "Q2")], schemas.JOURNAL)
    path = str(tmp_path / "archive")
    assert plan.refresh_archive(landed, journals, RunParams(as_of=dt.date(2024, 5, 1)), path)
    got = tables.published(spark, path)
    assert got.columns == schemas.ARCHIVE.names and got.count() == 2
    late = RunParams(as_of=dt.date(2024, 3, 2))
    assert plan.daily_append(landed, journals, late, path)
    assert tables.published(spark, path).groupBy("link").count().where("count = 2").count() == 1
    plan.daily_upsert(landed, journals, late, path)
    merged = tables.read_archive(spark, path)
    assert merged.count() == 2
    numbered = plan.sorted_archive(merged).orderBy("row_no").collect()
    assert [(r["row_no"], str(r["publication_date"])) for r in numbered] == [(1, "2024-03-01"), (2, "2024-01-01")]

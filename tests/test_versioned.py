"""Tables in versions: merge on read, commits, compaction, data skipping and counts."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pubwatch.operators import aggregates
from pubwatch.session import shared_dir
from pubwatch.sources import tables
from pubwatch.sources.versioned import Layout, Upkeep, VersionedTable

SCHEMA = "k int, day date, version int, v string"
NEWEST = ["-version", "v"]


def rows(spark, *items):
    return spark.createDataFrame([(k, d and dt.date.fromisoformat(d), n, v) for k, d, n, v in items], SCHEMA)


def content(table, version=None):
    found = table.read(version).select("k", F.col("day").cast("string"), "version", "v").collect()
    return sorted(map(tuple, found), key=str)


def size(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*") if p.is_file())


def scanned(df):
    """Rows that the file scans of an executed DataFrame gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_merges_and_appends(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], NEWEST)
    assert table.read() is None and table.version() is None
    first = [(1, "2024-01-05", 1, "a"), (2, "2024-02-05", 1, "b"), (3, None, 1, "c"), (1, "2024-01-05", 0, "old")]
    table.merge(rows(spark, *first))
    new = rows(spark, (1, "2024-03-01", 2, "A"), (3, "2024-03-02", 2, "C"), (4, "2024-03-03", 1, "d"))
    want = [(1, "2024-03-01", 2, "A"), (2, "2024-02-05", 1, "b"), (3, "2024-03-02", 2, "C"), (4, "2024-03-03", 1, "d")]
    for _ in range(2):
        table.merge(new)
        assert content(table) == want
    table.merge(rows(spark, (4, "2024-03-03", 0, "x")))  # an older version does not win
    assert content(table) == want
    again = (2, "2024-02-05", 1, "b")
    table.append(rows(spark, again))  # added as it is, until a merge touches its key
    assert content(table) == sorted([*want, again], key=str)
    table.merge(rows(spark, (2, "2024-02-05", 5, "B")))
    assert content(table) == sorted([*want[:1], (2, "2024-02-05", 5, "B"), *want[2:]], key=str)


def test_null_keys_and_new_columns(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], NEWEST)
    table.merge(rows(spark, (None, None, 1, "a"), (1, None, 1, "b")))
    table.merge(rows(spark, (None, None, 2, "A")).withColumn("more", F.lit(7)))
    got = sorted(((r["k"], r["v"], r["more"]) for r in table.read().collect()), key=str)
    assert got == [(1, "b", None), (None, "A", 7)]
    table.compact()
    assert table.read().count() == 2


def test_a_small_batch_writes_little(spark, tmp_path):
    path = tmp_path / "t"
    big = spark.range(300_000).select(
        F.col("id").cast("int").alias("k"), F.lit(dt.date(2024, 1, 1)).alias("day"), F.lit(1).alias("version"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    table = VersionedTable(spark, str(path), ["k"], NEWEST)
    table.replace(big)
    before = size(path)
    table.merge(big.where("k % 1000 = 0").withColumn("version", F.lit(2)))
    assert size(path) - before < 0.05 * before
    assert table.read().where("version = 2").count() == 300 and table.read().count() == 300_000


@pytest.mark.parametrize("write", ["replace", "merge", "append", "compact"])
def test_a_write_that_fails_before_its_pointer_changes_nothing(spark, tmp_path, monkeypatch, write):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], NEWEST)
    table.merge(rows(spark, (1, None, 1, "a")))
    table.merge(rows(spark, (2, None, 1, "b")))
    before = content(table)

    def fail(version):
        raise RuntimeError("the driver is gone")

    monkeypatch.setattr(table, "commit", fail)
    with pytest.raises(RuntimeError, match="gone"):
        table.compact() if write == "compact" else getattr(table, write)(rows(spark, (1, None, 9, "z")))
    monkeypatch.undo()
    assert content(table) == before
    table.merge(rows(spark, (3, None, 1, "c")))  # and the next one works
    assert len(content(table)) == 3


def test_a_failed_refresh_leaves_the_snapshot_whole(spark, tmp_path):
    path = str(tmp_path / "s")
    good = rows(spark, (1, "2024-01-05", 1, "a"), (2, "2024-01-05", 1, "b"))
    assert tables.write_snapshot(good, path)
    broken = good.unionByName(good).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("lost"))).otherwise("x"))
    with pytest.raises(Exception, match="lost"):
        tables.write_snapshot(broken, path)
    assert sorted(r["v"] for r in tables.read_snapshot(spark, path).collect()) == ["a", "b"]


def test_readers_pin_a_version_and_writers_do_not_overtake(spark, tmp_path):
    path = str(tmp_path / "t")
    table, other = (VersionedTable(spark, path, ["k"], NEWEST) for _ in range(2))
    table.merge(rows(spark, (1, None, 1, "a")))
    pinned, held = table.version(), table.read()
    stale = other.version()
    table.merge(rows(spark, (1, None, 2, "b")))
    table.replace(rows(spark, (5, None, 1, "e")))
    assert content(table, pinned) == [(1, None, 1, "a")] == [tuple(r) for r in held.collect()]
    assert content(table) == [(5, None, 1, "e")]
    with pytest.raises(FileExistsError):
        other.commit(type(stale)(**{**stale.__dict__, "number": stale.number + 1}))
    assert content(table) == [(5, None, 1, "e")]


def test_compaction_folds_changes_and_removes_old_folders(spark, tmp_path):
    path = tmp_path / "t"
    table = VersionedTable(spark, str(path), ["k"], NEWEST, upkeep=Upkeep(changes=3, keep=2))
    want = {}
    for n in range(12):
        table.merge(rows(spark, (n % 5, None, n, str(n)), (100 + n, None, 1, "x")))
        want |= {n % 5: (n, str(n)), 100 + n: (1, "x")}
        assert {r["k"]: (r["version"], r["v"]) for r in table.read().collect()} == want
        assert len(table.version().changes) < 3
    folders = {p.name for p in path.iterdir() if p.is_dir() and not p.name.startswith("_")}
    assert folders == set().union(*(table.version(n).folders for n in table.versions()))
    assert len(table.versions()) <= 4  # two are kept, and those since the last compaction


def test_intermediate_tables_go(spark, tmp_path):
    shared = Path(shared_dir(spark).removeprefix("file:"))

    def left():
        return {p.name for p in shared.glob("pubwatch/*/*") if p.name.startswith("table-rows")}

    before = left()
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], NEWEST, Layout(bits={"day": 3}))
    table.replace(rows(spark, (1, "2024-01-05", 1, "a"), (2, None, 1, "b")))
    table.replace(rows(spark))
    assert left() == before and table.read().count() == 0


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    """Works of seven years, eight subjects and three grades, in pages of 1,000 rows."""
    works = spark.range(400_000).select(
        F.concat(F.lit("W"), F.xxhash64("id").cast("string")).alias("work_id"),
        F.concat(F.lit("j"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)).cast("string")).alias("issn"),
        F.date_add(F.lit(dt.date(2018, 1, 1)), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(2556)).cast("int")).alias("publication_date"),
        F.concat(F.lit("S"), F.pmod(F.xxhash64("id", F.lit(3)), F.lit(8)).cast("string")).alias("subject"),
        F.element_at(F.array(F.lit("Q1"), F.lit("Q1/Q2"), F.lit("Q2")), (F.pmod(F.xxhash64("id", F.lit(4)), F.lit(3)) + 1).cast("int")).alias("grade"),
    )
    options = {"parquet.page.row.count.limit": "1000", "parquet.block.size": str(256 << 10), "parquet.block.size.row.check.min": "100"}
    layout = tables.ARCHIVE_LAYOUT
    layout = Layout(bits=layout.bits, lookups=layout.lookups, file_bytes=1 << 20, options=options)
    table = VersionedTable(spark, str(tmp_path_factory.mktemp("archive") / "t"), ["work_id"], ["publication_date"], layout)
    table.replace(works)
    return table, works


@pytest.mark.parametrize(
    "control,share",
    [("publication_date between '2021-03-01' and '2021-03-31'", 0.1), ("subject = 'S5'", 0.5),
     ("publication_date between '2020-05-01' and '2020-07-31' and subject = 'S2' and grade = 'Q2'", 0.08)],
)
def test_dashboard_controls_read_a_part_of_the_archive(laid_out, control, share):
    table, works = laid_out
    found = table.read().where(control)
    assert scanned(found) < share * 400_000
    assert found.count() == works.where(control).count() > 0


def test_lookups_of_unknown_works_read_nothing(laid_out):
    table, works = laid_out
    known = works.first()["work_id"]
    assert table.read().where(F.col("work_id") == known).count() == 1
    read = [scanned(table.read().where(F.col("work_id") == f"W{i}5x")) for i in range(20)]
    assert sum(read) < 0.2 * 400_000 * len(read) and min(read) == 0


def test_filters_reach_the_scan_with_changes_pending(spark, laid_out):
    table, works = laid_out
    changed = VersionedTable(spark, table.path, ["work_id"], ["publication_date"])
    text = changed.read().where("publication_date = date'2021-03-01'")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(publication_date)" in text


def test_counts_follow_three_upserts(spark, tmp_path):
    table = tables.archive_table(spark, str(tmp_path / "t"), counts=True)
    schema = "work_id string, pulled_on date, citations long, publication_date date, link string, subject string, grade string, journal_name string"
    day = dt.date

    def pull(on, *works):
        return spark.createDataFrame([(w, day(2024, 6, on), 1, d, "l", s, g, "J") for w, d, s, g in works], schema)

    def check():
        view, counts = table.read(), table.read_counts()
        for direct, counted in (
            (aggregates.subject_distribution(view), aggregates.counted_distribution(counts)),
            (aggregates.volume_by(view, "month"), aggregates.counted_volume(counts, "month")),
            (aggregates.volume_by(view, "year"), aggregates.counted_volume(counts, "year")),
        ):
            assert sorted(direct.collect(), key=str) == sorted(counted.collect(), key=str)

    table.merge(pull(1, ("a", day(2024, 1, 3), "S", "Q1"), ("b", day(2024, 2, 3), "S", "Q2"), ("c", None, "T", "Q1")))
    check()
    table.merge(pull(2, ("a", day(2024, 3, 3), "U", "Q1"), ("d", day(2024, 3, 9), "T", None)))
    check()
    table.merge(pull(2, ("a", day(2024, 3, 3), "U", "Q1")))  # repeated
    check()
    table.append(pull(3, ("d", day(2024, 3, 9), "T", None)))
    check()
    table.merge(pull(4, ("d", day(2024, 4, 9), "T", "Q1"), ("b", day(2023, 2, 3), "S", "Q2")))
    check()
    table.merge(pull(1, ("d", day(2020, 4, 9), "S", "Q1")))  # an old version
    check()
    assert table.read().count() == 4
    table.compact()
    check()
    assert len(table.version().counts) == 1

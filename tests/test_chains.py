"""The stop rule on streams, with pages that land in any order."""

from __future__ import annotations

import json

import pytest

from pubwatch.sources import landing, schemas
from pubwatch.streaming import chains, jobs
from tests.test_landing import PAGES, page


def follow(spark, folder, out, checkpoint, **options):
    pages = jobs.read_stream(spark, str(folder), schemas.LANDED_PAGE, "json", files_per_batch=1)
    chains.follow_chains(pages, out, checkpoint, **options)
    return sorted(map(tuple, spark.read.parquet(out).collect()), key=str)


@pytest.mark.parametrize("order", [1, -1])
def test_any_order_gives_the_prefix_of_the_batch(spark, tmp_path, order):
    folder, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    pages = [*PAGES, page("retry", 1, "*", "c2", status=500), page("retry", 1, "*", "c2"), page("retry", 2, "c2", None)]
    pages = pages[::order]
    # files land over several calls, and each call goes on from its checkpoint
    for at in range(0, len(pages), 6):
        (folder / f"{at}.json").write_text("\n".join(json.dumps(p) for p in pages[at : at + 6]))
        rows = follow(spark, folder, out, cp)
    landed = landing.read_landed_pages(spark, str(folder))
    want = landing.valid_prefix(landed).select("issn", "page_no", landing.n_results())
    assert [r[:3] for r in rows if r[3] == "kept"] == sorted(map(tuple, want.collect()), key=str)
    assert {r[0] for r in rows if r[3] == "end"} == {"whole", "empty", "beyond", "retry"}
    kept = chains.released_pages(landed, spark.read.parquet(out))
    assert kept.count() == want.count()


def test_a_chain_that_waits_too_long_is_broken(spark, tmp_path):
    folder, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    late = [
        [page("gap", 1, "*", "c2"), page("gap", 3, "c3", None), page("fine", 1, "*", "c2")],
        [page("fine", 2, "c2", None)],
        [page("gap", 2, "c2", "c3")],
    ]
    for i, pages in enumerate(late):
        (folder / f"{i}.json").write_text("\n".join(json.dumps(p) for p in pages))
        rows = follow(spark, folder, out, cp, patience_ms=1)
    assert [r for r in rows if r[0] == "fine"] == [("fine", 1, 1, "kept"), ("fine", 2, 1, "kept"), ("fine", 3, None, "end")]
    assert [r for r in rows if r[0] == "gap"] == [("gap", 1, 1, "kept"), ("gap", 2, None, "broken")]

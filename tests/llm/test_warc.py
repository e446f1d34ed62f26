from __future__ import annotations

import gzip

from pubwatch.llm import warc
from pubwatch.llm.common import materialise, new_path

ROWS = [
    (3, "http://a/3", "same"), (1, "http://a/1", "same"), (2, None, "same"), (4, "http://a/4\r\nX: y", ""),
    (5, "u", None), (6, "u", "é\r\n\r\nWARC/1.1 " * 3), (None, "n", "same"), (None, "n", "lone"), (7, "u", "twice"),
    (7, "u", "twice"), (8, "u", "z" * 3_000_000),
]


def archived(spark, rows, **options):
    root = new_path(spark, "warc-test")
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, digest string")
    return materialise(warc.write_archives(pages, root, **options), "index"), root


def test_records_come_back_whole(spark):
    index, root = archived(spark, ROWS)
    found = warc.read_records(index, root).collect()
    want = []
    for i, _, h in ROWS:
        same = [j for j, _, g in ROWS if (g or "") == (h or "") and j is not None]
        first = min(same) if len([1 for _, _, g in ROWS if (g or "") == (h or "")]) > 1 and same else None
        again = first is not None and i != first
        raw = (h or "").encode()
        want.append((i, "revisit" if again else "response", len(raw), warc.base32_sha1(raw), first if again else None, b"" if again else raw))
    got = [(r["id"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"], bytes(r["payload"])) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_small_payloads_are_never_revisits(spark):
    index, _ = archived(spark, ROWS, min_bytes=5)
    kinds = {(r["id"], r["record_type"]) for r in index.collect()}
    assert {(1, "response"), (2, "response"), (3, "response"), (7, "response")} <= kinds


def test_selected_records_alone(spark):
    index, root = archived(spark, [(i, f"http://a/{i}", f"page {i}") for i in range(500)])
    some = index.where("id % 7 = 0 or id between 100 and 120")
    found = {r["id"]: bytes(r["payload"]) for r in warc.read_records(some, root).collect()}
    assert found == {i: f"page {i}".encode() for i in range(500) if i % 7 == 0 or 100 <= i <= 120}


def test_offsets_delimit_members_and_gaps_split_reads(spark):
    index, root = archived(spark, [(i, "u", f"{i}") for i in range(9)])
    row = index.first()
    store, base = warc.fs.FileSystem.from_uri(root)
    with store.open_input_file(f"{base}/{row['archive']}") as file:
        data = gzip.decompress(file.read_at(row["length"], row["offset"]))
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    entries = [{"offset": o, "length": 10} for o in (0, 10, 20 + warc.GAP_BYTES, 31 + warc.GAP_BYTES + warc.READ_BYTES)]
    assert [len(g) for g in warc._ranges(entries)] == [3, 1]


def test_empty_table(spark):
    index, root = archived(spark, [])
    assert index.count() == 0 and warc.read_records(index, root).count() == 0

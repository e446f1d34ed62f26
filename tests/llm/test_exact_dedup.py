from __future__ import annotations

from pubwatch.llm import exact_dedup
from pyspark.sql import functions as F

ROWS = [
    (1, "Same Text", 0, "x"),
    (2, "same text", 1, "x"),
    (3, "SAME TEXT", 2, "x"),
    (4, "Äpfel", 3, "x"),
    (5, "äpfel", 4, "x"),
    (6, None, 5, "x"),
    (7, "", 6, "x"),
    (None, "alone", 7, "x"),
    (8, "again", 8, "x"),
    (8, "again", 8, "x"),
    (9, "long " * 50_000, 9, "x"),
    (10, "LONG " * 50_000, 9, "x"),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, kept int, group_size string")


def expected(keep):
    norm = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "") for _, t, _, _ in ROWS]
    out = []
    for (i, *_), t in zip(ROWS, norm, strict=True):
        members = [r[0] for r, n in zip(ROWS, norm, strict=True) if n == t]
        known = [m for m in members if m is not None]
        best = keep(known) if known else None
        out.append((i, best, len(members), i == best))
    return sorted(out, key=str)


def found(df):
    return sorted(((r[0], r[1], r[2], r[3]) for r in df.collect()), key=str)


def test_groups_equal_brute_force(spark):
    assert found(exact_dedup.duplicate_groups(docs(spark), keep="largest")) == expected(max)
    assert found(exact_dedup.duplicate_groups(docs(spark))) == expected(min)


def test_colliding_hashes_are_told_apart_by_bytes(spark):
    weak = exact_dedup.duplicate_groups(
        docs(spark), hash_of=lambda t: (F.length(t) % 2).cast("string").cast("binary")
    )
    assert found(weak) == expected(min)


def test_one_row_of_each_text_stays_whole(spark):
    kept = exact_dedup.drop_duplicates(docs(spark)).collect()
    assert kept[0].__fields__ == ["doc_id", "text", "kept", "group_size"]
    assert sorted((r[0] for r in kept), key=str) == sorted([1, 4, 5, 6, None, 8, 9], key=str)
    assert {r["kept"] for r in kept} == {0, 3, 4, 5, 7, 8, 9}


def test_empty_table(spark):
    assert exact_dedup.duplicate_groups(docs(spark, [])).count() == 0
    assert exact_dedup.drop_duplicates(docs(spark, [])).count() == 0

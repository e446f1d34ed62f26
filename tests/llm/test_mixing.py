from __future__ import annotations

import random

from pubwatch.llm import mixing
from pubwatch.llm.mixing import MixParams
from pyspark.sql import functions as F


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, copies string, q int")


def many(seed=3):
    pick = random.Random(seed)
    rows = []
    for i in range(3000):
        source = pick.choice(["a", "a", "a", "a", "b", "c", "d", None, "é"])
        rows.append((i, source, "w " * min(900, int(pick.expovariate(0.01))), "c", 1))
    return rows


def fill(sizes, weights, total, cap=2):
    """Targets by bisection on the level of the water."""
    low, high = 0.0, total * 2.0
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(cap * s, mid * w) for s, w in zip(sizes, weights, strict=True)) < total:
            low = mid
        else:
            high = mid
    return [min(cap * s, low * w) for s, w in zip(sizes, weights, strict=True)]


def test_targets_and_words_taken(spark):
    rows = many()
    found = mixing.mix(docs(spark, rows)).selectExpr("row.*", "size", "source_size", "target", "copies as n").collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, s, t, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = fill([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()))
    for s, target in zip(order, want, strict=True):
        mine = [r for r in found if r["source"] == s]
        assert all(abs(r["target"] - target) < 1e-6 * target for r in mine)
        taken, most = sum(r["size"] * r["n"] for r in mine), max(r["size"] for r in mine)
        assert abs(taken - target) <= most / 2
        assert {r["n"] for r in mine} <= {0, 1, 2}


def test_reruns_agree_whatever_the_partitions(spark):
    rows = many(4)
    first = mixing.mix(docs(spark, rows)).selectExpr("row.doc_id", "copies").collect()
    shuffled = docs(spark, rows[::-1]).repartition(7)
    again = mixing.mix(shuffled).selectExpr("row.doc_id", "copies").collect()
    assert sorted(first) == sorted(again)


def test_weights_tilt_the_draw(spark):
    rows = [(i, "s", "w w w", "c", 1 + 3 * (i % 2)) for i in range(4000)]
    params = MixParams(share=0.5)
    found = mixing.mix(docs(spark, rows), params, weight=F.col("q")).selectExpr("row.q", "copies").collect()
    share = {q: sum(r["copies"] for r in found if r["q"] == q) for q in (1, 4)}
    assert abs(share[1] + share[4] - 2000) <= 1
    assert 3 < share[4] / share[1] < 5


def test_odd_rows(spark):
    rows = [
        (1, None, None, "c", 1), (None, "a", "x y", "c", 1), (2, "a", "", "c", 1), (2, "a", "x y", "c", 1),
        (2, "a", "x y", "c", 1), (3, "b", "z " * 50_000, "c", 1),
    ]
    mixed = mixing.mix(docs(spark, rows))
    assert mixed.count() == len(rows)
    repeated = mixing.repeat_rows(mixed)
    assert repeated.columns == ["doc_id", "source", "text", "copies", "q"]
    assert repeated.count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, "a", None, "c", 1)])).first()["target"] == 0


def taken(mixed):
    rows = mixed.selectExpr("row.source as source", "size", "target", "copies").collect()
    return {
        s: (sum(r["size"] * r["copies"] for r in rows if r["source"] == s), next(r["target"] for r in rows if r["source"] == s))
        for s in {r["source"] for r in rows}
    }


def test_rows_without_an_id_are_drawn_by_their_text(spark):
    rows = [(None if i % 2 else 7, "a", f"t{i} " * (1 + i % 9), "c", 1) for i in range(3000)] + [(1, "b", "w " * 9000, "c", 1)]
    frame = docs(spark, rows)
    stats = spark.createDataFrame([("a", 10, 3.0, 10, 0.0)], "s string, source_size long, target double, weighed long, left double")
    sid = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.md5("text"))
    named = frame.select("source", sid.alias("sid"), F.lit(1).alias("w"), F.lit(1).alias("size"))
    buckets = mixing._ranked(named, stats, MixParams()).groupBy("bucket").count()
    assert buckets.agg(F.max("count")).first()[0] < 20
    for words, target in taken(mixing.mix(frame, MixParams(share=0.5))).values():
        assert abs(words - target) <= 9000 / 2


def test_equal_rows_are_counted(spark):
    rows = [(5, "a", "w w w", "c", 1)] * 2000 + [(i, "a", "w " * (1 + i % 5), "c", 1) for i in range(50)]
    mixed = mixing.mix(docs(spark, rows), MixParams(share=0.5))
    (words, target), = taken(mixed).values()
    assert mixed.count() == 2050 and abs(words - target) <= 2.5
    assert mixed.selectExpr("row.*").exceptAll(docs(spark, rows)).count() == 0
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [s" in plan and "count(1)" in plan


def test_whole_copies_and_no_weight_give_no_further_copy(spark):
    rows = [(i, "a", "w w", "c", i % 2) for i in range(400)] + [(900, "a", "", "c", 0)]
    once = mixing.mix(docs(spark, rows), MixParams(share=1.0)).selectExpr("copies").collect()
    assert {r["copies"] for r in once} == {1}
    tilted = mixing.mix(docs(spark, rows), MixParams(share=1.2), weight=F.col("q")).selectExpr("row.q as q", "copies").collect()
    assert {r["copies"] for r in tilted if r["q"] == 0} == {0}
    assert {r["copies"] for r in tilted if r["q"] == 1} == {2}


def test_rows_without_texts_are_derived_once(spark, tmp_path):
    rows = many(5) + [(None, None, None, "c", 1), (None, "a", "", "c", 1), (5, "a", "x y", "c", None), (5, "a", "x y", "c", None)]
    docs(spark, rows).write.parquet(str(tmp_path / "docs"))
    read = spark.read.parquet(str(tmp_path / "docs"))
    digest = F.md5(F.coalesce("text", F.lit(""))).alias("digest")
    size = mixing.word_count(F.col("text")).alias("size")
    sized = mixing.mix(read.select("doc_id", "source", size, digest), size=F.col("size"), salt=F.col("digest"))
    assert not [f for f in sized.inputFiles() if str(tmp_path) in f]
    assert "regexp" not in sized._jdf.queryExecution().optimizedPlan().toString()
    whole = mixing.mix(read)
    out = ["size", "source_size", "target", "copies"]
    left, right = (m.selectExpr("row.doc_id", "row.source", *out) for m in (sized, whole))
    assert left.count() == len(rows)
    assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0

from __future__ import annotations

import math

import numpy as np
import pytest
from pubwatch.llm import prefix_forest
from pubwatch.llm.prefix_forest import BITS, Forest, ForestParams
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm.test_queries import SF, rows as table_rows
from tests.llm.test_search import vectors


def brute(rows, asks, k):
    """query -> [(score, id)], nearest first."""
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    ok = [(i, v) for i, v in ok if any(v)]
    out = {}
    for q in {i for i, _ in ok if asks(i)}:
        a = min(v for i, v in ok if i == q)
        scores = []
        for i, b in ok:
            if i != q:
                total = 0.0
                for x, y in zip(a, b, strict=False):
                    total += x * y
                scores.append((-total, i))
        out[q] = sorted(set(scores))[:k]
    return out


def search(spark, rows, params=ForestParams(), step=5, kind="double"):
    data = spark.createDataFrame([(i, v, 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, score int")
    found = prefix_forest.search(data, F.col("vec_id") % step == 0, params)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    out = {}
    for r in sorted(found.collect()):
        own = out.setdefault(r["query_id"], [])
        own.append((-r["score"], r["vec_id"]))
        assert r["rank"] == len(own)
    return out


def recall(found, want):
    return sum(len(set(found.get(q, ())) & set(near)) for q, near in want.items()) / sum(map(len, want.values()))


SMALL = ForestParams(k=10, trees=6, sample=300, probes=60, leaf=40, query_block=7)


@pytest.mark.parametrize("params", [ForestParams(k=10), SMALL])
def test_recall_and_scores(spark, params):
    rows = vectors(900, 12, 3, clusters=30)
    want = brute(rows, lambda i: i % 5 == 0, 10)
    found = search(spark, rows, params)
    assert found.keys() == want.keys()
    assert all(len(near) == 10 and near == sorted(near) for near in found.values())
    assert recall(found, want) >= 0.9
    lengths = dict(rows)
    for q, near in found.items():
        for score, i in near:
            assert -score == np.cumsum(np.multiply(lengths[q], lengths[i]))[-1]


def test_lengths_differ_by_far(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in p * s]) for i, (p, s) in enumerate(zip(rng.normal(size=(700, 6)), rng.lognormal(0, 1.5, 700), strict=True))]
    assert recall(search(spark, rows, SMALL), brute(rows, lambda i: i % 5 == 0, 10)) >= 0.9


def test_copies_of_a_query_are_its_neighbours(spark):
    rows = [(i, [1.0, 0.5, 0.25]) for i in range(400)] + [(400 + i, [0.5, i / 100, 1.0]) for i in range(200)]
    found, want = search(spark, rows, SMALL), brute(rows, lambda i: i % 5 == 0, 10)
    assert all(found[q] == want[q] for q in range(0, 400, 5))


def test_odd_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]), (5, [0.5]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]),
        (4, [None, 1.0]), (None, [1.0, 1.0]), (6, [3.0]), (7, []), (8, [0.0, 0.0]), (10, [1e9, -1e9, 1.0]), (15, [-1.0]),
    ]
    assert search(spark, rows) == brute(rows, lambda i: i % 5 == 0, 20)
    assert search(spark, []) == {}
    assert search(spark, [(5, [1.0])]) == {}
    assert search(spark, [(1, [1.0]), (2, [1.0])]) == {}


def test_floats_are_scored_as_doubles(spark):
    rows = [(i, [float(x) for x in np.float32(p)]) for i, p in vectors(60, 5, 2)]
    assert search(spark, rows, kind="float") == brute(rows, lambda i: i % 5 == 0, 20)


def test_query_recall(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in table_rows("embeddings")]
    found = {}
    for r in entry.queries()["op13_nearest_neighbours"](spark, SF).collect():
        found.setdefault(r["query_id"], set()).add((-r["score"], r["vec_id"]))
    assert recall(found, brute(rows, lambda i: i % 20 == 0, 20)) >= 0.9


def test_prefixes_and_totals():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(500, 5))
    forest = Forest(5, float(np.linalg.norm(points, axis=1).max()), ForestParams(trees=3))
    forest.fit(points[:200], 500, 30)
    data, asked = forest.strings(points), forest.strings(points[:40], asks=True)
    sizes = [np.bincount(forest.leaves(t, data[:, t]), minlength=len(forest.lows[t])) for t in range(3)]
    assert all(len(s) > 5 and s.sum() == 500 for s in sizes)
    deep = np.zeros((40, BITS + 1), np.int64)
    for t in range(3):
        mine, theirs = forest.leaves(t, asked[:, t]), forest.leaves(t, data[:, t])
        for leaf in np.unique(mine):
            rows = np.flatnonzero(mine == leaf)
            for length, counts in prefix_forest._descend(forest, leaf, data[theirs == leaf, t], asked[rows, t], t):
                deep[rows, length] += counts
    totals = prefix_forest._totals(forest, sizes, asked, deep)
    for q in range(40):
        for length in range(BITS + 1):
            same = prefix_forest.shared_prefix(asked[q][None, :], data) >= length
            assert totals[q, length] == same.sum()
    level = prefix_forest.levels(totals, 60)
    assert all(totals[q, x] >= 60 > totals[q, x + 1] for q, x in enumerate(level))
    assert list(prefix_forest.levels(totals, 10_000)) == [0] * 40

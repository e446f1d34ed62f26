from __future__ import annotations

import math

import numpy as np
import pytest
from pubwatch.llm import cover_tree
from pubwatch.llm.cover_tree import SearchParams
from pyspark.sql import functions as F


def brute(rows, asks, k, scale=1024):
    ok = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, [math.floor(scale * x) for x in v]))
    out = []
    for q, a in {q: a for q, a in ok if asks(q)}.items():
        scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def vectors(n, width, seed, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    points = centres[rng.integers(clusters, size=n)] + rng.normal(size=(n, width)) * 0.3
    points[n // 2 : n // 2 + n // 5] = points[0]
    return [(i, [float(x) for x in p]) for i, p in enumerate(points)]


def run(spark, rows, params=SearchParams(), step=7):
    data = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    found = cover_tree.search(data, F.col("vec_id") % step == 0, params)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize(
    "params", [SearchParams(), SearchParams(cells=5, block=40, query_block=9, leaf=4, fanout=3, sample=30)]
)
def test_equals_brute_force(spark, params):
    rows = vectors(600, 8, 1)
    assert run(spark, rows, params) == brute(rows, lambda i: i % 7 == 0, 10)


def test_odd_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]),
        (None, [1.0, 1.0]), (5, [3.0]), (6, []), (14, [1e9, -1e9]),
    ]
    assert run(spark, rows) == brute(rows, lambda i: i % 7 == 0, 10)
    assert run(spark, []) == []
    assert run(spark, [(7, [1.0])]) == []


def test_bounds_hold_for_all_pairs():
    rng = np.random.default_rng(5)
    points, queries = rng.normal(size=(400, 6)), rng.normal(size=(50, 6))
    root, asked = cover_tree.Node.root(points, 8, 4), cover_tree.Node.root(queries, 8, 4)
    seen, todo = [], [root]
    while todo:
        node = todo.pop()
        assert (queries @ points[node.rows].T).max() <= asked.bounds([node])[0]
        assert np.linalg.norm(points[node.rows] - node.centre, axis=1).max() <= node.radius
        todo += node.children
        seen += [] if node.children else node.rows.tolist()
    assert sorted(seen) == list(range(400))


@pytest.mark.parametrize("query_blocks", [3, 10**6])
def test_rows_go_only_to_query_blocks_routed_to_their_cell(spark, query_blocks):
    placed = spark.createDataFrame([(i, [i], i % 4) for i in range(40)], "id long, v array<bigint>, cell int")
    routed = spark.createDataFrame([(0, 2), (0, 2), (1, 0), (1, 1)], "cell int, query_block int")
    spread = cover_tree.spread_rows(placed, routed, {0: 3, 1: 1, 2: 1, 3: 1}, query_blocks).collect()
    met = sorted((r["id"], r["query_block"]) for r in spread)
    assert met == sorted([(i, 2) for i in range(0, 40, 4)] + [(i, b) for i in range(1, 40, 4) for b in (0, 1)])
    assert all(0 <= r["block"] < 3 if r["cell"] == 0 else r["block"] == 0 for r in spread)


@pytest.mark.parametrize("width,fanout", [(2, 1000), (2, 4), (30, 12)])
def test_levels_nest_cover_and_separate(width, fanout):
    rng = np.random.default_rng(width + fanout)
    points = rng.normal(size=(700, width))
    points[100:180] = points[0]
    todo, halved = [cover_tree.Node.root(points, 6, fanout)], 0
    while todo:
        node = todo.pop()
        assert (points[node.rows] == node.centre).all(1).any()
        if not node.children:
            assert len(node.rows) <= 6 or node.radius == 0
            continue
        centres = np.stack([c.centre for c in node.children])
        assert (centres[0] == node.centre).all()
        assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
        for child in node.children:
            assert child.radius <= node.reach * (1 + 1e-6)
        apart = np.linalg.norm(centres[:, None] - centres[None], axis=-1)
        assert (apart[np.triu_indices(len(centres), 1)] >= node.reach * (1 - 1e-9)).all()
        halved += node.reach <= node.radius / 2
        assert node.reach <= node.radius / 2 or len(centres) == fanout
        todo += node.children
    assert halved or width > 2


def test_scores_are_held_in_slices():
    rng = np.random.default_rng(2)
    queries, points = rng.integers(-9, 9, (40, 3)), rng.integers(-9, 9, (70, 3))
    found = []
    for held in (1, 500, 1 << 20):
        top = cover_tree.TopK(queries, np.arange(40), np.full(40, -np.inf), 5, held)
        top.add(np.arange(40), points, np.arange(100, 170))
        found.append((top.scores.tolist(), top.found.tolist(), top.floors.tolist()))
    assert found[0] == found[1] == found[2]


def test_cells_grow_with_the_table(spark):
    params = SearchParams(cells=2, block=20, sample=50, leaf=4, query_block=9)
    assert [params.top_cells(n) for n in (0, 40, 600, 10**9)] == [2, 2, 30, 50]
    rows = vectors(600, 5, 3)
    assert run(spark, rows, params) == brute(rows, lambda i: i % 7 == 0, 10)


def test_scores_below_the_floor_are_not_sorted_in():
    queries, points = np.array([[1.0, 0.0], [0.0, 1.0]]), np.array([[5.0, 1.0], [5.0, 3.0], [2.0, 9.0], [5.0, 1.0]])
    top = cover_tree.TopK(queries, np.array([100, 7]), np.array([5.0, -np.inf]), 2, 1 << 10)
    top.add(np.arange(2), points, np.array([8, 7, 6, 3]))
    top.add(np.arange(1), points[2:3], np.array([1]))
    assert top.scores[0].tolist() == [5, 5] and top.found[0].tolist() == [3, 7]
    assert top.scores[1].tolist() == [9, 1] and top.found[1].tolist() == [6, 3]
    high = cover_tree.TopK(queries, np.array([100, 7]), np.array([6.0, 10.0]), 2, 1 << 10)
    high.add(np.arange(2), points, np.array([8, 7, 6, 3]))
    assert (high.scores == np.iinfo(np.int64).min).all()


def test_leaves_are_scored_together(monkeypatch):
    pick, params = np.random.default_rng(5), cover_tree.SearchParams(k=4, leaf=4, fanout=6)
    points = np.concatenate([pick.integers(-9, 9, (600, 5)), np.zeros((30, 5), dtype=int), np.full((20, 5), 3)])
    ids = np.concatenate([np.arange(600), np.arange(50) // 2])
    queries, calls = pick.integers(-9, 9, (90, 5)), []
    add = cover_tree.TopK.add
    monkeypatch.setattr(cover_tree.TopK, "add", lambda self, rows, *a: calls.append(len(rows)) or add(self, rows, *a))
    top = cover_tree.TopK(queries, np.arange(90), np.full(90, -np.inf), params.k, 1 << 10)
    cover_tree.dual_search(top, points, ids, params)
    for i, q in enumerate(queries):
        best = sorted((-int(p @ q), int(x)) for p, x in zip(points, ids, strict=True) if x != i)[: params.k]
        assert [(-s, x) for s, x in zip(top.scores[i].tolist(), top.found[i].tolist(), strict=True)] == best
    assert sum(calls) < 90 * len(points) / params.leaf / 3

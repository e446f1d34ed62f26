"""Exact top-k inner-product search by dual-tree traversal of cover trees.

Centres from a bounded sample are the top level of the tree: every row joins the cell of its nearest
centre, and large cells are split into blocks. There are as many cells as the table fills blocks, up to
the size of the sample. Each block is a cover tree, and the queries lie in cover trees of their own. A pair
of nodes is dropped when no inner product between them can reach the worst k-th score of the query group:

    <q, x>  <=  <cq, cx> + rq * |cx| + rx * |cq| + rq * rx

with covering radii rq, rx around centres cq, cx. The bound holds for every pair, so results are
exact whatever the sample was; the sample only decides how much is pruned. Whole cells are dropped
before anything is shuffled to them, inside a block the same test walks down both trees.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubwatch.llm.common import materialise

SLACK = 1e-9  # relative, for rounding in bounds
WANTED = 1_000_000  # pairs of cell and query block that are broadcast


@dataclass(frozen=True)
class SearchParams:
    """``sample`` rows at most fit ``cells`` centres or more; blocks and leaves bound the work of a task."""

    k: int = 10
    scale: int = 1024
    sample: int = 4096
    cells: int = 64
    block: int = 8192
    query_block: int = 2048
    leaf: int = 64
    fanout: int = 12
    scores: int = 1 << 21  # held at a time

    def top_cells(self, rows: int) -> int:
        """Cells of about a block each for a table of ``rows``."""
        return min(max(self.cells, -(-rows // self.block)), max(self.cells, self.sample))


def quantise(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """Neither NULL nor holding a NULL, a NaN or an infinity."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")),
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def matrix(vectors: list, width: int = 0) -> np.ndarray:
    """Rows of whole numbers; short vectors are padded with zeros."""
    width = max([width, *map(len, vectors)])
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def exact_type(*tables: np.ndarray) -> type:
    """Doubles where every inner product is exact in them, else whole numbers."""
    most = [float(np.abs(t).max(initial=0)) for t in tables]
    width = tables[0].shape[1]
    return np.float64 if max(most) ** 2 * max(width, 1) < 2**52 else np.int64


class Node:
    """A node of a cover tree: points within ``radius`` of ``centre``, which is one of them.

    The children's centres are the node's own (nesting) and the points farthest from those taken before,
    until all lie within ``reach`` of their nearest centre (covering). Two centres are then at least
    ``reach`` apart (separation). ``reach`` is half the radius, or what ``fanout`` centres leave of it, as in
    many dimensions halving takes nearly as many centres as there are points.
    """

    __slots__ = ("centre", "norm", "radius", "reach", "rows", "children")

    def __init__(self, points: np.ndarray, rows: np.ndarray, first: int, leaf: int, fanout: int) -> None:
        own = points[rows]
        self.centre = own[first]
        self.norm = float(np.sqrt(self.centre @ self.centre))
        gap = np.sqrt(((own - self.centre) ** 2).sum(1))
        self.radius = float(gap.max(initial=0.0)) * (1 + SLACK)
        self.rows, self.children, self.reach = rows, [], 0.0
        if len(rows) <= leaf or self.radius == 0:
            return
        pivots, nearest, owner = [first], gap, np.zeros(len(rows), dtype=int)
        while len(pivots) < fanout:
            far = int(nearest.argmax())
            if nearest[far] <= self.radius / 2:
                break
            pivots.append(far)
            gap = np.sqrt(((own - own[far]) ** 2).sum(1))
            closer = gap < nearest
            nearest[closer], owner[closer] = gap[closer], len(pivots) - 1
        self.reach = float(nearest.max())
        for i, pivot in enumerate(pivots):
            mine = np.nonzero(owner == i)[0]
            self.children.append(Node(points, rows[mine], int(np.searchsorted(mine, pivot)), leaf, fanout))

    @classmethod
    def root(cls, points: np.ndarray, leaf: int, fanout: int) -> Node:
        """The tree of all rows of ``points``, around the one next to their mean."""
        first = int(((points - points.mean(0)) ** 2).sum(1).argmin())
        return cls(points, np.arange(len(points)), first, leaf, fanout)

    def bounds(self, others: list[Node]) -> np.ndarray:
        centres = np.stack([o.centre for o in others])
        norms = np.array([o.norm for o in others])
        radii = np.array([o.radius for o in others])
        most = centres @ self.centre + self.radius * norms + radii * self.norm + self.radius * radii
        return most + SLACK * (1 + np.abs(most))


class TopK:
    """The best scores per query so far, and a floor that the k-th score is known to reach."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, floors: np.ndarray, k: int, held: int) -> None:
        self.queries, self.ids, self.k, self.held = queries, ids, k, held
        self.floors = floors.astype(float)
        self.scores = np.full((len(ids), k), np.iinfo(np.int64).min, dtype=np.int64)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max, dtype=np.int64)

    def worst(self, rows: np.ndarray) -> float:
        return float(self.floors[rows].min())

    def add(self, rows: np.ndarray, points: np.ndarray, ids: np.ndarray) -> None:
        """Score ``points`` for the queries in ``rows``, at most ``held`` scores at a time."""
        step = max(1, self.held // max(1, len(ids)))
        for at in range(0, len(rows), step):
            self._add(rows[at : at + step], points, ids)

    def _add(self, rows: np.ndarray, points: np.ndarray, ids: np.ndarray) -> None:
        scores = (self.queries[rows] @ points.T).astype(np.int64)
        # scores below the floor are never among the k best; most nodes hold no other, and need no sort
        floors = self.floors[rows]
        may = scores >= (floors - SLACK * (1 + np.abs(floors)))[:, None]
        some, near = may.any(1), may.any(0)
        if not some.any():
            return
        if not may.all():
            rows, ids, scores = rows[some], ids[near], scores[np.ix_(some, near)]
        none = np.iinfo(np.int64).min
        scores = np.where(ids[None, :] == self.ids[rows][:, None], none, scores)
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        found = np.concatenate([self.found[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        found = np.where(scores == none, np.iinfo(np.int64).max, found)
        order = np.lexsort((found, -np.maximum(scores, none + 1)), axis=-1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, order, 1)
        self.found[rows] = np.take_along_axis(found, order, 1)
        kth = self.scores[rows, -1]
        self.floors[rows] = np.where(kth > none, np.maximum(self.floors[rows], kth), self.floors[rows])


def dual_search(top: TopK, points: np.ndarray, ids: np.ndarray, params: SearchParams) -> None:
    """Walk a query tree against a data tree, nearest pairs first; up to ``fanout`` leaves are scored at once."""
    shape = (params.leaf, params.fanout)
    kind = exact_type(top.queries, points)
    exact, top.queries = points.astype(kind), top.queries.astype(kind)
    queries, data = top.queries.astype(float), points.astype(float)
    q_root, d_root = Node.root(queries, *shape), Node.root(data, *shape)

    def visit(q: Node, nodes: list[Node]) -> None:
        bounds = q.bounds(nodes)
        order = np.argsort(-bounds, kind="stable")
        if q.children:
            worst = top.worst(q.rows)
            near = [nodes[i] for i in order if bounds[i] >= worst]
            lower = [child for d in near for child in d.children or [d]]
            for child in q.children if lower else []:
                visit(child, lower)
            return
        leaves: list[Node] = []

        def score() -> None:
            if leaves:
                found = np.concatenate([d.rows for d in leaves])
                top.add(q.rows, exact[found], ids[found])
                leaves.clear()

        for i in order:
            if bounds[i] < top.worst(q.rows):
                break
            if nodes[i].children:
                visit(q, nodes[i].children)
            else:
                leaves.append(nodes[i])
            if len(leaves) == params.fanout:
                score()
        score()

    visit(q_root, [d_root])


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    square = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)
    cell = square.argmin(1)
    return cell, np.sqrt(((points - centres[cell]) ** 2).sum(1))


def spread_rows(placed: DataFrame, routed: DataFrame, blocks: dict[int, int], query_blocks: int) -> DataFrame:
    """id, v, cell, block, query_block: each data row for the query blocks that routing sent to its cell."""
    wanted = routed.select("cell", F.col("query_block").alias("to")).distinct()
    if len(blocks) * query_blocks <= WANTED:
        wanted = F.broadcast(wanted)
    # at most `sample` rows
    parts = F.broadcast(placed.sparkSession.createDataFrame(list(blocks.items()), "cell int, parts int"))
    block = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("block")
    met = placed.join(parts, "cell").join(wanted, "cell")
    return met.select("id", "v", "cell", block, F.col("to").alias("query_block"))


def search(
    data: DataFrame,
    is_query: Column,
    params: SearchParams = SearchParams(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), id_col, score: the k best rows for each row where ``is_query``.

    The score is the inner product of the quantised vectors; ties go to the smaller id. Rows that
    bear the query's own id are no candidates.

    * A NULL id, or a vector that is NULL or holds a NULL, a NaN or an infinity, takes no part.
    * Vectors of different length count as padded with zeros.
    * Scores are 64-bit sums; scaled components have to be small enough for these not to overflow.
    * Repeated candidate rows count one by one; of repeated query ids one row asks.
    * With fewer than k candidates all are returned; an empty table gives an empty result.
    * Other columns are not read. The fit looks at ``sample`` rows, the search at every row.
    """
    spark, k = data.sparkSession, params.k
    out = f"query_id bigint, rank int, {id_col} bigint, score bigint"
    rows = data.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"),
        quantise(F.col(vector_col), params.scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(params.sample).select("id", "v").collect()
    if not sample:
        return spark.createDataFrame([], out)
    fit_ids = np.array([r["id"] for r in sample], dtype=np.int64)
    fit = matrix([r["v"] for r in sample])
    width = fit.shape[1]
    pivots, gap = [0], np.full(len(fit), np.inf)
    most_cells = params.top_cells(data.count())
    while len(pivots) < most_cells:
        gap = np.minimum(gap, ((fit - fit[pivots[-1]]) ** 2).sum(1).astype(float))
        if gap.max() == 0:
            break
        pivots.append(int(gap.argmax()))
    centres = fit[pivots].astype(float)

    def place(batches):
        for frame in batches:
            points = matrix(list(frame["v"]), width)
            cell, away = _nearest_padded(points, centres)
            yield frame.assign(cell=cell.astype("int32"), away=away)

    placed = materialise(
        rows.mapInPandas(place, "id bigint, v array<bigint>, asks boolean, cell int, away double"), "search-rows"
    )
    # at most `sample` rows
    cells = placed.groupBy("cell").agg(
        F.max("away").alias("radius"),
        F.ceil(F.count("*") / params.block).cast("int").alias("blocks"),
    )
    known = cells.collect()
    cell_ids = np.array([c["cell"] for c in known], dtype=np.int32)
    radii = np.array([c["radius"] for c in known]) * (1 + SLACK)
    blocks = {c["cell"]: c["blocks"] for c in known}
    asked = placed.where("asks").dropDuplicates(["id"]).select("id", "v")
    query_blocks = max(1, -(-asked.count() // params.query_block))

    def route(batches):
        """Copies of each query for the cells that can hold one of its k best."""
        for frame in batches:
            if frame.empty:
                continue
            points = matrix(list(frame["v"]), width)
            ids = frame["id"].to_numpy()
            kind = exact_type(*_same_width(points, fit))
            a, b = _same_width(points, fit)
            top = TopK(a.astype(kind), ids, np.full(len(ids), -np.inf), k, params.scores)
            top.add(np.arange(len(ids)), b.astype(kind), fit_ids)
            a, c = _same_width(points.astype(float), centres)
            c = c[cell_ids]
            norm = np.sqrt((a**2).sum(1))
            most = a @ c.T + norm[:, None] * radii
            most += SLACK * (1 + np.abs(most))
            q, d = np.nonzero(most >= top.floors[:, None])
            block_lists = [list(range(blocks[int(cell_ids[i])])) for i in d]
            yield pd.DataFrame(
                {
                    "query_id": ids[q],
                    "q": frame["v"].to_numpy()[q],
                    "floor": top.floors[q],
                    "cell": cell_ids[d],
                    "block": block_lists,
                }
            )

    query_block = F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int")
    routed = materialise(
        asked.mapInPandas(route, "query_id bigint, q array<bigint>, floor double, cell int, block array<int>")
        .withColumn("block", F.explode("block"))
        .withColumn("query_block", query_block),
        "search-routes",
    )
    spread = spread_rows(placed, routed, blocks, query_blocks)

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], id_col: [], "score": []}).astype("int64")
        queries, points = _same_width(matrix(list(left["q"])), matrix(list(right["v"])))
        ids = left["query_id"].to_numpy()
        top = TopK(queries, ids, left["floor"].to_numpy(), k, params.scores)
        dual_search(top, points, right["id"].to_numpy(), params)
        q, place = np.nonzero(top.scores > np.iinfo(np.int64).min)
        return pd.DataFrame({"query_id": ids[q], id_col: top.found[q, place], "score": top.scores[q, place]})

    keys = ["cell", "block", "query_block"]
    partial = (
        routed.groupBy(*keys)
        .cogroup(spread.groupBy(*keys))
        .applyInPandas(work, f"query_id bigint, {id_col} bigint, score bigint")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(id_col))
    ranked = partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", id_col, "score")


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(t, ((0, 0), (0, width - t.shape[1]))) for t in (a, b))


def _nearest_padded(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _nearest(*_same_width(points.astype(float), centres))

"""Approximate nearest neighbours by a forest of sorted hash strings.

Every tree gives a vector a string of 64 bits: on which side of 64 random hyperplanes it lies. A tree
is the array of its strings in order, cut into leaves of adjacent strings by a trie whose shape comes
from a sample; leaves that turn out too large are dealt to several tasks.

* Descending: in each tree a query is sent to the one leaf that its own string falls into, where a
  search in the sorted strings tells how many of them share each longer prefix with it. Shorter
  prefixes are whole leaves, whose sizes are known.
* Ascending: all trees of a query give up one bit after the other together, until the rows that
  share a prefix of that length in some tree are ``enough``. How many are enough is measured: the
  true neighbours of a sample of queries, found by a scan of all rows, and the least number that
  reaches ``recall`` of them.
* The rows of these prefixes are read in the leaves by two searches per query and scored exactly;
  a leaf returns the k best per query. No candidate is dropped, whatever their number.

Inner products are turned into angles: vectors are divided by the largest norm, and one more
component makes each a unit vector. Equal vectors are one point with its smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubwatch.llm.common import materialise
from pubwatch.llm.cover_tree import usable

BITS = 64
TIE = 1e-9  # relative; scores within it are worked out again before they are ranked


@dataclass(frozen=True)
class ForestParams:
    """``sample`` vectors at most shape the trees, ``probes`` queries at most measure recall.

    ``leaf`` rows are aimed at per leaf and task, ``query_block`` queries at most meet them at once.
    """

    k: int = 20
    trees: int = 8
    recall: float = 0.95
    sample: int = 8192
    probes: int = 128
    leaf: int = 8192
    query_block: int = 2048
    seed: int = 13


class Forest:
    """Random hyperplanes per tree, shifted to the medians of a sample, and the trie of each tree."""

    def __init__(self, width: int, largest: float, params: ForestParams) -> None:
        self.width, self.largest, self.trees = width, largest, params.trees
        random = np.random.default_rng(params.seed)
        self.planes = random.normal(size=(width + 1, params.trees * BITS))
        self.shifts = np.zeros(params.trees * BITS)
        #: per tree the first string of each leaf and the length of its prefix
        self.lows: list[np.ndarray] = []
        self.depths: list[np.ndarray] = []

    def unit(self, points: np.ndarray, asks: bool) -> np.ndarray:
        """Points of the unit sphere whose angles order inner products of queries and data."""
        scaled = points / self.largest
        square = (scaled**2).sum(1)
        if asks:
            return np.column_stack([scaled / np.sqrt(np.maximum(square, 1e-300))[:, None], np.zeros(len(points))])
        return np.column_stack([scaled, np.sqrt(np.maximum(0, 1 - square))])

    def strings(self, points: np.ndarray, asks: bool = False) -> np.ndarray:
        """One row of 64-bit strings per point, one column per tree."""
        out = np.zeros((len(points), self.trees), np.uint64)
        for at in range(0, len(points), 4096):
            sides = self.unit(points[at : at + 4096], asks) @ self.planes > self.shifts
            packed = np.packbits(sides.reshape(-1, BITS), axis=1, bitorder="big")
            out[at : at + 4096] = packed.view(">u8").reshape(-1, self.trees)
        return out

    def fit(self, sample: np.ndarray, rows: int, leaf: int) -> None:
        """Shift the planes so that the sample lies on both sides of each, then split up large leaves."""
        self.shifts = np.median(self.unit(sample, False) @ self.planes, axis=0)
        most = max(1.0, leaf * len(sample) / max(rows, 1))
        for strings in self.strings(sample).T:
            lows, depths, todo = [], [], [(0, 0, np.sort(strings))]
            while todo:
                low, depth, inside = todo.pop()
                if len(inside) <= most or depth == BITS:
                    lows.append(low)
                    depths.append(depth)
                    continue
                half = low | 1 << (BITS - 1 - depth)
                cut = np.searchsorted(inside, np.uint64(half))
                todo += [(half, depth + 1, inside[cut:]), (low, depth + 1, inside[:cut])]
            self.lows.append(np.array(lows, np.uint64))
            self.depths.append(np.array(depths, np.int64))

    def leaves(self, tree: int, strings: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows[tree], strings, side="right") - 1


def interval(strings: np.ndarray, length: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last string that share a prefix of ``length`` bits."""
    shift = (BITS - np.asarray(length)).astype(np.uint64)
    none = shift == BITS
    free = np.where(none, np.uint64((1 << 64) - 1), (np.uint64(1) << (shift % np.uint64(BITS))) - np.uint64(1))
    return strings & ~free, strings | free


def shared_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that two strings have in common at their start."""
    left = a ^ b
    for step in (1, 2, 4, 8, 16, 32):
        left = left | left >> np.uint64(step)
    return BITS - np.bitwise_count(left).astype(np.int64)


def dense(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of doubles; short vectors are padded with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = np.asarray(vectors.flatten(), dtype=np.float64)
    sizes = np.diff(np.asarray(vectors.offsets))
    if (sizes == width).all():
        return flat.reshape(len(vectors), width)
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def exact_scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, summed up from left to right, so that equal pairs score alike."""
    with np.errstate(over="ignore", invalid="ignore"):
        sums = np.cumsum(queries * points, axis=1)[:, -1]
    return np.where(np.isnan(sums), -np.inf, sums)


def best_pairs(
    queries: np.ndarray, points: np.ndarray, first_ids: np.ndarray, room: int, largest: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of the ``room`` best points per query and their exact scores; ties by smallest id."""
    norms = np.sqrt(((queries / largest) ** 2).sum(1))
    rough = (queries / largest / np.maximum(norms, 1e-300)[:, None]) @ (points / largest).T
    if len(points) > room:
        least = np.partition(rough, len(points) - room, axis=1)[:, len(points) - room]
        asked, row = np.nonzero(rough >= least[:, None] - TIE)
    else:
        asked, row = (x.ravel() for x in np.indices(rough.shape))
    scores = exact_scores(queries[asked], points[row])
    order = np.lexsort((first_ids[row], -scores, asked))
    asked, row, scores = asked[order], row[order], scores[order]
    place = np.arange(len(asked)) - np.searchsorted(asked, asked)
    return asked[place < room], row[place < room], scores[place < room]


def _points(rows: DataFrame, room: int) -> DataFrame:
    """ids, v: every distinct vector with its ``room`` smallest ids. Only vectors that repeat are moved."""
    hashed = rows.select("id", "v", F.xxhash64("v").alias("hash"))
    twice = materialise(
        hashed.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "forest-copies"
    )
    single = hashed.join(twice, "hash", "left_anti").select(F.array("id").alias("ids"), "v")
    again = hashed.join(twice, "hash", "left_semi").groupBy("v", "id").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    again = again.withColumn("place", place).where(F.col("place") <= room)
    merged = again.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return single.unionByName(merged)


def _descend(forest: Forest, leaf: np.ndarray, data: np.ndarray, asked: np.ndarray, tree: int):
    """Per query and prefix longer than the leaf's: how many of the leaf's strings share it."""
    data = np.sort(data)
    for length in range(int(forest.depths[tree][leaf]) + 1, BITS + 1):
        low, high = interval(asked, length)
        counts = np.searchsorted(data, high, side="right") - np.searchsorted(data, low)
        if not counts.any():
            return
        yield length, counts


def _totals(forest: Forest, sizes: list[np.ndarray], strings: np.ndarray, deep: np.ndarray) -> np.ndarray:
    """Per query and prefix length 0 to 65 the rows that share it, summed up over the trees.

    ``deep`` has the counts from inside the leaves; shorter prefixes are runs of whole leaves.
    """
    totals = np.zeros((len(strings), BITS + 2), np.int64)
    totals[:, : BITS + 1] = deep
    for tree in range(forest.trees):
        upto = np.append(0, np.cumsum(sizes[tree]))
        own = strings[:, tree]
        depth = forest.depths[tree][forest.leaves(tree, own)]
        for length in range(int(depth.max(initial=-1)) + 1):
            low, high = interval(own, length)
            whole = upto[forest.leaves(tree, high) + 1] - upto[forest.leaves(tree, low)]
            totals[:, length] += np.where(length <= depth, whole, 0)
    return totals


def levels(totals: np.ndarray, enough: int) -> np.ndarray:
    """The longest prefix at which enough rows share it; 0 if there are never enough."""
    reached = totals[:, : BITS + 1] >= enough
    return np.where(reached.any(1), BITS - reached[:, ::-1].argmax(1), 0)


def search(
    data: DataFrame,
    is_query: Column,
    params: ForestParams = ForestParams(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), id_col, score: the nearest rows found for each row where ``is_query``.

    Nearest is the largest inner product, in doubles, summed up from left to right; ties go to the
    smaller id. Rows that bear the query's own id are no candidates. About ``recall`` of the k
    nearest are found, as measured on up to ``probes`` queries; every row is indexed.

    * A NULL id, or a vector that is NULL, zero, or holds a NULL, a NaN or an infinity, takes no part.
    * Vectors of different length count as padded with zeros.
    * Rows that repeat an id count once per score; of repeated query ids the least vector asks.
    * With k candidates or fewer all are returned; an empty table gives an empty result.
    * A score beyond the range of doubles is infinite, one that is then undefined minus infinity.
    * Other columns are not read. The fit looks at ``sample`` rows, the search at all.
    """
    spark, k, room = data.sparkSession, params.k, params.k + 1
    vector = F.col(vector_col)
    rows = data.where(F.col(id_col).isNotNull() & usable(vector) & F.exists(vector, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("id"), vector.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    points = materialise(_points(rows, room), "forest-points")
    queries = materialise(rows.where("asks").groupBy("id").agg(F.min("v").alias("v")), "forest-queries")
    most = F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))).cast("double"))
    n, width, most = points.agg(F.count("*"), F.max(F.size("v")), most).first()
    asks = queries.count()
    if not n or not asks:
        return spark.createDataFrame([], f"query_id bigint, rank int, {id_col} bigint, score double")
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + (x / most) * (x / most))
    largest = min(1e308, most * points.agg(F.max(F.sqrt(square))).first()[0])

    forest = Forest(width, largest, params)
    sample = points.orderBy(F.xxhash64("ids"), "ids").limit(params.sample).select("v").toArrow()
    forest.fit(dense(sample["v"], width), n, params.leaf)

    # Descending
    def hang(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = forest.strings(dense(batch.column(1), width))
            block = _spread(batch.column(0))
            for tree in range(forest.trees):
                leaf = forest.leaves(tree, strings[:, tree])
                yield _columns(tree=np.full(len(leaf), tree, np.int32), leaf=leaf.astype(np.int32),
                               block=block, key=strings[:, tree].view(np.int64))

    hung = points.select("ids", "v").mapInArrow(hang, "tree int, leaf int, block bigint, key bigint")
    counted = hung.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect()  # trees x sample at most
    sizes = [np.zeros(len(lows), np.int64) for lows in forest.lows]
    for row in counted:
        sizes[row["tree"]][row["leaf"]] = row["n"]
    blocks = [np.maximum(1, -(-s // params.leaf)) for s in sizes]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, leaf, block = (np.asarray(batch.column(i)) for i in range(3))
            many = np.array([len(b) for b in blocks]).cumsum() - [len(b) for b in blocks]
            block = block % np.concatenate(blocks)[many[tree] + leaf]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(block.astype(np.int32)), batch.column(3)],
                ["tree", "leaf", "block", "key"],
            )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            strings = forest.strings(dense(batch.column(1), width), asks=True)
            for tree in range(forest.trees):
                own = strings[:, tree]
                leaf = forest.leaves(tree, own)
                at, block = _copies(blocks[tree][leaf])
                yield _columns(tree=np.full(len(at), tree, np.int32), leaf=leaf[at].astype(np.int32),
                               block=block, query_id=ids[at], key=own[at].view(np.int64))

    def descend(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        tree, leaf = key[0].as_py(), key[1].as_py()
        strings = [np.asarray(t["key"].combine_chunks()).view(np.uint64) for t in (left, right)]
        ids = np.asarray(left["query_id"].combine_chunks())
        found = [(np.empty(0, np.int64), 0, np.empty(0, np.int64))]
        for length, counts in _descend(forest, leaf, strings[1], strings[0], tree):
            found.append((ids[counts > 0], length, counts[counts > 0]))
        return pa.table({
            "query_id": np.concatenate([f[0] for f in found]),
            "length": np.concatenate([np.full(len(f[0]), f[1], np.int32) for f in found]),
            "n": np.concatenate([f[2] for f in found]).astype(np.int64),
        })

    at = ["tree", "leaf", "block"]
    own_leaf = queries.select("id", "v").mapInArrow(
        ask, "tree int, leaf int, block int, query_id bigint, key bigint"
    )
    in_leaf = hung.mapInArrow(cut, "tree int, leaf int, block int, key bigint")
    shared = own_leaf.groupBy(*at).cogroup(in_leaf.groupBy(*at)).applyInArrow(
        descend, "query_id bigint, length int, n bigint"
    )
    shared = shared.groupBy("query_id", "length").agg(F.sum("n").alias("n")).groupBy("query_id")
    shared = shared.agg(F.collect_list(F.struct("length", "n")).alias("deep"))  # at most BITS pairs
    known = queries.join(shared.withColumnRenamed("query_id", "id"), "id", "left")
    known = materialise(known.select("id", "v", "deep"), "forest-descents")

    def totals_of(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
        strings = forest.strings(dense(batch.column(1), width), asks=True)
        deep = np.zeros((len(strings), BITS + 1), np.int64)
        for row, pairs in zip(deep, batch.column(2).to_pylist(), strict=True):
            for pair in pairs or ():
                row[pair["length"]] = pair["n"]
        return strings, _totals(forest, sizes, strings, deep)

    # How many rows are enough
    probes = known.orderBy(F.xxhash64("id"), "id").limit(params.probes).toArrow()
    enough = _enough(points, forest, params, probes, *totals_of(probes))

    # Ascending
    def ascend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings, totals = totals_of(batch)
            level = levels(totals, enough)
            for tree in range(forest.trees):
                low, high = interval(strings[:, tree], level)
                first, last = forest.leaves(tree, low), forest.leaves(tree, high)
                at, more = _copies(last - first + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), tree, np.int32)),
                        pa.array((first[at] + more).astype(np.int32)),
                        *batch.select([0, 1]).take(pa.array(at)).columns,
                        pa.array(strings[at, tree].view(np.int64)),
                        pa.array(level[at].astype(np.int32)),
                    ],
                    ["tree", "leaf", "query_id", "q", "key", "level"],
                )

    kind = queries.schema["v"].dataType.simpleString()
    route = f"tree int, leaf int, query_id bigint, q {kind}, key bigint, level int"
    routed = known.mapInArrow(ascend, route)
    asking = routed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect()  # trees x sample at most
    query_blocks = [np.zeros(len(lows), np.int64) for lows in forest.lows]
    for row in asking:
        query_blocks[row["tree"]][row["leaf"]] = -(-row["n"] // params.query_block)

    def send_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query to all blocks of its leaf, in one query block."""
        for batch in batches:
            tree, leaf, ids = (np.asarray(batch.column(i)) for i in range(3))
            many = np.array([blocks[t][x] for t, x in zip(tree, leaf, strict=True)], np.int64)
            asked = np.array([query_blocks[t][x] for t, x in zip(tree, leaf, strict=True)], np.int64)
            at, block = _copies(many)
            part = (ids * 0x9E3779B1 >> 7) % np.maximum(asked, 1)
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(block), pa.array(part[at].astype(np.int32))],
                [*taken.schema.names, "block", "part"],
            )

    def send_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector to one block of its leaf in every tree, once per query block that asks there."""
        for batch in batches:
            strings = forest.strings(dense(batch.column(1), width))
            spread = _spread(batch.column(0))
            for tree in range(forest.trees):
                leaf = forest.leaves(tree, strings[:, tree])
                at, part = _copies(query_blocks[tree][leaf])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), tree, np.int32)),
                        pa.array(leaf[at].astype(np.int32)),
                        *batch.take(pa.array(at)).columns,
                        pa.array(strings[at, tree].view(np.int64)),
                        pa.array((spread % blocks[tree][leaf])[at].astype(np.int32)),
                        pa.array(part),
                    ],
                    ["tree", "leaf", "ids", "v", "key", "block", "part"],
                )

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search_leaf(left, right, width, room, largest)

    meet = ["tree", "leaf", "block", "part"]
    asked = routed.mapInArrow(send_queries, f"{route}, block int, part int")
    hung = points.select("ids", "v").mapInArrow(
        send_points, f"tree int, leaf int, ids array<bigint>, v {kind}, key bigint, block int, part int"
    )
    found = asked.groupBy(*meet).cogroup(hung.groupBy(*meet)).applyInArrow(
        work, "query_id bigint, ids array<bigint>, score double"
    )
    found = found.select("query_id", F.explode("ids").alias(id_col), "score").where(F.col(id_col) != F.col("query_id"))
    found = found.select("query_id", id_col, "score").distinct()  # a row may be met in several trees
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(id_col))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", id_col, "score")


def _search_leaf(left: pa.Table, right: pa.Table, width: int, room: int, largest: float) -> pa.Table:
    """The best of the rows of a leaf that share a prefix of each query's length with it."""
    queries, points = dense(left["q"], width), dense(right["v"], width)
    asked, strings = (np.asarray(t["key"].combine_chunks()).view(np.uint64) for t in (left, right))
    order = np.argsort(strings, kind="stable")
    strings, points, owners = strings[order], points[order], right["ids"].combine_chunks().take(pa.array(order))
    first_ids = np.asarray(owners.flatten())[np.asarray(owners.offsets)[:-1]] if len(owners) else np.empty(0, np.int64)
    low, high = interval(asked, np.asarray(left["level"].combine_chunks()))
    runs = np.column_stack([np.searchsorted(strings, low), np.searchsorted(strings, high, side="right")])
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    # queries with the same prefix read the same run of the array
    distinct, which = np.unique(runs, axis=0, return_inverse=True)
    for number, (start, stop) in enumerate(distinct):
        if start == stop:
            continue
        members = np.flatnonzero(which == number)
        step = max(1, (1 << 21) // (stop - start))
        for at in range(0, len(members), step):
            some = members[at : at + step]
            q, row, scores = best_pairs(queries[some], points[start:stop], first_ids[start:stop], room, largest)
            found.append((some[q], row + start, scores))
    asks, rows, scores = (np.concatenate([f[i] for f in found]) for i in range(3))
    return pa.table({
        "query_id": left["query_id"].combine_chunks().take(pa.array(asks)),
        "ids": owners.take(pa.array(rows)),
        "score": scores,
    })


def _enough(
    points: DataFrame, forest: Forest, params: ForestParams, probes: pa.Table, strings: np.ndarray, totals: np.ndarray
) -> int:
    """Rows to be read per query, summed up over the trees, for the recall wanted.

    The true neighbours of the probes come from a scan of all rows. A neighbour that shares a prefix
    of *d* bits with its query in its best tree is read when the rows that share *d* + 1 bits are too
    few. At least k + 1 different rows are always read.
    """
    asked, ids = dense(probes["v"], forest.width), np.asarray(probes["id"].combine_chunks())
    room = params.k + 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [pd.DataFrame({"probe": [], "score": [], "id": [], "shared": []})]
        for batch in batches:
            own, data = batch.column(0), dense(batch.column(1), forest.width)
            if not len(own):
                continue
            first = np.asarray(own.flatten())[np.asarray(own.offsets)[:-1] - own.offsets[0].as_py()]
            probe, row, scores = best_pairs(asked, data, first, room, forest.largest)
            used, place = np.unique(row, return_inverse=True)
            mine = forest.strings(data[used])
            shared = shared_prefix(strings[probe], mine[place]).max(1)
            frame = pd.DataFrame({"probe": probe, "score": scores, "shared": shared})
            frame["id"] = [x for x in own.take(pa.array(row)).to_pylist()]
            frame = frame.explode("id")
            frame = frame[frame["id"].to_numpy() != ids[frame["probe"].to_numpy()]]
            merged = pd.concat([*best, frame]).sort_values(["probe", "score", "id"], ascending=[True, False, True])
            best = [merged.groupby("probe").head(params.k)]
        made = best[0].astype({"probe": "int32", "score": "float64", "id": "int64", "shared": "int32"})
        yield pa.RecordBatch.from_pandas(made[["probe", "score", "id", "shared"]], preserve_index=False)

    near = points.select("ids", "v").mapInArrow(scan, "probe int, score double, id bigint, shared int")
    place = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), F.asc("id")))
    near = near.withColumn("place", place).where(F.col("place") <= params.k).select("probe", "shared").toPandas()
    least = params.trees * room
    if near.empty:
        return least
    needed = np.sort(totals[near["probe"], near["shared"] + 1] + 1)
    return max(least, int(needed[int(np.ceil(params.recall * len(needed))) - 1]))


def _spread(ids: pa.ListArray) -> np.ndarray:
    """A number per vector that deals out the rows of a leaf."""
    flat, offsets = np.asarray(ids.flatten()), np.asarray(ids.offsets)
    first = flat[offsets[:-1] - (offsets[0] if len(offsets) else 0)]
    return ((first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)).astype(np.int64)


def _copies(many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers, each as often as told, and the number of the copy."""
    at = np.repeat(np.arange(len(many)), many)
    number = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
    return at, number.astype(np.int32)


def _columns(**arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays.values()], list(arrays))

"""Near duplicates: an n-gram Jaccard join over MinHash bands, verified exactly.

Every text is a set of word shingles. Texts with equal sets are one node. A tree is one band: nodes
with equal values of a fixed number of MinHash functions are candidates. The number is the largest
one at which a pair at the similarity sought meets in some tree with the target recall; it follows
from the parameters alone, so there are no tries that would be shortened by what the data hold.

Candidates are then compared whole, by their real shingle sets, in tasks that hold one block of a
group against another. Only counts and one pointer per node leave a task, never pairs, so a group
of thousands of near copies does not blow up. A group is a connected set of candidates, and all its
pairs are compared, whatever its size. In a large one the blocks are made by size of the sets, and
blocks that differ too much in it do not meet, as their sets cannot reach the similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubwatch.llm.common import fresh, materialise
from pubwatch.llm.components import components
from pubwatch.operators.ranking import number_rows

CACHED_WORDS = 200_000
CHUNK = 4096


@dataclass(frozen=True)
class JoinParams:
    """``block`` texts and ``block_words`` words bound one side of a comparison in a task.

    Groups of more than ``whole_group`` texts are cut into blocks by size; no result depends on it.
    """

    words: int = 5
    similarity: float = 0.8
    trees: int = 20
    depth: int = 8
    recall: float = 0.999
    block: int = 512
    block_words: int = 400_000
    whole_group: int = 8192
    seed: int = 1


def matched_depth(params: JoinParams) -> int:
    """Shorten the matched prefix from the full depth until the recall at the threshold is met."""
    for depth in range(params.depth, 1, -1):
        if 1 - (1 - params.similarity**depth) ** params.trees >= params.recall:
            return depth
    return 1


class _Words(dict):
    """64-bit hashes of words; a bounded memory."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode())
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value
        return value


_words = _Words()


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words, lower-cased, split at white space.

    A text of fewer words is one shingle of all of them; one without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - size + 1 + i]
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _permutations(params: JoinParams, depth: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(params.seed)
    many = params.trees * depth
    factors = random.integers(0, 1 << 63, many, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(0, 1 << 63, many, dtype=np.uint64)


def prefixes(grams: np.ndarray, factors: np.ndarray, masks: np.ndarray, trees: int) -> np.ndarray:
    """Per tree the matched prefix of a set, as one hash; ``grams`` is not empty."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), CHUNK):
        mixed = (grams[at : at + CHUNK, None] ^ masks) * factors
        np.minimum(least, mixed.min(axis=0), out=least)
    rows = least.reshape(trees, -1)
    return np.array(
        [xxhash.xxh64_intdigest(row.tobytes(), seed=t) for t, row in enumerate(rows)], np.uint64
    ).view(np.int64)


def _signatures(docs: DataFrame, id_col: str, text_col: str, params: JoinParams) -> DataFrame:
    """id, text_md5, digest of the shingle set, words, prefixes per tree (empty without words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.md5(text.cast("binary")).alias("text_md5"), text.alias("text"))
    factors, masks = _permutations(params, matched_depth(params))
    schema = "id long, text_md5 string, digest binary, words long, prefixes array<bigint>"
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, words, trees = [], [], []
            for text in batch.column(2):
                grams = shingles(text.as_py(), params.words)
                digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                words.append(len(grams))
                trees.append(prefixes(grams, factors, masks, params.trees) if len(grams) else [])
            columns = [batch.column(0), batch.column(1), pa.array(digests, pa.binary())]
            columns += [pa.array(words, pa.int64()), pa.array(trees, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_md5", "digest", "words", "prefixes"])

    return rows.mapInArrow(run, schema.replace("id long", f"id {kind}"))


def _links(grams: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float):
    """Function of a row to the rows that it links to; rows of ``left`` meet rows of ``right``.

    Only shingles that two texts share are looked at; their posting lists give all intersections
    of a row at once.
    """
    sizes = np.array([len(g) for g in grams], dtype=np.int64)
    owner = np.repeat(np.arange(len(grams)), sizes)
    _, code, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = count[code] > 1
    owner, code = owner[shared], code[shared]
    order = np.argsort(code, kind="stable")
    posted = owner[order]
    first = np.searchsorted(code[order], np.arange(len(count) + 1))
    starts = np.searchsorted(owner, np.arange(len(grams) + 1))

    def linked(row: int) -> np.ndarray:
        mine = code[starts[row] : starts[row + 1]]
        if not len(mine):
            return np.empty(0, np.int64)
        lists = [posted[first[c] : first[c + 1]] for c in mine]
        common = np.bincount(np.concatenate(lists), minlength=len(grams))
        union = sizes + sizes[row] - common
        hit = common >= similarity * union - 1e-9
        hit[row] = False
        return np.nonzero(hit & np.where(left[row], right, left))[0]

    return linked


def compare(group: pd.DataFrame, params: JoinParams) -> pd.DataFrame:
    """node, links, root of the texts of one comparison.

    ``side`` tells the blocks of a comparison apart; -1 means that a block meets itself. Links
    count the texts on the other end with their copies. ``root`` is the smallest node reached.
    """
    group = group.drop_duplicates("node").sort_values("node", ignore_index=True)
    nodes, copies = group["node"].to_numpy(), group["copies"].to_numpy()
    side = group["side"].to_numpy()
    within = bool((side < 0).any())
    left = np.ones(len(group), bool) if within else side == side.min()
    right = np.ones(len(group), bool) if within else ~left
    linked = _links([shingles(t, params.words) for t in group["text"]], left, right, params.similarity)
    links, root = np.zeros(len(group), np.int64), np.full(len(group), -1)
    for start in range(len(group)):
        if root[start] >= 0:
            continue
        root[start], todo = start, [start]
        while todo:
            row = todo.pop()
            others = linked(row)
            links[row] = copies[others].sum()
            new = others[root[others] < 0]
            root[new] = start
            todo.extend(new.tolist())
    return pd.DataFrame({"node": nodes, "links": links, "root": nodes[root]})


def _units(labels: DataFrame, nodes: DataFrame, params: JoinParams) -> DataFrame:
    """node, copies, rep, group, low, high, side: the comparisons that each text takes part in.

    Sets whose sizes lie further apart than the similarity allows cannot reach it. So a large group
    is cut into size classes as wide as that (a little wider, for rounding), and a class meets
    itself and its neighbours. Blocks are dealt by hash within a class.
    """
    labels = labels.join(nodes.select("node", "words"), "node")
    texts = labels.groupBy("label").agg(F.count("*").alias("texts"))
    width = log(1 / params.similarity) + 1e-6
    step = F.floor(F.log(F.col("words").cast("double")) / width).cast("long")
    large = F.col("texts") > params.whole_group
    sized = labels.join(texts, "label").select("node", "label", "words", F.when(large, step).otherwise(0).alias("step"))
    sized = materialise(sized, "candidate-groups")
    blocks = F.greatest(
        F.ceil(F.count("*") / params.block), F.ceil(F.sum("words") / params.block_words)
    ).cast("int")
    steps = materialise(sized.groupBy("label", "step").agg(blocks.alias("blocks")), "candidate-blocks")
    own = sized.join(steps, ["label", "step"]).select(
        "node", "label", "step", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long").alias("own")
    )
    reach = steps.select(
        "label",
        F.explode(F.sequence(F.col("step") - 1, F.col("step") + 1)).alias("step"),
        F.col("step").alias("other_step"),
        F.col("blocks").alias("others"),
    )
    met = own.join(reach, ["label", "step"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    mine = F.col("step") * (1 << 32) + F.col("own")
    theirs = F.col("other_step") * (1 << 32) + F.col("other")
    return met.join(nodes.select("node", "copies", "rep"), "node").select(
        "node",
        "copies",
        "rep",
        F.col("label").alias("group"),
        F.least(mine, theirs).alias("low"),
        F.greatest(mine, theirs).alias("high"),
        F.when(mine == theirs, -1).otherwise(mine).alias("side"),
    )


def near_duplicates(
    docs: DataFrame, params: JoinParams = JoinParams(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, text_md5, class_id, class_md5, n_links.

    Two rows are linked if the Jaccard similarity of their shingle sets reaches the threshold.
    ``n_links`` counts the other rows that a row is linked to, copies too. Classes are the
    connected sets of linked rows; ``class_id`` is the smallest id in it and ``class_md5`` the MD5
    of that row's text (the smaller one, if the id repeats).

    * A NULL text counts as empty. A text without words is like no other: it is its own class.
    * A text of fewer words than a shingle has one shingle of all its words.
    * A NULL id is the smallest of a class only if no row of it has an id.
    * Repeated rows are copies of each other: same class, and a link for each other copy.
    * An empty table gives an empty result; other columns are neither read nor returned.
    """
    signed = materialise(_signatures(docs, id_col, text_col, params), "near-signatures")
    worded = signed.where(F.col("words") > 0)
    first = F.struct(F.col("id").isNull().alias("absent"), "id", "text_md5")
    texts = worded.groupBy("digest").agg(
        F.count("*").alias("copies"),
        F.min(first).alias("rep"),
        F.max("words").alias("words"),
        F.first("prefixes").alias("prefixes"),
    )
    nodes = number_rows(texts, [F.asc("digest")], "near-nodes").withColumnRenamed("row_no", "node")
    nodes = materialise(nodes, "near-numbered")
    places = nodes.select("node", F.posexplode("prefixes").alias("tree", "prefix"))
    buckets = places.groupBy("tree", "prefix").agg(F.min("node").alias("hub"), F.count("*").alias("n"))
    members = places.join(buckets.where("n > 1"), ["tree", "prefix"])
    labels = components(members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    units = _units(labels, nodes, params)
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.col(id_col).alias("id"), F.md5(text.cast("binary")).alias("text_md5"), text.alias("text"))
    at = whole["id"].eqNullSafe(units["rep.id"]) & (whole["text_md5"] == units["rep.text_md5"])
    work = whole.join(units, at).drop("id", "text_md5", "rep")
    compared = materialise(
        work.groupBy("group", "low", "high").applyInPandas(
            lambda frame: compare(frame, params), "node bigint, links bigint, root bigint"
        ),
        "near-links",
    )
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(compared.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = nodes.select("node", "digest", "copies", "rep").join(labels, "node", "left")
    placed = placed.withColumn("label", F.coalesce("label", "node")).join(links, "node", "left")
    placed = materialise(placed, "near-placed")
    heads = placed.groupBy("label").agg(F.min("rep").alias("head"))
    settled = placed.join(heads, "label").select(
        "digest", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    with_words = worded.join(settled, "digest").select(
        F.col("id").alias(id_col),
        "text_md5",
        F.col("head.id").alias("class_id"),
        F.col("head.text_md5").alias("class_md5"),
        "n_links",
    )
    without = signed.where(F.col("words") == 0).select(
        F.col("id").alias(id_col),
        "text_md5",
        F.col("id").alias("class_id"),
        F.col("text_md5").alias("class_md5"),
        F.lit(0).cast("long").alias("n_links"),
    )
    return with_words.unionByName(without)


def drop_near_duplicates(
    docs: DataFrame, params: JoinParams = JoinParams(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: the head of each class.

    The rules are those of ``near_duplicates``. Of rows that repeat the id and text of the head of a
    class with words, one stays; texts without words all stay.
    """
    found = near_duplicates(docs, params, id_col, text_col)
    is_head = F.col(id_col).eqNullSafe(F.col("class_id")) & (F.col("text_md5") == F.col("class_md5"))
    key, md5, copies = (fresh(docs, n) for n in ("near_id", "near_md5", "near_copies"))
    heads = found.where(is_head).groupBy(F.col(id_col).alias(key), F.col("text_md5").alias(md5))
    heads = heads.agg(F.count("*").alias(copies))
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.withColumn(md5, F.md5(text.cast("binary")))
    stays = own.join(heads, own[id_col].eqNullSafe(heads[key]) & (own[md5] == heads[md5]))
    stays = stays.select(*[own[c] for c in docs.columns], own[md5], heads[copies])
    worded = F.coalesce(F.col(text_col), F.lit("")).rlike(r"\S")
    repeated = (F.col(copies) > 1) & worded
    once = stays.where(~repeated).select(*docs.columns)
    return once.unionByName(stays.where(repeated).dropDuplicates([id_col, md5]).select(*docs.columns))

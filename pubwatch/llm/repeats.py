"""Removal of byte strings that repeat anywhere, by a sampled suffix array.

A suffix of the corpus matters only if its first ``length`` bytes occur again. Suffixes are
therefore sampled at minimizers: of the grams in every window of ``length`` bytes, the one with
the least hash is the window's anchor. Equal windows have equal anchors at equal offsets, so each
window is judged at its anchor, and anchors are hundreds of times fewer than positions.

* The windows of an anchor lie in one context around it. A context that occurs twice settles all
  its windows; an anchor whose gram occurs once settles them too. Both are counts, which merge in
  the map tasks.
* What is left are anchors in different contexts, at the edges of repeated passages. Their suffixes
  are range-partitioned by leading bytes with sampled splitters. Each bucket sorts them by multikey
  quicksort, to the right of the anchor and, reversed, to its left; the longest common prefixes of
  neighbours then tell for every offset which windows are equal. Splitters lie between different
  leading grams, so no comparison crosses a bucket.
* A gram with more contexts than a bucket should hold is judged window by window through digests,
  again by counts.

The windows of an anchor that repeat form one span, as all contain the anchor. Removal is the union
of spans, judged on the input alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubwatch.llm.common import materialise

LOW = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class RepeatParams:
    """Strings of ``length`` bytes; ``bucket`` contexts per sort task, ``hot`` of one gram."""

    length: int = 400
    gram: int = 32
    bucket: int = 16384
    hot: int = 32768


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash per run of ``gram`` bytes, by doubling."""
    out, width = data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019), 1
    out ^= out >> np.uint64(32)
    factor = np.uint64(0xC2B2AE3D27D4EB4F)
    while width < gram:
        step = min(width, gram - width)
        head, tail = out[: len(out) - step], out[step:]
        out = head * factor + tail
        out ^= out >> np.uint64(31)
        width += step
    return out * np.uint64(0x9FB21C651E98DF25)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, with prefix and suffix minima of blocks."""
    count = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def anchors(data: np.ndarray, params: RepeatParams) -> tuple[np.ndarray, ...]:
    """Position, gram hash, first and last window start of each anchor, in order."""
    if len(data) < params.length:
        none = np.empty(0, np.int64)
        return none, none, none, none
    hashes = _gram_hashes(data, params.gram)
    ranked = (hashes & ~LOW) | np.arange(len(hashes), dtype=np.uint64)
    least = (_sliding_min(ranked, params.length - params.gram + 1) & LOW).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.concatenate([first[1:], [len(least)]]) - 1
    at = least[first]
    return at, hashes[at].view(np.int64), first, last


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _anchor_rows(rows: DataFrame, params: RepeatParams) -> DataFrame:
    """id, key, gram, context (hashes), at, before, after: windows start at at - before ... at - after."""
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "key", "gram", "context", "at", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked, columns = [], [[], [], [], [], []]
            for i, text in enumerate(batch.column(2)):
                raw = text.as_py().encode()
                at, gram, first, last = anchors(np.frombuffer(raw, np.uint8), params)
                picked.append(np.full(len(at), i))
                ends = (last + params.length).tolist()
                context = [
                    _digest(raw[a:b] + (c - a).to_bytes(4, "little"))
                    for a, b, c in zip(first.tolist(), ends, at.tolist(), strict=True)
                ]
                for column, part in zip(columns, (gram, context, at, at - first, at - last), strict=True):
                    column.append(np.asarray(part, np.int64))
            if picked:
                index = pa.array(np.concatenate(picked).astype(np.int64))
                gram, context, at, before, after = (np.concatenate(c) for c in columns)
                numbers = [pa.array(gram), pa.array(context)]
                numbers += [pa.array(x.astype(np.int32)) for x in (at, before, after)]
                keys = [batch.column(0).take(index), batch.column(1).take(index)]
                yield pa.RecordBatch.from_arrays(keys + numbers, names)

    schema = f"id {kind}, key bigint, gram bigint, context bigint, at int, before int, after int"
    return rows.mapInArrow(run, schema)


def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of 64-bit words, and the words each shares with the row before it.

    Multikey quicksort, all parts of a level at once: rows that agree so far are split by the next
    word, and only parts of several rows go on to the word after it.
    """
    count, width = words.shape
    order = np.arange(count)
    common = np.full(count, width)
    part = np.zeros(count, np.int64)  # start of the part that a place in the order belongs to
    active = np.arange(count)
    for w in range(width):
        if len(active) < 2:
            break
        rows = order[active]
        inner = np.lexsort((words[rows, w], part[active]))
        rows = rows[inner]
        order[active] = rows
        parts, values = part[active], words[rows, w]
        new = np.concatenate([[True], parts[1:] != parts[:-1]])
        split = np.concatenate([[False], values[1:] != values[:-1]]) & ~new
        common[active[split]] = w
        begin = new | split
        part[active] = active[np.maximum.accumulate(np.where(begin, np.arange(len(active)), 0))]
        several = np.bincount(np.cumsum(begin) - 1)[np.cumsum(begin) - 1] > 1
        active = active[several]
    if count:
        common[0] = 0
    return order, common


def _ranks(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row of symbols (0: past the end), and symbols shared with the row before."""
    symbols = table.shape[1]
    packed = np.ascontiguousarray(table.astype(">u2")).view(">u8").astype(np.uint64)
    order, common = multikey_sort(packed)
    shared = np.zeros(len(order), np.int64)
    if len(order) > 1:
        a, b = packed[order[:-1]], packed[order[1:]]
        word = np.minimum(common[1:], packed.shape[1] - 1)
        rows = np.arange(len(word))
        differ = a[rows, word] ^ b[rows, word]
        equal = np.select([differ >> np.uint64(s) != 0 for s in (48, 32, 16, 0)], [0, 1, 2, 3], 4)
        same = word * 4 + equal
        # symbols past the end are never shared
        ends = (table != 0).sum(1)[order]
        shared[1:] = np.minimum(np.minimum(same, ends[:-1]), np.minimum(ends[1:], symbols))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank, shared


def judge(contexts: list[bytes], before: np.ndarray, after: np.ndarray, params: RepeatParams):
    """Per anchor the largest and smallest offset of a window that another one equals; -1: none.

    ``contexts[i]`` holds the windows at offsets after[i] ... before[i] left of the anchor.
    """
    count, length = len(contexts), params.length
    width = -(-length // 4) * 4
    left, right = np.zeros((count, width), np.uint16), np.zeros((count, width), np.uint16)
    for i, context in enumerate(contexts):
        data = np.frombuffer(context, np.uint8).astype(np.uint16) + 1
        right[i, : len(data) - before[i]] = data[before[i] :]
        left[i, : before[i]] = data[: before[i]][::-1]
    rank_right, shared_right = _ranks(right)
    rank_left, shared_left = _ranks(left)
    most, least = np.full(count, -1), np.full(count, -1)
    for offset in range(length - params.gram + 1):
        right_class = np.cumsum(shared_right < length - offset)[rank_right]
        may = (before >= offset) & (after <= offset)
        may &= np.bincount(right_class[may], minlength=count + 1)[right_class] > 1
        rows = np.flatnonzero(may)
        if not len(rows):
            continue
        left_class = np.cumsum(shared_left < offset)[rank_left] if offset else np.zeros(count, np.int64)
        both = right_class[rows] * (count + 1) + left_class[rows]
        _, code, times = np.unique(both, return_inverse=True, return_counts=True)
        hit = rows[times[code] > 1]
        most[hit] = offset
        least[hit] = np.where(least[hit] < 0, offset, least[hit])
    return most, least


def _contexts(rows: DataFrame, wanted: DataFrame, params: RepeatParams) -> DataFrame:
    """The wanted anchors (id, key, gram, at, before, after, open, hot) with their context's bytes."""
    per_text = wanted.groupBy("id", "key").agg(
        F.collect_list(F.struct("gram", "at", "before", "after", "open", "hot")).alias("places")
    )
    mine = per_text.select(F.col("id").alias("id2"), F.col("key").alias("key2"), "places")
    joined = rows.join(mine, rows["id"].eqNullSafe(mine["id2"]) & (rows["key"] == mine["key2"]))
    joined = joined.select("id", "key", "text", "places")
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "key", "gram", "at", "before", "after", "open", "hot", "lead", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                raw = batch.column(2)[row].as_py().encode()
                places = {(p["at"], p["before"], p["after"]): p for p in batch.column(3)[row].as_py()}
                for p in places.values():
                    at = p["at"]
                    context = raw[at - p["before"] : at - p["after"] + params.length]
                    lead = raw[at : at + params.gram]
                    out.append((row, p["gram"], at, p["before"], p["after"], p["open"], p["hot"], lead, context))
                if len(out) >= 4096:
                    yield _context_batch(batch, out, names)
                    out = []
            if out:
                yield _context_batch(batch, out, names)

    schema = (
        f"id {kind}, key bigint, gram bigint, at int, before int, after int, open boolean, hot boolean,"
        " lead binary, context binary"
    )
    return joined.mapInArrow(run, schema)


def _context_batch(batch: pa.RecordBatch, out: list[tuple], names: list[str]) -> pa.RecordBatch:
    index, *columns = zip(*out, strict=True)
    index = pa.array(index, pa.int64())
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary()]
    arrays = [batch.column(0).take(index), batch.column(1).take(index)]
    arrays += [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _sorted_spans(contexts: DataFrame, params: RepeatParams) -> DataFrame:
    """Spans of open anchors from suffixes sorted in buckets."""
    kind = contexts.schema["id"].dataType.simpleString()
    buckets = max(1, -(-contexts.count() // params.bucket))
    ranged = contexts.repartitionByRange(buckets, "lead")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables).combine_chunks()
        before, after, at = (table[c].to_numpy().astype(np.int64) for c in ("before", "after", "at"))
        most, least = judge(table["context"].to_pylist(), before, after, params)
        keep = table["open"].to_numpy(zero_copy_only=False) & (most >= 0)
        rows = pa.array(np.flatnonzero(keep))
        low, high = (at - most)[keep], (at - least)[keep] + params.length
        arrays = [table["id"].combine_chunks().take(rows), table["key"].combine_chunks().take(rows)]
        arrays += [pa.array(low.astype(np.int64)), pa.array(high.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "key", "low", "high"])

    return ranged.mapInArrow(run, f"id {kind}, key bigint, low bigint, high bigint")


def _counted_spans(contexts: DataFrame, params: RepeatParams) -> DataFrame:
    """Spans of open anchors of grams with very many contexts, window by window."""
    kind = contexts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, digests, starts = [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("context", "at", "before", "after")), strict=True)
            for i, (context, at, before, after) in enumerate(rows):
                for step in range(before - after + 1):
                    window = context[step : step + params.length]
                    digests.append(hashlib.blake2b(window, digest_size=16).digest())
                    starts.append(at - before + step)
                    index.append(i)
            rows = pa.array(index, pa.int64())
            arrays = [batch.column(c).take(rows) for c in ("id", "key", "at", "open")]
            arrays += [pa.array(digests, pa.binary()), pa.array(starts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "key", "at", "open", "digest", "start"])

    windows = contexts.mapInArrow(
        run, f"id {kind}, key bigint, at int, open boolean, digest binary, start bigint"
    )
    windows = materialise(windows, "repeat-windows")
    twice = windows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    found = windows.where("open").join(twice, "digest", "left_semi").groupBy("id", "key", "at")
    return found.agg(F.min("start").alias("low"), (F.max("start") + params.length).alias("high")).drop("at")


def repeated_spans(rows: DataFrame, params: RepeatParams) -> DataFrame:
    """id, key, low, high: byte spans to remove, not merged yet. ``rows`` has id, key, text."""
    table = materialise(_anchor_rows(rows, params), "repeat-anchors")
    by_gram = table.groupBy("gram").agg(
        F.count("*").alias("n"), F.min("context").alias("c0"), F.max("context").alias("c1")
    )
    several = by_gram.where("n > 1").select("gram", (F.col("c0") != F.col("c1")).alias("mixed"))
    # a hot gram's rows are split only in a join whose sides are both plain shuffles, without an aggregate
    several = materialise(several, "repeat-several")
    shared = materialise(table.join(several, "gram"), "repeat-shared")
    place = F.struct("id", "key", "at", "before", "after")
    mixed = shared.where("mixed")
    counts = mixed.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(place).alias("one"))
    counts = materialise(counts, "repeat-contexts")
    variants = counts.groupBy("gram").agg(F.count("*").alias("variants"))
    hot = materialise(variants.where(F.col("variants") > params.hot).select("gram"), "repeat-hot")
    wanted = counts.join(hot.withColumn("hot", F.lit(True)), "gram", "left").select(
        "gram", "one.*", (F.col("n") == 1).alias("open"), F.coalesce("hot", F.lit(False)).alias("hot")
    )
    contexts = materialise(_contexts(rows, wanted, params), "repeat-bytes")
    # written for its size: the rows of a hot context stay where they are if the others are few
    again = materialise(counts.where("n > 1").select("gram", "context"), "repeat-again")
    settled = shared.where("not mixed").unionByName(mixed.join(again, ["gram", "context"], "left_semi"), True)
    settled = settled.select(
        "id",
        "key",
        (F.col("at") - F.col("before")).cast("long").alias("low"),
        (F.col("at") - F.col("after") + params.length).cast("long").alias("high"),
    )
    spans = settled.unionByName(_sorted_spans(contexts.where("not hot"), params))
    if not contexts.where("hot").isEmpty():
        spans = spans.unionByName(_counted_spans(contexts.where("hot"), params))
    return spans


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in spans):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


def remove_repeats(
    docs: DataFrame, params: RepeatParams = RepeatParams(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_bytes, spans (array of low, high: removed byte runs), kept (bytes), per row of ``docs``.

    Each byte covered by a string of ``length`` bytes that starts anywhere else too is removed,
    also within one text and when the two overlap. Strings are judged on the input.

    * A NULL text counts as empty; texts shorter than ``length`` bytes are kept whole.
    * Repeated rows repeat each other: of a long enough text nothing is kept.
    * NULL ids take part like others. What is kept may start or end inside a character.
    * An empty table gives an empty result; other columns are neither read nor returned.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    spans = repeated_spans(rows, params)
    per_text = spans.groupBy("id", "key").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    mine = per_text.select(F.col("id").alias("id2"), F.col("key").alias("key2"), "spans")
    joined = rows.join(mine, rows["id"].eqNullSafe(mine["id2"]) & (rows["key"] == mine["key2"]), "left")
    joined = joined.select("id", "text", "spans")
    span_type = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_py().encode()
                runs = _merged(spans.as_py() or [])
                edges = [0, *(x for span in runs for x in span), len(raw)]
                sizes.append(len(raw))
                removed.append([{"low": a, "high": b} for a, b in runs])
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, span_type)]
            arrays.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_bytes", "spans", "kept"])

    schema = f"id {kind}, n_bytes bigint, spans array<struct<low:bigint,high:bigint>>, kept binary"
    return joined.mapInArrow(run, schema).withColumnRenamed("id", id_col)

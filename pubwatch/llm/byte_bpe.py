"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pairs that can merge wait in one bucket per merge rank. A bitmap of two levels marks the
buckets in use, so the next rank is two find-first-set steps away. A bucket is a heap of
positions in the linked list of parts, so the leftmost pair of a rank comes first. Entries of pairs
that have changed since are skipped when they come up. A pre-token of n bytes takes O(n log n)
steps, however long it is.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_WORDS = 200_000
CACHED_BYTES = 64
BATCH_BYTES = 2 << 20
PROBED = 1 << 14  # code points looked up at a time
BEYOND = re.compile("[\U00010000-\U0010ffff]")


WIDTH = 9
MASK = (1 << WIDTH) - 1
BIT = [1 << i for i in range(1 << WIDTH)]


class RankQueue:
    """Positions by rank; the smallest rank first, then the smallest position.

    The bitmap has a word of 512 bits per 512 ranks and one word above these.
    """

    def __init__(self, ranks: int) -> None:
        if ranks > 1 << 2 * WIDTH:
            raise ValueError("two levels of 512 bits hold 262,144 ranks")
        self.leaves = [0] * ((ranks >> WIDTH) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        self.leaves[rank >> WIDTH] |= BIT[rank & MASK]
        self.top |= BIT[rank >> WIDTH]

    def pop(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        first = self.top & -self.top
        leaf = first.bit_length() - 1
        lowest = self.leaves[leaf] & -self.leaves[leaf]
        rank = leaf << WIDTH | lowest.bit_length() - 1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.leaves[leaf] ^= lowest
            if not self.leaves[leaf]:
                self.top ^= first
        return rank, position


def class_differences() -> dict[int, str]:
    """Code points that the library's pattern engine puts into another class than ``regex`` does.

    The two follow different versions of Unicode. Each such code point is given with a character
    that both engines put into the library's class.
    """
    single = {bytes([i]): i for i in range(256)}
    stand_ins: dict[int, str] = {}
    for name, stand_in in ((r"\p{L}", "\u00aa"), (r"\p{N}", "\u00b2"), (r"\s", "\u2003")):
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
        for first in range(0, 0x110000, PROBED):
            some = "".join(chr(c) for c in range(first, first + PROBED) if not 0xD800 <= c < 0xE000)
            theirs = set(bytes(probe.encode_ordinary(some)).decode())
            ours = set(regex.findall(name, some))
            for c in ours - theirs:
                stand_ins.setdefault(ord(c), "\ue000")
            for c in theirs - ours:
                stand_ins[ord(c)] = stand_in
    return stand_ins


def _any_of(codes: list[int]) -> str:
    """A pattern of one of these code points; ranges keep it short."""
    if not codes:
        return r"(?!)"
    starts = [c for i, c in enumerate(codes) if not i or codes[i - 1] != c - 1]
    ends = [c for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    return "[" + "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in zip(starts, ends, strict=True)) + "]"


class ByteBpe:
    """A vocabulary of byte strings by rank, which is also the id, and a pattern of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        by_rank = dict(zip(ranks.values(), ranks.keys(), strict=True))
        #: bytes per id; ids that no token has are NULL
        self.tokens = pa.array([by_rank.get(i) for i in range(max(by_rank, default=-1) + 1)], pa.large_binary())
        self.pattern = regex.compile(pattern)
        self.stand_ins = class_differences()
        # a class within the first plane is a table look-up; one beyond it would be a long list
        self.odd = re.compile(_any_of([c for c in sorted(self.stand_ins) if c < 0x10000]))
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.words = _Words(self)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def split(self, text: str) -> list[str]:
        """Pre-tokens, as the library's pattern engine finds them."""
        if text.isascii() or not (
            self.odd.search(text)
            or (BEYOND.search(text) and not self.stand_ins.keys().isdisjoint(map(ord, text)))
        ):
            return self.pattern.findall(text)
        matches = self.pattern.finditer(text.translate(self.stand_ins))
        return [text[m.start() : m.end()] for m in matches]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. The loop spells out the steps of the queue, as calls cost a third."""
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        leaves, buckets, top = self.queue.leaves, self.queue.buckets, 0
        size = len(piece)
        # after[i]: where the part at i ends; before[i]: where the part left of it starts
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        pair = [-1] * size  # rank of the part at i with the next one; -1: none, or i is merged away
        for i in range(size - 1):
            rank = get(piece[i : i + 2], -1)
            if rank >= 0:
                pair[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    leaves[rank >> WIDTH] |= BIT[rank & MASK]
                    top |= BIT[rank >> WIDTH]
        while top:
            first = top & -top
            leaf = first.bit_length() - 1
            bits = leaves[leaf]
            lowest = bits & -bits
            rank = leaf << WIDTH | lowest.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                leaves[leaf] = bits ^ lowest
                if bits == lowest:
                    top ^= first
            if pair[i] != rank:
                continue
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = -1
            new = -1
            if end < size:
                before[end] = i
                new = get(piece[i : after[end]], -1)
                if new >= 0:
                    if new in buckets:
                        heappush(buckets[new], i)
                    else:
                        buckets[new] = [i]
                        leaves[new >> WIDTH] |= BIT[new & MASK]
                        top |= BIT[new >> WIDTH]
            pair[i] = new
            left = before[i]
            if left >= 0:
                pair[left] = new = get(piece[left:end], -1)
                if new >= 0:
                    if new in buckets:
                        heappush(buckets[new], left)
                    else:
                        buckets[new] = [left]
                        leaves[new >> WIDTH] |= BIT[new & MASK]
                        top |= BIT[new >> WIDTH]
        ids, i = [], 0
        while i < size:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all([ids])[0].as_py()

    def decode_all(self, encoded: list[bytes]) -> pa.Array:
        """The bytes of each run of ids. The bytes of all tokens lie in one buffer, cut at the runs."""
        numbers = pa.Array.from_buffers(
            pa.uint32(), sum(map(len, encoded)) // 4, [None, pa.py_buffer(b"".join(encoded))]
        )
        _, places, values = self.tokens.take(numbers).buffers()
        ends = np.cumsum([0, *map(len, encoded)]) // 4
        offsets = np.frombuffer(places, np.int64)[ends] if values else np.zeros(len(ends), np.int64)
        offsets = pa.py_buffer(offsets.astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(encoded), [None, offsets, values or pa.py_buffer(b"")])


class _Words(dict):
    """Encoded pre-tokens; a bounded memory of the short ones in two generations.

    When the young generation is full it becomes the old one; words in use move back from there.
    """

    def __init__(self, bpe: ByteBpe) -> None:
        self.bpe = bpe
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            piece = word.encode()
            ids = array("I", self.bpe.merge(piece)).tobytes()
            if len(piece) > CACHED_BYTES:
                return ids
        if len(self) >= CACHED_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


_loaded: dict[tuple[str, str], ByteBpe] = {}


def load(path: str, pattern: str) -> ByteBpe:
    """The vocabulary, read once per Python worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe.from_file(path, pattern)
    return _loaded[path, pattern]


def encode_decode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded (bytes), per row.

    Each match of ``pattern`` is merged by itself; nothing is a special token. Texts are read whole.

    * A NULL text counts as empty; an empty text has no ids and decodes to no bytes.
    * Rows are handled one by one, so repeated rows and NULL ids pass through as they are.
    * An empty table gives an empty result; other columns are neither read nor returned.

    Each worker reads the vocabulary at ``ranks_path``, which has to be there on every machine.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks_path, pattern)
        for batch in batches:
            start, encoded, held = 0, [], 0
            for row, text in enumerate(batch.column(1), 1):
                encoded.append(bpe.encode(text.as_py()))
                held += len(encoded[-1])
                if held >= BATCH_BYTES or row == len(batch):
                    yield _batch(bpe, batch.column(0).slice(start, row - start), encoded)
                    start, encoded, held = row, [], 0

    schema = f"id {kind}, n_tokens bigint, ids binary, decoded binary"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _batch(bpe: ByteBpe, keys: pa.Array, encoded: list[bytes]) -> pa.RecordBatch:
    sizes = pa.array([len(ids) // 4 for ids in encoded], pa.int64())
    arrays = [keys, sizes, pa.array(encoded, pa.binary()), bpe.decode_all(encoded)]
    return pa.RecordBatch.from_arrays(arrays, ["id", "n_tokens", "ids", "decoded"])

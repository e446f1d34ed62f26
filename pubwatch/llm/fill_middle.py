"""Fill-in-middle transformation, cut by SWAR select over UTF-8 words.

A batch of texts is read as little-endian 64-bit words. One expression per word marks the bytes at
which a code point ends; a population count per word and its running sum say how many units end
before each word. The cut after the k-th unit is a search for its word, then a select inside the
word by a multiplication, whose bytes are the running counts. No text is decoded or walked.

Cuts are byte places, so the parts are slices of bytes; those, the output and the way back are
built-in expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubwatch.llm.common import fresh

ONES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
BATCH_BYTES = 16 << 20


@dataclass(frozen=True)
class FimParams:
    """Seed of the draws; of 100 texts ``rate`` are transformed, of 100 of those ``spm`` suffix first."""

    seed: str = "1"
    rate: int = 90
    spm: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


class Units:
    """Rank and select of code points in a buffer of whole UTF-8 texts that lie one after another."""

    def __init__(self, data: np.ndarray) -> None:
        padded = np.zeros(len(data) // 8 * 8 + 8, dtype=np.uint8)
        padded[: len(data)] = data
        words = padded.view("<u8").astype(np.uint64, copy=False)
        # the low bit of each byte: set where the byte is no continuation (10xxxxxx)
        starts = ((words >> np.uint64(7)) & ~(words >> np.uint64(6)) & ONES) ^ ONES
        following = np.append(starts[1:], ONES)
        #: the low bit of each byte: set where a unit ends, as the next byte starts one
        self.ends = (starts >> np.uint64(8)) | (following << np.uint64(56))
        counts = np.bitwise_count(self.ends)
        self.upto = np.cumsum(counts, dtype=np.int64)
        self.before = self.upto - counts

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Units that end before each byte place."""
        word, bits = places >> 3, ((places & 7) << 3).astype(np.uint64)
        below = (np.uint64(1) << bits) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.ends[word] & below)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The byte place after each unit, counted from 1."""
        word = np.searchsorted(self.upto, ranks)
        within = (ranks - self.before[word]).astype(np.uint64)
        running = self.ends[word] * ONES  # byte j: units that end in bytes 0 to j
        reached = ((running | HIGH) - within * ONES) & HIGH
        return word * 8 + 8 - np.bitwise_count(reached) + 1


def _cuts(data: np.ndarray, offsets: np.ndarray, draws: list[np.ndarray]) -> list[np.ndarray]:
    """Units, the two cuts in units and the two cuts in bytes, per text of a buffer."""
    low, high = offsets[:-1], offsets[1:]
    if not len(low):
        return [np.zeros(0, np.int64)] * 5
    units = Units(data[low[0] : high[-1]])
    low, high = low - offsets[0], high - offsets[0]
    first = units.rank(low)
    n = units.rank(high) - first
    a, b = (draw % (n + 1) for draw in draws)
    parts = [np.minimum(a, b), np.maximum(a, b)]
    places = []
    for part in parts:
        place = low.copy()
        some = part > 0
        place[some] = units.select((first + part)[some])
        places.append(place - low)
    return [n, *parts, *places]


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``BATCH_BYTES``; a longer text is a run of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + BATCH_BYTES, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def _draw(id_col: Column, seed: str, group: int) -> Column:
    """The ``group``-th 8 hex digits, from 0, of the digest of seed and id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def transform(
    docs: DataFrame, params: FimParams = FimParams(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n (code points), form, prefix_chars, middle_chars, output, per row of ``docs``.

    The text is cut after the smaller and after the larger of two drawn numbers of code points. The
    form is ``psm`` (marked prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``:
    the text as it is, where it is empty, holds a marker, or by the rate.

    * A NULL text counts as empty, a NULL id draws like an empty one; repeated rows are cut alike.
    * Texts are cut whole, however long; memory is about five times the longest text.
    * An empty table gives an empty result; other columns are neither read nor returned.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        _draw(F.col(id_col), params.seed, 0).alias("h1"),
        _draw(F.col(id_col), params.seed, 1).alias("h2"),
    )
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            if pa.types.is_string(texts.type):
                texts = texts.cast(pa.large_string())
            _, places, values = texts.buffers()
            offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
            draws = [batch.column(i).to_numpy() for i in (2, 3)]
            for start, stop in _slices(offsets):
                found = _cuts(data, offsets[start : stop + 1], [d[start:stop] for d in draws])
                arrays = [batch.column(0).slice(start, stop - start), texts.slice(start, stop - start)]
                arrays += [pa.array(f, pa.int64()) for f in found]
                yield pa.RecordBatch.from_arrays(
                    arrays, ["id", "text", "n", "first", "second", "low", "high"]
                )

    cut = rows.mapInArrow(
        run, f"id {kind}, text string, n bigint, first bigint, second bigint, low bigint, high bigint"
    )
    marked = F.lit(False)
    for marker in (params.prefix, params.suffix, params.middle):
        marked |= F.contains(F.col("text"), F.lit(marker))
    plain = (F.col("text") == "") | marked | (_draw(F.col("id"), params.seed, 2) % 100 >= params.rate)
    form = F.when(plain, "plain").when(_draw(F.col("id"), params.seed, 3) % 100 < params.spm, "spm")
    raw = F.col("text").cast("binary")
    low, high = F.col("low").cast("int"), F.col("high").cast("int")
    prefix = F.substr(raw, F.lit(1), low)
    middle = F.substr(raw, low + 1, high - low)
    suffix = F.substr(raw, high + 1, F.octet_length("text") - high)
    mark = {name: F.lit(getattr(params, name)).cast("binary") for name in ("prefix", "suffix", "middle")}
    psm = F.concat(mark["prefix"], prefix, mark["suffix"], suffix, mark["middle"], middle)
    spm = F.concat(mark["suffix"], suffix, mark["prefix"], prefix, mark["middle"], middle)
    output = F.when(F.col("form") == "plain", F.col("text"))
    output = output.when(F.col("form") == "psm", psm.cast("string")).otherwise(spm.cast("string"))
    formed = F.col("form") != "plain"
    return cut.withColumn("form", form.otherwise("psm")).select(
        F.col("id").alias(id_col),
        "n",
        "form",
        F.when(formed, F.col("first")).alias("prefix_chars"),
        F.when(formed, F.col("second") - F.col("first")).alias("middle_chars"),
        output.alias("output"),
    )


def restore(rows: DataFrame, params: FimParams = FimParams(), name: str = "text") -> DataFrame:
    """``rows`` (form, output) with the text that each output was made of, as column ``name``.

    A transformed text holds no marker of its own, and a marker cannot start inside another one, so
    the three markers of an output are the only ones. NULL outputs stay NULL.
    """
    markers = [params.prefix, params.suffix, params.middle]
    either = "|".join(rf"\Q{marker}\E" for marker in markers)
    parts = fresh(rows, "parts")
    held = F.when(F.col("form") != "plain", F.split("output", either, -1))
    one, two, three = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    text = F.when(F.col("form") == "plain", F.col("output"))
    text = text.when(F.col("form") == "psm", F.concat(one, three, two)).otherwise(F.concat(two, three, one))
    return rows.withColumn(parts, held).withColumn(name, text).drop(parts)

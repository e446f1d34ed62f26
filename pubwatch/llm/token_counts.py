"""Token counts of whole texts; huge texts are encoded in overlapping chunks that resynchronise.

A text up to ``chunk`` characters goes to the library at once. A longer one is cut into chunks that
overlap. Two neighbours are spliced at a position where both start a token and no merge can cross:
no piece of the vocabulary holds the two characters around it next to each other, so whatever
stands on one side never changes the tokens on the other. If the overlap has no such position, it
doubles, at worst until one chunk holds the whole text. Counts are therefore exact at any length.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CHUNK = 1 << 16
OVERLAP = 1 << 9


class PieceCounter:
    """Counts the tokens of a sentencepiece model of type BPE without begin, end or extra ids."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.encode = model.encode
        sizes = range(model.get_piece_size())
        pieces = [
            model.id_to_piece(i)
            for i in sizes
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        #: characters that some piece holds side by side; merges cross no other boundary
        self.joined = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}

    def stable(self, text: str, at: int) -> bool:
        """No merge can cross position ``at``, whatever stands farther away."""
        return text[at - 1 : at + 1].replace(" ", SPACE) not in self.joined

    def starts(self, text: str, low: int, high: int) -> list[int]:
        """Where the tokens of ``text[low:high]`` start, as positions of the whole text.

        The library puts a space before every chunk. It is gone from the count with everything
        left of the first splice, and counts where the text itself starts.
        """
        mapped = self.encode(text[low:high], return_type="offset_mapping")
        return [low + begin for begin, _ in mapped["offsets"]]

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        size = len(text)
        if size <= chunk:
            return len(self.encode(text, return_type="numpy"))
        total, begin, low, high = 0, 0, 0, chunk
        here = self.starts(text, low, high)
        while high < size:
            width = overlap
            splice = None
            while splice is None:
                next_low = max(low, high - width)
                next_high = min(size, max(next_low + chunk, high + width))
                there = self.starts(text, next_low, next_high)
                splice = self._common(text, here, there, max(begin, next_low), high)
                if splice is None:
                    if next_low == low:  # no boundary in the whole chunk: it grows
                        high = min(size, high + (high - low))
                        here = self.starts(text, low, high)
                        if high == size:
                            return total + len(here) - bisect_left(here, begin)
                    width *= 2
            total += bisect_left(here, splice) - bisect_left(here, begin)
            begin, low, high, here = splice, next_low, next_high, there
        return total + len(here) - bisect_left(here, begin)

    def _common(self, text: str, here: list[int], there: list[int], low: int, high: int) -> int | None:
        """The last position inside (low, high) where both chunks start a token and that is stable."""
        shared = set(there[bisect_left(there, low + 1) : bisect_left(there, high)])
        for at in reversed(here[bisect_left(here, low + 1) :]):
            if at in shared and self.stable(text, at):
                return at
        return None


_loaded: dict[str, PieceCounter] = {}


def load(path: str) -> PieceCounter:
    """The model, read once per Python worker."""
    if path not in _loaded:
        _loaded[path] = PieceCounter(path)
    return _loaded[path]


def count_tokens(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens, per row. ``chunk`` and ``overlap`` bound memory, not texts.

    * A NULL text counts as empty; an empty text has 0 bytes and 0 tokens.
    * Rows are handled one by one, so repeated rows and NULL ids pass through as they are.
    * An empty table gives an empty result; other columns are neither read nor returned.

    Each worker reads the model at ``model_path``, which has to be there on every machine.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(model_path)
        for batch in batches:
            counts = [counter.count(text.as_py(), chunk, overlap) for text in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens"])

    counted = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumnRenamed("id", id_col)

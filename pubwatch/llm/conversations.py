"""Repair of conversation structure by a dynamic program over grammar-compressed row sequences.

A repaired conversation has the role initials ``(s?(ua)+)?``. Only keys take part in finding the
edits: per row a digest, its role's initial and its fault, about a tenth of the texts.

* Rows that repeat merge before they shuffle, the first row of a role and text is found by an
  aggregate, and rows are put in order by a range sort. A conversation with a third of all rows is
  so spread over many tasks, which write its symbols in chunks.
* Equal chunks are worked out once for all conversations that have them. Of these chunks each task
  makes Re-Pair grammars, and one min-plus transfer matrix per rule (:mod:`repair_grammar`).
* A conversation's matrices are taken in order, in a stream over sorted chunks that holds four
  audits at a time. The cheapest audit goes back to the chunks, whose rows it keeps or drops.

Texts move twice: to their kept rows, and into reading order where they are digested. A digest of a
whole conversation has to read it in one task; it does so as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubwatch.llm import repair_grammar as grammar
from pubwatch.llm.common import materialise

#: White space and sentence ends of the rules.
SPACE = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"
DIGEST = 16


@dataclass(frozen=True)
class RepairParams:
    """Rows per ``chunk`` of a conversation; symbols that one task's ``grammar`` is made of."""

    chunk: int = 4096
    grammar: int = 1 << 17


@dataclass(frozen=True)
class Repaired:
    """``report``: one row per conversation. ``rows``: the repaired rows, with their places."""

    report: DataFrame
    rows: DataFrame


def damage(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The four columns of ``rows``, damaged by a checksum of conversation and turn.

    Of 20 rows one goes, one loses its text, one its sentence ends, one comes twice and one becomes
    the user's. A NULL conversation or turn counts as one space in the checksum, a NULL role or text
    becomes one space.
    """
    key = F.concat(_spaced(conv_col), F.lit(":"), _spaced(turn_col))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(_spaced(text_col), SENTENCE_ENDS, ""))
    return rows.where(kind != 0).select(
        F.col(conv_col),
        F.col(turn_col),
        F.when(kind == 4, "user").otherwise(_spaced(role_col)).alias(role_col),
        text.otherwise(_spaced(text_col)).alias(text_col),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _md5(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def _keyed(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text and place: a key of the conversation and a digest of the rest."""
    named = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        _spaced(role).alias("role"),
        _spaced(text).alias("text"),
    )
    colon, size = F.lit(":"), F.char_length("role").cast("string")
    said = [size, colon, F.col("role"), F.col("text")]
    spot = F.coalesce(F.col("turn").cast("string"), F.lit(""))
    return named.withColumn("said", _md5(*said)).withColumn("place", _md5(spot, colon, *said))


def _keys(keyed: DataFrame) -> DataFrame:
    """Distinct rows, how often they occur, and what is wrong with them.

    ``first``: the row is the first of its role and text, in order of turns, NULL first.
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    role = F.lit(grammar.OTHER)
    for code, letter in enumerate(grammar.ROLES):
        role = F.when(initial == letter, code).otherwise(role)
    flagged = keyed.select(
        "conv",
        "turn",
        "role",
        "said",
        "place",
        role.alias("initial"),
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(*SENTENCE_ENDS)).alias("cut_off"),
    )
    distinct = flagged.groupBy(*flagged.columns).agg(F.count("*").alias("copies"))
    distinct = materialise(distinct, "repair-rows")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = distinct.groupBy("conv", "said").agg(F.min(turn).alias("least"), F.count("*").alias("places"))
    again = again.where("places > 1").drop("places")
    joined = distinct.join(again, ["conv", "said"], "left")
    first = F.col("least").isNull() | F.col("least.turn").eqNullSafe(F.col("turn"))
    return joined.withColumn("first", first).drop("least", "said")


def _counts(keys: DataFrame) -> DataFrame:
    """Gaps and faults per conversation, summed up over turns first."""
    repeats = F.col("copies") - F.col("first").cast("long")
    per_turn = keys.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), repeats).otherwise(0)).alias("duplicate"),
        F.count_if(~F.col("blank") & F.col("first") & F.col("cut_off")).alias("truncated"),
    )
    span = F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count("turn")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    return per_turn.groupBy("conv").agg(
        F.when(span.isNull(), 0).otherwise(F.least(span, most).cast("long")).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )


def _chunks(keys: DataFrame, size: int) -> DataFrame:
    """conv, part, seq, codes, places: the symbols of up to ``size`` rows in order, and their digests."""
    fault = F.when(F.col("blank") | ~F.col("first"), grammar.DELETE)
    fault = fault.when(F.col("cut_off"), grammar.TRUNCATED).otherwise(grammar.CLEAN)
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("place")]
    coded = keys.select("conv", "turn", "role", "place", "initial", fault.alias("fault"), "copies")
    ordered = coded.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("conv", "initial", "fault", "copies", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, seq, codes, places, out = None, 0, b"", b"", []
        for batch in batches:
            for name, more_codes, more_places in _runs(batch, size):
                if name != conv:
                    if codes:
                        out.append((conv, part, seq, codes, places))
                    conv, seq, codes, places = name, 0, b"", b""
                codes, places = codes + more_codes, places + more_places
                while len(codes) >= size:
                    out.append((conv, part, seq, codes[:size], places[: size * DIGEST]))
                    seq, codes, places = seq + 1, codes[size:], places[size * DIGEST :]
                if len(out) >= 1000:
                    yield _records(out, CHUNK)
                    out = []
        if codes:
            out.append((conv, part, seq, codes, places))
        yield _records(out, CHUNK)

    return ordered.mapInArrow(run, _ddl(CHUNK))


def _runs(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[str, bytes, bytes]]:
    """Conversation, symbols and digests of adjacent rows, copies written out; about ``limit`` at a time."""
    initial, fault, copies = (batch.column(i).to_numpy() for i in (1, 2, 3))
    first = (initial * 3 + fault).astype(np.uint8)
    again = (initial * 3 + grammar.DELETE).astype(np.uint8)
    digests = np.frombuffer(b"".join(batch.column(4).to_pylist()), f"V{DIGEST}")
    upto = np.cumsum(copies)
    start = 0
    while start < len(batch):
        before = int(upto[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
        names = pc.run_end_encode(batch.column(0).slice(start, stop - start))
        low = start
        for name, end in zip(names.values.to_pylist(), names.run_ends.to_pylist(), strict=True):
            high = start + end
            if high == low + 1:  # one row may have any number of copies
                left, codes = int(copies[low]), bytes([first[low]])
                while left:
                    step = min(left, limit)
                    codes += bytes([again[low]]) * (step - len(codes))
                    yield name, codes, digests[low].tobytes() * step
                    left, codes = left - step, b""
            else:
                codes = np.repeat(again[low:high], copies[low:high])
                codes[np.cumsum(copies[low:high]) - copies[low:high]] = first[low:high]
                yield name, codes.tobytes(), np.repeat(digests[low:high], copies[low:high]).tobytes()
            low = high
        start = stop


CHUNK = {"conv": "string", "part": "int", "seq": "int", "codes": "binary", "places": "binary"}
TRANSFER = {
    "codes": "binary", "costs": "array<bigint>", "audits": "array<string>", "illegal": "bigint",
    "first": "int", "last": "int",
}
PIECE = {
    "conv": "string", "part": "int", "seq": "int", "piece": "string", "state": "int", "before": "bigint",
    "illegal": "bigint", "cost": "bigint", "audit": "string",
}
KEPT = {"conv": "string", "position": "bigint", "place": "binary", "new_role": "string"}
ARROW = {
    "string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "bigint": pa.int64(),
    "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def _records(rows: list[tuple], columns: dict[str, str]) -> pa.RecordBatch:
    values = zip(*rows, strict=True) if rows else [[]] * len(columns)
    arrays = [pa.array(v, ARROW[kind]) for v, kind in zip(values, columns.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _transfers(chunks: DataFrame, symbols: int) -> DataFrame:
    """The matrix of every distinct run of symbols, by grammars of about so many symbols each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, held = [], 0
            for i, code in enumerate(batch.column(0), 1):
                codes.append(code.as_py())
                held += len(codes[-1])
                if held >= symbols or i == len(batch):
                    rows = []
                    for own, t in zip(codes, grammar.transfers(codes), strict=True):
                        cells = [cell for row in t.matrix for cell in row]
                        costs = [cell and cell[0] for cell in cells]
                        audits = [cell and str(cell[1]) for cell in cells]
                        rows.append((own, costs, audits, t.illegal, t.first, t.last))
                    yield _records(rows, TRANSFER)
                    codes, held = [], 0

    return chunks.select("codes").distinct().mapInArrow(run, _ddl(TRANSFER))


class _Conversation:
    """The cheapest ways through the chunks of one conversation so far."""

    def __init__(self, name: str) -> None:
        self.name = name
        self.row: grammar.Row = [(0, grammar.EMPTY), None, None, None]
        #: per chunk: part, seq, and for each state after it the state before it and the edits between
        self.steps: list[tuple[int, int, list[int], list[int]]] = []
        self.illegal, self.last = 0, None

    def add(self, part: int, seq: int, cells: list, illegal: int, first: int, last: int) -> None:
        matrix = [cells[i : i + 4] for i in range(0, 16, 4)]
        before = [entry and entry[1].size for entry in self.row]
        self.row, origins = grammar.advance(self.row, matrix)
        sizes = [e and e[1].size - before[o] for e, o in zip(self.row, origins, strict=True)]
        self.steps.append((part, seq, origins, sizes))
        self.illegal += illegal + (self.last is not None and (self.last, first) not in grammar.LEGAL)
        self.last = last

    def pieces(self) -> list[tuple]:
        state, end = grammar.best_end(self.row)
        (cost, audit), (more, closing) = self.row[state], grammar.INSERTIONS[state][end]
        cost, audit = cost + more, str(audit) + str(closing)
        path, stop = [], len(audit) - closing.size
        for part, seq, origins, sizes in reversed(self.steps):
            path.append((part, seq, stop - sizes[state], stop, origins[state]))
            stop, state = stop - sizes[state], origins[state]
        path.reverse()
        out, before = [], 0
        for i, (part, seq, low, high, origin) in enumerate(path):
            ends = i + 1 == len(path)
            piece = audit[low:] if ends else audit[low:high]
            total = (self.illegal, cost, audit) if ends else (None, None, None)
            out.append((self.name, part, seq, piece, origin, before, *total))
            before += len(piece) - piece.count("D")
        return out


def _pieces(chunks: DataFrame, transfers: DataFrame) -> DataFrame:
    """Per chunk its part of the cheapest audit, the state and the number of repaired rows before it.

    The last chunk of a conversation also has its illegal neighbours, its cost and its whole audit.
    """
    sized = chunks.select("conv", "part", "seq", "codes").join(transfers, "codes").drop("codes")
    ordered = sized.repartition("conv").sortWithinPartitions("conv", "part", "seq")
    ordered = ordered.select("conv", "part", "seq", "costs", "audits", "illegal", "first", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out = None, []
        for batch in batches:
            for name, part, seq, costs, audits, *ends in zip(
                *(batch.column(i).to_pylist() for i in range(8)), strict=True
            ):
                if known is None or known.name != name:
                    out += known.pieces() if known else []
                    known = _Conversation(name)
                cells = [
                    None if cost is None else (cost, grammar.Rope(audit))
                    for cost, audit in zip(costs, audits, strict=True)
                ]
                known.add(part, seq, cells, *ends)
                if len(out) >= 1000:
                    yield _records(out, PIECE)
                    out = []
        out += known.pieces() if known else []
        yield _records(out, PIECE)

    return ordered.mapInArrow(run, _ddl(PIECE))


def _kept(chunks: DataFrame, pieces: DataFrame) -> DataFrame:
    """conv, position, place, new_role: the rows that the edits leave; an inserted one has no place."""
    joined = chunks.join(pieces.select("conv", "part", "seq", "piece", "state", "before"), ["conv", "part", "seq"])
    joined = joined.select("conv", "codes", "places", "piece", "state", "before")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                name, codes, places, piece, state, before = row
                for i, (at, role) in enumerate(grammar.apply(piece, codes, state), before):
                    place = places[at * DIGEST : (at + 1) * DIGEST] if at >= 0 else None
                    out.append((name, i, place, role))
                if len(out) >= 10_000:
                    yield _records(out, KEPT)
                    out = []
        yield _records(out, KEPT)

    return joined.mapInArrow(run, _ddl(KEPT))


def repair(
    rows: DataFrame,
    params: RepairParams = RepairParams(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repaired:
    """The cheapest edits that give every conversation the role initials ``(s?(ua)+)?``.

    Rows stand in order of turns, NULL first; those of one turn in order of roles, then of a digest
    of the text, so equal rows are neighbours. A row's first fault counts: it is blank, or a
    duplicate (role and text seen earlier), or truncated (no ``[.!?]`` at its end). A row is kept at
    no cost, gets the role user or assistant for 1 or is deleted for 2, as blank rows and duplicates
    have to be; an empty row of these roles is inserted for 5; a truncated row that stays costs 5.
    Of equally cheap edits those count whose initials come first in ASCII.

    ``report``: conversation, gaps, blank, duplicate, truncated, illegal, cost, audit. ``rows``:
    conversation, position (from 0), role, text.

    * A NULL conversation is one, a NULL role or text counts as one space, an empty role as another
      role than system, user and assistant. Turns are whole numbers.
    * Gaps beyond the largest long count as it.
    * Texts are taken whole; no task holds the rows of a conversation, only its audit.
    * An empty table gives empty results; other columns are neither read nor returned.
    """
    kind = rows.schema[conv_col].dataType
    name = F.when(F.col("conv") != "", F.substring("conv", 2, (1 << 31) - 1)).cast(kind).alias(conv_col)
    keyed = _keyed(rows, conv_col, turn_col, role_col, text_col)
    keys = materialise(_keys(keyed), "repair-keys")
    chunks = materialise(_chunks(keys, params.chunk), "repair-chunks")
    transfers = materialise(_transfers(chunks, params.grammar), "repair-transfers")
    pieces = materialise(_pieces(chunks, transfers), "repair-pieces")
    totals = pieces.where(F.col("cost").isNotNull()).select("conv", "illegal", "cost", "audit")
    report = _counts(keys).join(totals, "conv").select(
        name, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    kept = materialise(_kept(chunks, pieces), "repair-kept")
    texts = keyed.select("conv", "place", "role", "text").dropDuplicates(["conv", "place"])
    found = kept.where(F.col("place").isNotNull()).join(texts, ["conv", "place"])
    found = found.select("conv", "position", F.coalesce("new_role", "role").alias("role"), "text")
    added = kept.where(F.col("place").isNull())
    added = added.select("conv", "position", F.col("new_role").alias("role"), F.lit("").alias("text"))
    repaired = found.unionByName(added)
    return Repaired(report, repaired.select(name, "position", F.col("role").alias(role_col), F.col("text").alias(text_col)))


def digests(
    rows: DataFrame, conv_col: str = "conv_id", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conversation, sha256 of its rows as ``role:text`` lines in order of ``position``, joined by newlines.

    Each conversation is read by one task, as a digest has to be, but as a stream that holds no row.
    """
    line = F.concat(_spaced(role_col), F.lit(":"), _spaced(text_col)).cast("binary").alias("line")
    lines = rows.select(F.col(conv_col).alias("conv"), "position", line)
    ordered = lines.repartition("conv").sortWithinPartitions("conv", "position").select("conv", "line")
    kind = ordered.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            names, sums = [], []
            for name, line in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                if digest is None or name != conv:
                    if digest is not None:
                        names.append(conv)
                        sums.append(digest.hexdigest())
                    conv, digest = name, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(line)
            yield pa.RecordBatch.from_arrays([pa.array(names, batch.schema.field(0).type), pa.array(sums)], COLUMNS)
        if digest is not None:
            last = pa.array([conv], batch.schema.field(0).type)
            yield pa.RecordBatch.from_arrays([last, pa.array([digest.hexdigest()])], COLUMNS)

    return ordered.mapInArrow(run, f"conv {kind}, repaired_sha256 string").withColumnRenamed("conv", conv_col)


COLUMNS = ["conv", "repaired_sha256"]

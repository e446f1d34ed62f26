"""Tables in versions: data goes into new folders, and a pointer put last makes them the table.

A version is a base, the changes since then in order, and the counts kept of its rows. Its pointer is
a small file that names their folders. Readers take the newest pointer and pin what it names, so a
write that fails, at whatever point, leaves the table as it was. One writer at a time is assumed; a
second one finds its number taken and fails.

Changes are merged when the table is read, in order. Rows whose key no merged change holds are taken
as they are, with their filters pushed down to the scan; of the others the newest version counts. So
a batch costs what it holds. Compaction writes the merged rows as a new base, in an order that lets scans
skip data, when the changes are many or large.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pubwatch.operators.joins import dimension_join
from pubwatch.operators.sets import latest_versions
from pubwatch.session import delete, file_names, put_text, read_text, stored_bytes, written
from pubwatch.sources import curve

POINTERS = "_pointers"


def order_of(names: Sequence[str]) -> list[Column]:
    """Sort columns by name; a leading ``-`` means descending."""
    return [F.desc(n[1:]) if n.startswith("-") else F.asc(n) for n in names]


@dataclass(frozen=True)
class Layout:
    """How a base is written.

    ``bits``: columns of the curve and their share of it. ``lookups``: columns with Bloom filters.
    ``file_bytes``: size aimed at per file. ``options``: of the parquet writer.
    """

    bits: Mapping[str, int] = field(default_factory=dict)
    lookups: Sequence[str] = ()
    file_bytes: int = 256 << 20
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Upkeep:
    """Compaction comes at so many changes, or when they exceed a share of the base and a size.

    Folders that only pointers older than the last ``keep`` name are removed then.
    """

    changes: int = 32
    share: float = 0.25
    bytes: int = 64 << 20
    keep: int = 10


@dataclass(frozen=True)
class Change:
    """``merges``: its rows replace those of equal key; else they are added as they are."""

    folder: str
    merges: bool
    bytes: int


@dataclass(frozen=True)
class Version:
    number: int
    base: str
    bytes: int
    changes: tuple[Change, ...] = ()
    counts: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    newest: tuple[str, ...] = ()

    @property
    def folders(self) -> set[str]:
        return {self.base, *(c.folder for c in self.changes), *self.counts}


class VersionedTable:
    """A table at ``path``. ``key`` and ``newest`` tell which rows are versions of one another, and
    which of them counts; they are stored with the table. ``counts`` names groups to keep counts of.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: Sequence[str] = (),
        newest: Sequence[str] = (),
        layout: Layout = Layout(),
        counts: Callable[[], Mapping[str, Column]] | None = None,
        upkeep: Upkeep = Upkeep(),
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.newest = tuple(key), tuple(newest)
        self.layout, self.groups, self.upkeep = layout, counts, upkeep

    # Versions

    def versions(self) -> list[int]:
        return [int(n) for n in file_names(self.spark, f"{self.path}/{POINTERS}") if n.isdigit()]

    def version(self, number: int | None = None) -> Version | None:
        """The newest version, or one by its number; None where there is no table."""
        numbers = self.versions()
        if not numbers:
            return None
        number = numbers[-1] if number is None else number
        stored = json.loads(read_text(self.spark, self._pointer(number)))
        changes = tuple(Change(**c) for c in stored.pop("changes"))
        return Version(changes=changes, **{k: tuple(v) if isinstance(v, list) else v for k, v in stored.items()})

    def commit(self, version: Version) -> None:
        put_text(self.spark, self._pointer(version.number), json.dumps(asdict(version)))

    def _pointer(self, number: int) -> str:
        return f"{self.path}/{POINTERS}/{number:012d}"

    def _next(self, old: Version | None) -> int:
        return old.number + 1 if old else 1

    # Reading

    def read(self, version: Version | None = None) -> DataFrame | None:
        """The rows of the newest or of a pinned version; None where there is no table."""
        version = version or self.version()
        if version is None:
            return None
        rows, key = self._union([version.base]), version.key
        for merges, run in groupby(version.changes, lambda change: change.merges):
            new = self._union([change.folder for change in run])
            if merges:
                keys = new.select(*key).distinct()
                others = dimension_join(rows, keys, key, "left_anti", null_safe=True)
                new, rows = self._winners(rows, new, keys, version), others
            rows = rows.unionByName(new, allowMissingColumns=True)
        return rows

    def read_counts(self, version: Version | None = None) -> DataFrame:
        """Rows per group, from the counts alone."""
        version = version or self.version()
        names = list(self.groups())
        sums = self._union(list(version.counts)).groupBy(*names).agg(F.sum("n_rows").alias("n_rows"))
        return sums.where(F.col("n_rows") != 0)

    def _winners(self, rows: DataFrame, new: DataFrame, keys: DataFrame, version: Version) -> DataFrame:
        touched = dimension_join(rows, keys, version.key, "left_semi", null_safe=True)
        every = touched.unionByName(new, allowMissingColumns=True)
        return latest_versions(every, version.key, order_of(version.newest))

    def _union(self, folders: Sequence[str]) -> DataFrame:
        parts = [self.spark.read.parquet(f"{self.path}/{f}") for f in folders]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    # Writing

    def replace(
        self, rows: DataFrame, keep_order: bool = False, accept: Callable[[], bool] | None = None
    ) -> bool:
        """Make ``rows`` the whole table; tells whether they became it.

        With ``keep_order`` they are written in the order they have. ``accept`` is asked when they
        have been worked out; without it they are always accepted.
        """
        old = self.version()
        if accept is not None:
            with written(rows, "table-rows") as whole:
                return accept() and self.replace(whole, keep_order)
        folder, size = self._write_base(rows, keep_order)
        counts = self._write_counts(self._counted(self._union([folder])))
        self.commit(Version(self._next(old), folder, size, (), counts, self.key, self.newest))
        self._vacuum()
        return True

    def append(self, rows: DataFrame) -> None:
        """Add rows as they are."""
        self._change(rows, merges=False)

    def merge(self, rows: DataFrame) -> None:
        """Let rows replace older versions of their keys; a repeated call changes nothing."""
        self._change(rows, merges=True)

    def _change(self, rows: DataFrame, merges: bool) -> None:
        old = self.version()
        if old is None:
            self.replace(latest_versions(rows, self.key, order_of(self.newest)) if merges else rows)
            return
        folder = self._write(rows.hint("rebalance"), "change")
        new = self.spark.read.parquet(f"{self.path}/{folder}")
        if self.groups is None:
            counts = ()
        elif merges:
            counts = self._write_counts(self._moved(old, new))
        else:
            counts = self._write_counts(self._counted(new))
        change = Change(folder, merges, stored_bytes(self.spark, f"{self.path}/{folder}"))
        version = replace(
            old, number=self._next(old), changes=(*old.changes, change), counts=(*old.counts, *counts)
        )
        self.commit(version)
        size = sum(c.bytes for c in version.changes)
        limit = max(self.upkeep.bytes, self.upkeep.share * version.bytes)
        if len(version.changes) >= self.upkeep.changes or size > limit:
            self.compact()

    def compact(self) -> None:
        """Write the merged rows as a new base."""
        old = self.version()
        if old is None or not old.changes:
            return
        folder, size = self._write_base(self.read(old))
        counts = old.counts
        if self.groups is not None:
            counts = self._write_counts(self.read_counts(old))
        self.commit(replace(old, number=self._next(old), base=folder, bytes=size, changes=(), counts=counts))
        self._vacuum()

    def _vacuum(self) -> None:
        numbers = self.versions()
        old, kept = numbers[: -self.upkeep.keep], numbers[-self.upkeep.keep :]
        used = set().union(*(self.version(n).folders for n in kept))
        for number in old:
            for folder in self.version(number).folders - used:
                delete(self.spark, f"{self.path}/{folder}")
            delete(self.spark, self._pointer(number))

    def _write(self, rows: DataFrame, kind: str, options: Mapping[str, str] = {}) -> str:
        folder = f"{kind}-{uuid.uuid4().hex}"
        rows.write.options(**options).parquet(f"{self.path}/{folder}")
        return folder

    def _write_base(self, rows: DataFrame, keep_order: bool = False) -> tuple[str, int]:
        layout = self.layout
        if keep_order or not layout.bits:
            folder = self._write(rows if keep_order else rows.hint("rebalance"), "base", layout.options)
            return folder, stored_bytes(self.spark, f"{self.path}/{folder}")
        with written(rows, "table-rows") as whole:
            n = whole.count()
            size = stored_bytes(self.spark, whole.inputFiles()[0].rsplit("/", 1)[0]) if n else 0
            files = max(1, -(-size // layout.file_bytes))
            place = curve.position(layout.bits, curve.cuts(whole, layout.bits, n))
            order = ["_place", *layout.bits]
            placed = whole.withColumn("_place", place).repartitionByRange(files, *order)
            options = dict(layout.options)
            for name in layout.lookups:
                options[f"parquet.bloom.filter.enabled#{name}"] = "true"
                options[f"parquet.bloom.filter.expected.ndv#{name}"] = str(max(1, n // files))
            folder = self._write(placed.sortWithinPartitions(*order).drop("_place"), "base", options)
        return folder, stored_bytes(self.spark, f"{self.path}/{folder}")

    # Counts

    def _counted(self, rows: DataFrame, sign: int = 1) -> DataFrame | None:
        if self.groups is None:
            return None
        names = [column.alias(name) for name, column in self.groups().items()]
        return rows.groupBy(*names).agg((F.count("*") * sign).alias("n_rows"))

    def _moved(self, old: Version, new: DataFrame) -> DataFrame:
        """What a merge adds to the counts: new versions of its keys less the rows they replace."""
        keys, rows = new.select(*old.key).distinct(), self.read(old)
        gone = dimension_join(rows, keys, old.key, "left_semi", null_safe=True)
        signed = self._counted(gone, -1).unionByName(self._counted(self._winners(rows, new, keys, old)))
        names = list(self.groups())
        return signed.groupBy(*names).agg(F.sum("n_rows").alias("n_rows")).where("n_rows <> 0")

    def _write_counts(self, counted: DataFrame | None) -> tuple[str, ...]:
        return () if counted is None else (self._write(counted.hint("rebalance"), "counts"),)

"""Joins of works with the registry and other small tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
STREAM_PARTS = 8


def fits_broadcast(small: DataFrame, max_bytes: int | None = None) -> bool:
    """Measure a table before it is broadcast: bytes as text, and 16 per row and column besides."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in small.columns),
        F.lit(0),
    )
    size = small.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]
    return size <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    spread: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """Join a large table with one that is usually small.

    A dimension of measured, bounded size is broadcast, so the facts are not shuffled. A larger one
    is joined by shuffle, where adaptive execution splits the partitions of hot keys by their bytes.
    It does not do so for streams; there, facts are dealt to ``STREAM_PARTS`` parts per key by the
    hash of the ``spread`` columns, and the dimension is copied as often. A ``null_safe`` semi or
    anti join lets NULL keys meet.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not a facts-side join: {how}")
    if null_safe:
        dim = dim.select(*[F.col(k).alias(f"_{k}") for k in keys])
        met = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
        return facts.join(F.broadcast(dim) if fits_broadcast(dim) else dim, met, how)
    if fits_broadcast(dim):
        return facts.join(F.broadcast(dim), keys, how)
    if spread and facts.isStreaming:
        return spread_join(facts, dim, keys, how, spread)
    return facts.join(dim, keys, how)


def spread_join(
    facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str, spread: Sequence[str]
) -> DataFrame:
    """Shuffle join with every key in several parts. The result is that of the plain join."""
    part = F.pmod(F.xxhash64(*spread), F.lit(STREAM_PARTS)).cast("int")
    copies = dim.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(STREAM_PARTS - 1))))
    return facts.withColumn("_part", part).join(copies, [*keys, "_part"], how).drop("_part")


def enrich(works: DataFrame, journals: DataFrame, spread: Sequence[str] = ("work_id",)) -> DataFrame:
    """Attach subject, grade and registry order to each work of a registered journal."""
    return dimension_join(works, journals, "issn", "inner", spread)


def registered_works(
    works: DataFrame, journals: DataFrame, spread: Sequence[str] = ("work_id",)
) -> DataFrame:
    """Works of registered journals, unchanged."""
    return dimension_join(works, journals.select("issn"), "issn", "left_semi", spread)


def archive_with_grade(
    archive: DataFrame, metadata: DataFrame, spread: Sequence[str] = ("link",)
) -> DataFrame:
    """Archive rows with the grade that the metadata table has for their journal name.

    A name listed twice counts once, with its first grade in text order, so rows never multiply.
    """
    grades = metadata.groupBy("journal_name").agg(F.min("journal_grade").alias("journal_grade"))
    return dimension_join(archive, grades, "journal_name", "left", spread)


def grade_conflicts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Journals whose grade differs between two registry versions, or that only one of them has."""
    a = left.select("issn", F.col("grade").alias("left_grade"))
    b = right.select("issn", F.col("grade").alias("right_grade"))
    return a.join(b, "issn", "full_outer").where(~F.col("left_grade").eqNullSafe(F.col("right_grade")))


def silent_journals(journals: DataFrame, works: DataFrame) -> DataFrame:
    """Registry journals without a work. Works shrink to one row per journal before the shuffle."""
    return journals.join(works.select("issn").distinct(), "issn", "left_anti")

"""Unions, deduplication and newest versions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_batches(batches: Iterable[DataFrame]) -> DataFrame:
    """Rows of all batches, by column name."""
    return reduce(DataFrame.unionByName, batches)


def union_schema_drift(archive: DataFrame, rows: DataFrame) -> DataFrame:
    """Archive plus rows of an older or newer layout; columns only one side has become NULL."""
    return archive.unionByName(rows, allowMissingColumns=True)


def dedup_works(works: DataFrame, key: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """Works of overlapping pulls, each key once: the whole row that comes first in ``newest``."""
    return latest_versions(works, key, newest)


def latest_versions(rows: DataFrame, key: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the ``newest`` order, which must be total within a key.

    Only rank 1 is kept, so each map task sends one row per key and hot keys stay small.
    """
    order = Window.partitionBy(*key).orderBy(*newest)
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def upsert_rows(
    archive: DataFrame, new: DataFrame, key: Sequence[str], newest: Sequence[Column]
) -> DataFrame:
    """Archive with ``new`` merged in: the newest version of every key."""
    return latest_versions(archive.unionByName(new, allowMissingColumns=True), key, newest)

"""Exact duplicates: group by a 128-bit content hash, compare bytes inside the groups, keep one id.

Only DataFrame functions. A group is never gathered: hashes, ids and the byte comparison (smallest
and largest text of a hash) all merge in the map tasks, so a group with a third of all rows costs
each task one row. Texts move only for the byte comparison of hashes that more than one row has.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubwatch.llm.common import fresh, materialise

HashOf = Callable[[Column], Column]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; NULL is the empty text."""
    text = F.coalesce(text, F.lit(""))
    only_ascii = F.octet_length(text) == F.char_length(text)
    translated = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(only_ascii, F.lower(text)).otherwise(translated)


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _collided(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """Hashes under which two different texts lie, by comparing the bytes of each shared hash."""
    shared = groups.where(F.col("group_size") > 1).select("hash")
    spread = keyed.join(shared, "hash", "left_semi").groupBy("hash")
    bounds = spread.agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    return bounds.where(F.col("low") != F.col("high")).select("hash")


def _groups(rows: DataFrame, keys: list[str], keep: str) -> DataFrame:
    best = F.max if keep == "largest" else F.min
    return rows.groupBy(*keys).agg(best("id").alias("keep_id"), F.count("*").alias("group_size"))


def duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hash_of: HashOf = md5_128,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. ``keep`` names the id that stays.

    * A NULL text counts as empty; empty texts are equal to each other.
    * A NULL id takes part but is kept only if no row of its group has an id; keep_id is then NULL.
    * Rows that repeat the kept id are all marked kept; ``drop_duplicates`` returns one of them.
    * An empty table gives an empty result; other columns of ``docs`` are neither read nor returned.
    """
    keyed = docs.select(F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("norm"))
    keyed = keyed.withColumn("hash", hash_of(F.col("norm")))
    digest = F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")
    rows = materialise(keyed.select("id", "hash", digest), "dedup-hashes")
    groups = _groups(rows, ["hash"], keep)
    collided = materialise(_collided(keyed, groups), "dedup-collided")
    settled = rows.join(groups, "hash")
    if not collided.isEmpty():
        clean = settled.join(collided, "hash", "left_anti")
        rest = keyed.withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256))
        rest = rest.join(collided, "hash", "left_semi")
        settled = clean.unionByName(
            rest.join(_groups(rest, ["hash", "norm"], keep), ["hash", "norm"]).drop("norm")
        )
    return settled.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with all their columns.

    The rules are those of ``duplicate_groups``. Of rows that repeat the kept id and text, one stays.
    """
    marks = duplicate_groups(docs, id_col, text_col, keep).where("kept")
    key, digest, copies = (fresh(docs, n) for n in ("dedup_id", "dedup_digest", "dedup_copies"))
    kept = marks.groupBy(
        F.col("keep_id").alias(key), F.col("text_sha256").alias(digest)
    ).agg(F.count("*").alias(copies))
    own = docs.withColumn(digest, F.sha2(ascii_lower(F.col(text_col)).cast("binary"), 256))
    stays = own.join(kept, [own[digest] == kept[digest], own[id_col].eqNullSafe(kept[key])])
    stays = stays.select(*[own[c] for c in docs.columns], own[digest], kept[copies])
    single = stays.where(F.col(copies) == 1).select(*docs.columns)
    repeated = stays.where(F.col(copies) > 1).dropDuplicates([id_col, digest])
    return single.unionByName(repeated.select(*docs.columns))

"""Landed pages as they came: the envelope is a VARIANT, so that nothing a source sends is lost.

Keys, cursors and sizes are columns of their own, and chain checks read only these. A field that is
missing differs from one that is null, and fields that no schema declares stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pubwatch.functions import fixed
from pubwatch.sources import schemas
from pubwatch.sources.landing import INDEX, PAGE_GROUPS

WORKS = "array<variant>"
FIELDS = "map<string,variant>"


def land_raw_pages(spark: SparkSession, json_path: str, path: str) -> None:
    """Turn landed JSON lines into a parquet table of keys, number of works and envelope.

    A line that is no JSON object, or that names a key twice in one object, keeps its text in
    ``corrupt_line``. A key that does not have its declared type is NULL, as is one that is missing.
    """
    lines = spark.read.text(json_path).where(F.trim("value") != "")
    # A line is parsed once; whether it is an object shows in its first character.
    parsed = lines.select("value", F.try_parse_json("value").alias("whole"))
    is_object = F.col("value").rlike(r"^[ \t\r\n]*\{")
    parsed = parsed.select("value", F.when(is_object, F.col("whole")).alias("envelope"))
    keys = [
        F.try_variant_get("envelope", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
        for f in schemas.LANDED_PAGE.fields
        if f.name in INDEX
    ]
    works = F.size(F.try_variant_get("envelope", "$.results", WORKS))
    corrupt = F.when(F.col("envelope").isNull(), F.col("value"))
    pages = parsed.select(
        *keys,
        F.greatest(F.coalesce(works, F.lit(0)), F.lit(0)).cast("long").alias("n_works"),
        corrupt.alias(schemas.CORRUPT),
        "envelope",
    )
    pages.write.mode("overwrite").options(**PAGE_GROUPS).parquet(path)


def field_state(work: Column, path: str) -> Column:
    """``missing``, ``null`` or ``set``: what a source sent for a field."""
    value = F.try_variant_get(work, path, "variant")
    return F.when(value.isNull(), "missing").when(F.is_variant_null(value), "null").otherwise("set")


def title_as_sent(work: Column) -> Column:
    """The archive's title: the default stands in for a missing one only, a null one is empty."""
    state = field_state(work, "$.title")
    missing = F.when(state == "missing", F.lit(fixed.UNTITLED))
    return missing.otherwise(F.coalesce(F.try_variant_get(work, "$.title", "string"), F.lit("")))


def works_from_raw(pages: DataFrame, abstracts: bool = True) -> DataFrame:
    """Works of raw pages, one row each: the columns of ``works_from_pages``, then ``work`` as it came.

    A value that cannot be read as its declared type is NULL and leaves the others as they are.
    """
    work = F.col("work")
    exploded = pages.select("issn", F.explode(F.try_variant_get("envelope", "$.results", WORKS)).alias("work"))

    def got(path: str, kind: str) -> Column:
        return F.try_variant_get(work, path, kind)

    index = got("$.abstract_inverted_index", "map<string,array<int>>").alias("abstract_inverted_index")
    name = got("$.primary_location.source.display_name", "string")
    return exploded.select(
        got("$.id", "string").alias("work_id"),
        "issn",
        got("$.title", "string").alias("title"),
        got("$.publication_date", "string").try_cast("date").alias("publication_date"),
        F.coalesce(got("$.cited_by_count", "bigint"), F.lit(0)).alias("cited_by_count"),
        got("$.doi", "string").alias("doi"),
        got("$.id", "string").alias("id"),
        F.coalesce(name, F.lit(fixed.UNKNOWN_JOURNAL)).alias("journal_name"),
        *([index] if abstracts else []),
        "work",
    )


def _undeclared(value: Column, declared: T.StructType, path: str = "") -> list[Column]:
    """Per object that the schema knows: its entries that the schema does not name, with their paths."""
    fields = F.try_variant_get(value, f"$.{path}".rstrip("."), FIELDS)
    extra = F.map_filter(fields, lambda key, _: ~key.isin(declared.names))
    entries = F.transform(
        F.map_entries(extra),
        lambda e: F.struct(F.concat(F.lit(path), e["key"]).alias("field"), F.to_json(e["value"]).alias("value")),
    )
    nested = [
        column
        for f in declared.fields
        if isinstance(f.dataType, T.StructType)
        for column in _undeclared(value, f.dataType, f"{path}{f.name}.")
    ]
    return [F.coalesce(entries, F.array().cast("array<struct<field:string,value:string>>")), *nested]


def undeclared_fields(rows: DataFrame, column: str, declared: T.StructType, *keep: str) -> DataFrame:
    """``keep`` columns, field, value: one row per field of ``column`` that ``declared`` does not name.

    ``field`` is its path below ``column``, ``value`` its JSON. Shows what a source has begun to send.
    """
    found = F.concat(*_undeclared(F.col(column), declared))
    return rows.select(*keep, F.explode(found).alias("found")).select(*keep, "found.*")

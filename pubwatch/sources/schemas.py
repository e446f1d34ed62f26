"""Declared schemas. They are never inferred: the words of an inverted index would become columns."""

from __future__ import annotations

from pyspark.sql import types as T

#: the line itself where it is no whole JSON object; such a row is no page
CORRUPT = "corrupt_line"

WORK = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("doi", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("publication_date", T.StringType()),
        T.StructField("cited_by_count", T.LongType()),
        T.StructField(
            "primary_location",
            T.StructType(
                [
                    T.StructField(
                        "source", T.StructType([T.StructField("display_name", T.StringType())])
                    )
                ]
            ),
        ),
        T.StructField(
            "abstract_inverted_index", T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))
        ),
    ]
)

LANDED_PAGE = T.StructType(
    [
        T.StructField("issn", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("request_cursor", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("next_cursor", T.StringType()),
        T.StructField("results", T.ArrayType(WORK)),
        T.StructField("attempt", T.LongType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

JOURNAL = T.StructType(
    [
        T.StructField("issn", T.StringType()),
        T.StructField("journal_ord", T.IntegerType()),
        T.StructField("subject", T.StringType()),
        T.StructField("grade", T.StringType()),
    ]
)

ARCHIVE = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("journal_name", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("publication_date", T.DateType()),
        T.StructField("grade", T.StringType()),
        T.StructField("citations", T.LongType()),
        T.StructField("link", T.StringType()),
    ]
)

"""Journal registry: a dimension table that keeps its declaration order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubwatch.sources import schemas

# The monitored journals (ISSN, subject, grade). Their order decides which works
# fill a subject first.
JOURNALS = (
    ("0355-3140", "Occupational Health", "Q1"),
    ("1351-0711", "Occupational Health", "Q1"),
    ("1076-2752", "Occupational Health", "Q2"),
    ("1097-0274", "Occupational Health", "Q2"),
    ("1432-1246", "Occupational Health", "Q2"),
    ("1348-9585", "Occupational Health", "Q2"),
    ("2165-0969", "Occupational Health", "Q2"),
    ("0925-7535", "Occupational Safety", "Q1"),
    ("0022-4375", "Occupational Safety", "Q1"),
    ("0001-4575", "Occupational Safety", "Q1"),
    ("2093-7997", "Occupational Safety", "Q1"),
    ("0950-4230", "Occupational Safety", "Q1"),
    ("1080-3548", "Occupational Safety", "Q2"),
    ("2398-7316", "Occupational Hygiene", "Q1"),
    ("1545-9632", "Occupational Hygiene", "Q1"),
    ("1438-4639", "Occupational Hygiene", "Q1"),
    ("1559-064X", "Occupational Hygiene", "Q1"),
    ("1939-1307", "Occ. Health & Stress", "Q1"),
    ("1464-5335", "Occ. Health & Stress", "Q1"),
    ("0021-9010", "Applied Psych & Org Behavior", "Q1"),
    ("1099-1379", "Applied Psych & Org Behavior", "Q1"),
    ("0001-8791", "Applied Psych & Org Behavior", "Q1"),
    ("0149-2063", "Applied Psych & Org Behavior", "Q1"),
    ("0018-7267", "Applied Psych & Org Behavior", "Q1"),
    ("0003-6870", "General & Physical Ergonomics", "Q1"),
    ("0018-7208", "General & Physical Ergonomics", "Q1"),
    ("0014-0139", "General & Physical Ergonomics", "Q1/Q2"),
    ("0169-8141", "General & Physical Ergonomics", "Q2"),
    ("1463-922X", "General & Physical Ergonomics", "Q2"),
    ("1053-0487", "Musculoskeletal Health", "Q1"),
    ("0021-9290", "Musculoskeletal Health", "Q1/Q2"),
    ("0268-0033", "Musculoskeletal Health", "Q2"),
    ("1471-2474", "Musculoskeletal Health", "Q2"),
    ("0966-6362", "Musculoskeletal Health", "Q2"),
    ("1071-5819", "Cognitive Ergonomics & HCI", "Q1"),
    ("2168-2291", "Cognitive Ergonomics & HCI", "Q1"),
    ("1044-7318", "Cognitive Ergonomics & HCI", "Q1"),
    ("1436-6556", "Cognitive Ergonomics & HCI", "Q1/Q2"),
    ("1520-6564", "Cognitive Ergonomics & HCI", "Q2"),
)


def default_journals(spark: SparkSession) -> DataFrame:
    """The monitored journals as a registry table."""
    rows = [(issn, i, subject, grade) for i, (issn, subject, grade) in enumerate(JOURNALS)]
    return spark.createDataFrame(rows, schemas.JOURNAL)


def load_journals(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A registry from storage. The order column is part of the table, not of the file layout."""
    reader = spark.read.schema(schemas.JOURNAL)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def uniform_grade(journals: DataFrame, grade: str = "Q1") -> DataFrame:
    """The archive job's own registry version, which gives every journal one grade."""
    return journals.withColumn("grade", F.lit(grade))

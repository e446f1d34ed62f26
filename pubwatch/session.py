"""Shared storage for tables that a job writes and reads again.

Cut lineage goes through a written table, not through executor-local blocks: it survives the loss
of any executor, and each reader prunes its own columns.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or set as the context's checkpoint folder."""
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses.

    All paths of one application lie in one folder, which can go when the application has ended.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/pubwatch/{application}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores.

    For work on long texts above a small scan: a file with one row group is one split.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Remove a written table through its own file system."""
    place, files = _place(spark, path)
    files.delete(place, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of its file system."""
    place, files = _place(spark, path)
    return re.sub(r"^file:/+", "file:///", files.makeQualified(place).toString())


def stored_bytes(spark: SparkSession, path: str) -> int:
    place, files = _place(spark, path)
    return files.getContentSummary(place).getLength()


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, sorted; none where there is no folder."""
    place, files = _place(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    place, files = _place(spark, path)
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file that appears whole or not at all; an existing one is an error."""
    place, files = _place(spark, path)
    whole, _ = _place(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(whole, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if files.exists(place) or not files.rename(whole, place):
        files.delete(whole, False)
        raise FileExistsError(f"{path} was written by someone else")


@contextmanager
def written(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` as a written table that is gone after the block."""
    path = new_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete(df.sparkSession, path)

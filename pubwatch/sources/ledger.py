"""A ledger of answers that were paid for: digest of the request, answer, attempts.

Tasks put every call's answers into a file of their own before they go on, so a task that runs again
finds what it had. Later runs leave out every request that the ledger answers. Only answers are kept,
no errors. The store has to be one that pyarrow opens (a shared folder, HDFS, S3).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubwatch.session import file_names, qualified

SCHEMA = "digest string, response string, attempts bigint"
ARROW = pa.schema([("digest", pa.string()), ("response", pa.string()), ("attempts", pa.int64())])


def answers(spark: SparkSession, path: str) -> DataFrame:
    """One answer per digest; a text that two tasks sent at the same time has the lesser one."""
    if not file_names(spark, path):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    one = rows.groupBy("digest").agg(F.min(F.struct("response", "attempts")).alias("one"))
    return one.select("digest", "one.*")


@dataclass(frozen=True)
class Ledger:
    """The part of a ledger that one run writes, as tasks use it."""

    uri: str
    run: str

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Ledger:
        return cls(qualified(spark, path), uuid.uuid4().hex)

    def _folder(self, digests: Sequence[str]) -> tuple[fs.FileSystem, str]:
        store, root = fs.FileSystem.from_uri(self.uri)
        return store, f"{root}/run-{self.run}/{hashlib.sha256(''.join(digests).encode()).hexdigest()}"

    def found(self, digests: Sequence[str]) -> dict[str, tuple[str, int]]:
        """What earlier tries of the same batch of requests have put down."""
        store, folder = self._folder(digests)
        found = {}
        for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if info.base_name.endswith(".parquet"):
                for row in pq.read_table(info.path, filesystem=store, schema=ARROW).to_pylist():
                    found[row["digest"]] = row["response"], row["attempts"]
        return found

    def put(self, digests: Sequence[str], rows: Sequence[tuple[str, str, int]]) -> None:
        """Answers of one call, in a file that appears whole. ``digests`` are those of the batch."""
        if not rows:
            return
        store, folder = self._folder(digests)
        store.create_dir(folder, recursive=True)
        name = uuid.uuid4().hex
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW.types, strict=True)]
        pq.write_table(pa.Table.from_arrays(columns, schema=ARROW), f"{folder}/_{name}", filesystem=store)
        store.move(f"{folder}/_{name}", f"{folder}/{name}.parquet")

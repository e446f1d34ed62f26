"""Incremental versions of the daily and weekly runs.

Sources are folders that new files land in. Every job processes what is there and stops
(``availableNow``); its checkpoint lets the next call go on from there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pubwatch.functions.times import utc_wall_clock
from pubwatch.operators.joins import enrich
from pubwatch.sources.schemas import CORRUPT
from pubwatch.sources.tables import upsert_table


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    file_filter: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A folder of landed files as a stream, with a declared schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "json":
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if file_filter is not None:
        reader = reader.option("pathGlobFilter", file_filter)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append every new row of the stream to the parquet table at ``path``, each exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_stream(
    stream: DataFrame, write: Callable[[DataFrame], None], checkpoint: str, mode: str = "append"
) -> None:
    """Hand each micro-batch to ``write``, which must give the same table when it is repeated."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(lambda batch, _: write(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def dedup_stream(stream: DataFrame, key: Sequence[str], event_time: str, slack: str) -> DataFrame:
    """One row per key. Copies may come up to ``slack`` apart; state is dropped after it.

    Rows later than ``slack`` are dropped too. Where no row may be lost, use :func:`upsert_stream`.
    """
    return stream.withWatermark(event_time, slack).dropDuplicatesWithinWatermark(list(key))


def window_counts(
    stream: DataFrame, key: str, event_time: str, length: str, slide: str | None = None, slack: str = "1 day"
) -> DataFrame:
    """Rows per key and event-time window, tumbling or, with ``slide``, sliding.

    Windows start at multiples of their step from 1970-01-01 UTC. Appending the result gives closed
    windows only; :func:`keep_windows` has the open ones too. Either way the state of a window goes
    when the watermark has passed it. For long windows that slide by a day, count days and sum them
    up with :func:`rolling_counts`, which keeps a row's state once, not once per window.
    """
    span = F.window(event_time, length, slide)
    return (
        stream.withWatermark(event_time, slack)
        .groupBy(span.alias("span"), key)
        .agg(F.count("*").alias("n_events"))
        .select(
            utc_wall_clock(F.col("span.start")).alias("window_start"),
            utc_wall_clock(F.col("span.end")).alias("window_end"),
            key,
            "n_events",
        )
    )


def keep_windows(counts: DataFrame, path: str, checkpoint: str, key: str) -> None:
    """Keep the current count of every window as a table: each batch writes the windows it changed.

    Counts only grow, so the larger one is the newer one, also when a batch is repeated.
    ``read_archive`` has the newest counts.
    """
    batch_stream(
        counts, lambda batch: upsert_table(path, batch, ["window_start", key], ["-n_events"]), checkpoint, "update"
    )


def rolling_counts(daily: DataFrame, key: str, days: int = 7) -> DataFrame:
    """Counts of ``days`` days, starting every day, from the daily counts of :func:`keep_windows`."""
    back = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    start = F.col("window_start") - F.make_dt_interval(F.col("back"))
    return (
        daily.select("window_start", key, "n_events", back.alias("back"))
        .groupBy(start.alias("window_start"), key)
        .agg(F.sum("n_events").alias("n_events"))
        .select(
            "window_start",
            (F.col("window_start") + F.make_dt_interval(F.lit(days))).alias("window_end"),
            key,
            "n_events",
        )
    )


def enrich_stream(stream: DataFrame, journals: DataFrame, spread: Sequence[str]) -> DataFrame:
    """Stream joined with the static registry."""
    return enrich(stream, journals, spread)


def upsert_stream(
    stream: DataFrame, path: str, checkpoint: str, key: Sequence[str], newest: Sequence[str]
) -> None:
    """Merge each micro-batch into the table at ``path``: the newest version of each key counts."""
    batch_stream(stream, lambda batch: upsert_table(path, batch, key, newest), checkpoint)

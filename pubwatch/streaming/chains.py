"""The stop rule of a pull on a stream: pages of a journal count up to the first that does not follow.

Pages may land in any order, over any number of micro-batches. Per journal the state holds the page
and cursor that are waited for, and the keys of pages that came early; works stay in the landed table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from pubwatch.functions import fixed
from pubwatch.operators.joins import dimension_join
from pubwatch.sources.landing import is_page, n_results
from pubwatch.streaming.jobs import append_stream

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class PageChain(StatefulProcessor):
    """Releases the pages of one pull of one journal in order, as soon as each follows the one before."""

    def __init__(self, key: Sequence[str], patience_ms: int) -> None:
        self.key, self.patience_ms = list(key), patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.awaited = handle.getValueState("awaited", "page_no bigint, cursor string, closed boolean")
        self.early = handle.getMapState(
            "early", "page_no bigint, cursor string", "next_cursor string, n_works bigint"
        )

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        page_no, cursor, closed = self.awaited.get() if self.awaited.exists() else (1, fixed.FIRST_CURSOR, False)
        if closed:
            return
        for row in rows:
            spot = (row.page_no, row.request_cursor)
            if row.page_no >= page_no and not self.early.containsKey(spot):
                self.early.updateValue(spot, (row.next_cursor, row.n_works))
        outcome = None
        while outcome is None and cursor is not None and self.early.containsKey((page_no, cursor)):
            following, n_works = self.early.getValue((page_no, cursor))
            self.early.removeKey((page_no, cursor))
            if n_works == 0:
                outcome = "end"
            else:
                yield self._row(key, page_no, n_works, "kept")
                page_no, cursor = page_no + 1, following
                if following is None:
                    outcome = "end"
        if outcome:
            yield self._row(key, page_no, None, outcome)
            self.early.clear()
        self.awaited.update((page_no, cursor, outcome is not None))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if outcome is None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[Row]:
        page_no, cursor, closed = self.awaited.get()
        if not closed:
            self.awaited.update((page_no, cursor, True))
            self.early.clear()
            yield self._row(key, page_no, None, "broken")

    def close(self) -> None: ...

    def _row(self, key: tuple, page_no: int, n_works: int | None, outcome: str) -> Row:
        return Row(**dict(zip(self.key, key, strict=True)), page_no=page_no, n_works=n_works, outcome=outcome)


def follow_chains(
    pages: DataFrame, path: str, checkpoint: str, patience_ms: int = 3_600_000, key: Sequence[str] = ("issn",)
) -> None:
    """Append key, page_no, n_works and outcome of newly released pages to the table at ``path``.

    ``pages`` is a stream of landed pages; ``key`` names the journal and, where pulls share a folder,
    the pull. A page is ``kept`` when it came back whole, has works and was asked for with the cursor
    of the page before; of several whole copies the first to land counts. A journal's ``end`` is an
    empty page or one without a next cursor. When nothing has followed for ``patience_ms``, the chain
    is ``broken`` at the page waited for, and what comes later is left out.
    """
    known = [f.simpleString().replace(":", " ", 1) for f in pages.select(*key).schema.fields]
    schema = ", ".join([*known, "page_no bigint", "n_works bigint", "outcome string"])
    whole = pages.where(is_page() & (F.col("status") == 200) & F.col("request_cursor").isNotNull())
    keys = whole.select(*key, "page_no", "request_cursor", "next_cursor", n_results().alias("n_works"))
    released = keys.groupBy(*key).transformWithState(
        statefulProcessor=PageChain(key, patience_ms),
        outputStructType=schema,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
    with keyed_state(pages.sparkSession):
        append_stream(released, path, checkpoint)


def released_pages(landed: DataFrame, released: DataFrame, key: Sequence[str] = ("issn",)) -> DataFrame:
    """The landed pages that a stream has released, each once."""
    kept = released.where("outcome = 'kept'").select(*key, "page_no")
    once = dimension_join(landed.where(is_page() & (F.col("status") == 200)), kept, [*key, "page_no"], "left_semi")
    return once.dropDuplicates([*key, "page_no"])


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Settings that keyed state needs; they hold for the queries started meanwhile.

    The state store lies on disk. Batches without data are off: with timers of the wall clock they
    would follow one another for ever. Timers are looked at whenever a batch has data.
    """
    settings = {PROVIDER: ROCKS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)

"""A stream that ends by itself when all seeds, and all places they found, are done."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

METRICS = "barrier"
COUNTS = ("seeds_done", "places_found", "places_done")


class Barrier(StreamingQueryListener):
    """Adds up the counts that micro-batches observe; reached once seeds and places are done.

    A batch that is reported twice counts once.  done: what earlier runs of the stream had counted.
    """

    def __init__(self, seeds: int, done: dict[str, int] | None = None):
        self.seeds, self.before, self.batches = seeds, done or {}, {}
        self.query_id: str | None = None
        self.reached = threading.Event()

    def total(self, name: str) -> int:
        return self.before.get(name, 0) + sum(b[name] for b in self.batches.values())

    def add(self, batch: int, counts: dict[str, int]) -> None:
        self.batches[batch] = counts
        if self.total("seeds_done") >= self.seeds and self.total("places_done") >= self.total("places_found"):
            self.reached.set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        row = progress.observedMetrics.get(METRICS)
        if row is not None and (self.query_id is None or str(progress.id) == self.query_id):
            self.add(progress.batchId, {c: row[c] or 0 for c in COUNTS})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def observed(events: DataFrame, seeds_done: Column, places_found: Column, places_done: Column) -> DataFrame:
    """events, with the counts of each micro-batch as observed metrics: sums of whole numbers, in the pass that is made anyway."""
    return events.observe(METRICS, *[F.sum(c.cast("long")).alias(name) for name, c in zip(COUNTS, (seeds_done, places_found, places_done), strict=True)])


def run_until_done(stream: DataFrame, barrier: Barrier, checkpoint: str, write: Callable[[DataFrame, int], None], every: str = "1 second", timeout_s: float | None = None) -> bool:
    """Runs a stream (of observed rows) until the barrier is reached, and stops it; False if the time ran out first.

    An error of the stream is raised.
    """
    spark = stream.sparkSession
    spark.streams.addListener(barrier)
    query: StreamingQuery | None = None
    try:
        query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=every).foreachBatch(write).start()
        barrier.query_id = str(query.id)
        waited = 0.0
        while not barrier.reached.wait(0.2):
            waited += 0.2
            if not query.isActive:
                query.awaitTermination()
                break
            if timeout_s is not None and waited >= timeout_s:
                break
        return barrier.reached.is_set()
    finally:
        if query is not None and query.isActive:
            query.stop()
        spark.streams.removeListener(barrier)

"""Counts of the rows that stateful streaming operators drop as late, and of those they hold."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener


class LateRows(StreamingQueryListener):
    """Listens to the queries of a session while it is open (``with``).

    ``dropped`` adds up, over all batches, the rows that came behind the watermark;
    ``duplicates`` those a deduplication found in its state; ``held`` is the number of rows
    in the state after the last batch, ``read`` the input rows. Progress reports are
    complete when a query has terminated."""

    def __init__(self, spark: SparkSession, wait_s: float = 60.0):
        self.spark, self.wait_s = spark, wait_s
        self.dropped = self.duplicates = self.held = self.read = 0
        self._running = 0
        self._changed = threading.Condition()

    def __enter__(self) -> LateRows:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        with self._changed:
            complete = self._changed.wait_for(lambda: self._running == 0, self.wait_s)
        self.spark.streams.removeListener(self)
        if not complete and failure[0] is None:
            raise TimeoutError("a query's progress was not reported in time")

    def onQueryStarted(self, event) -> None:  # called before start() returns
        with self._changed:
            self._running += 1

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._changed:
            self.dropped += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
            self.duplicates += sum(s.customMetrics.get("numDroppedDuplicateRows", 0) for s in progress.stateOperators)
            self.read += progress.numInputRows
            if progress.stateOperators:
                self.held = sum(s.numRowsTotal for s in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._running -= 1
            self._changed.notify_all()


def drain(query, timeout_s: float | None = None) -> None:
    """Wait until a query has drained its files; stop it and raise where it takes longer."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError("the stream did not drain in time")

"""Rates of a running ingest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql.streaming.listener import StreamingQueryListener


class RateListener(StreamingQueryListener):
    """Calls ``tell(rows so far, rows a second, seconds left or None)`` after each batch;
    ``total`` is the number of rows expected, if known."""

    def __init__(self, tell: Callable[[int, float, float | None], None], total: int | None = None):
        self.tell, self.total, self.seen = tell, total, 0

    def onQueryStarted(self, event) -> None:
        self.seen = 0

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.seen += p.numInputRows
        rate = p.processedRowsPerSecond or 0.0
        left = (self.total - self.seen) / rate if self.total is not None and rate else None
        self.tell(self.seen, rate, left)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

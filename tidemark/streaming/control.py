"""Starting, stopping, repositioning and resetting a running ingest; exit codes; watching for failure."""

from __future__ import annotations

import logging
import re
import signal
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)

OK, STAGE_DIED, BAD_CONFIG, SNAPSHOT_FAILED, BAD_MODE = 0, 1, 2, 3, 4


def parse_position(text: str) -> tuple[str, int]:
    m = re.fullmatch(r"([^:]+):(\d+)", text.strip())
    if m is None:
        raise ValueError(f"a position is file:number, not {text!r}")
    return m[1], int(m[2])


def start_position(forced=None, checkpoint=None, last_event=None, saved=None, current=None):
    """Where to read from: the first of these that is known."""
    return next((p for p in (forced, checkpoint, last_event, saved, current) if p), None)


class Watch(StreamingQueryListener):
    """Tells of queries that end with an error, and logs progress."""

    def __init__(self, on_failure: Callable[[str, str], None] | None = None):
        self.on_failure = on_failure

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        log.debug("batch %s: %s rows, %s rows/s", p.batchId, p.numInputRows, p.processedRowsPerSecond)

    def onQueryIdle(self, event) -> None:
        log.debug("query %s is idle", event.id)

    def onQueryTerminated(self, event) -> None:
        if event.exception and self.on_failure is not None:
            self.on_failure(str(event.id), event.exception)


class Controller:
    """Signals only set flags; the loop in run() acts on them."""

    def __init__(self, begin: Callable[[str, tuple[str, int] | None], StreamingQuery], checkpoint: str, reset: Callable[[], None] | None = None, poll: float = 0.5):
        """begin(checkpoint, position): starts the query, from a log position if one is given."""
        self.begin, self.checkpoint, self.clear, self.poll = begin, checkpoint, reset, poll
        self.query: StreamingQuery | None = None
        self.wants_stop = self.wants_reset = False
        self.wants_position: tuple[str, int] | None = None

    def listen(self) -> None:
        signal.signal(signal.SIGTERM, lambda *_: self.stop())
        signal.signal(signal.SIGINT, lambda *_: self.stop())
        signal.signal(signal.SIGUSR1, lambda *_: self.reset())

    def stop(self) -> None:
        self.wants_stop = True

    def reset(self) -> None:
        self.wants_reset = True

    def reposition(self, position: str) -> None:
        self.wants_position = parse_position(position)

    def status(self) -> dict:
        progress = self.query.lastProgress if self.query else None
        return {"active": bool(self.query and self.query.isActive), "progress": progress}

    def run(self, position: tuple[str, int] | None = None) -> int:
        """0 when stopped, reset or out of work; 1 if the query failed."""
        self.query = self.begin(self.checkpoint, position)
        while True:
            if self.wants_stop or self.wants_reset:
                self.query.stop()
                if self.wants_reset and self.clear is not None:
                    self.clear()
                return OK
            if self.wants_position is not None:
                self.query.stop()
                (file, pos), self.wants_position = self.wants_position, None
                self.checkpoint = f"{self.checkpoint}-{file}-{pos}-{time.time_ns()}"  # a new query reads all files again
                self.query = self.begin(self.checkpoint, (file, pos))
            if not self.query.isActive:
                return STAGE_DIED if self.query.exception() else OK
            time.sleep(self.poll)


def watch(spark: SparkSession, on_failure: Callable[[str, str], None]) -> Watch:
    listener = Watch(on_failure)
    spark.streams.addListener(listener)
    return listener

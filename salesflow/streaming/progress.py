"""Counters of a running or finished stream."""

from __future__ import annotations

import threading
import time
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


# The metric of a query that counts its late records by itself.
LATE_METRIC = "late_records"


class _Counters(StreamingQueryListener):
    """Adds up the progress reports of every run, from its first micro-batch on."""

    def __init__(self) -> None:
        self.late = defaultdict(int)
        self.read = defaultdict(int)
        self.last: dict[str, str] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run = str(progress.runId)
        self.late[run] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        observed = progress.observedMetrics.get(LATE_METRIC)
        self.late[run] += (observed.records or 0) if observed is not None else 0
        self.read[run] += progress.numInputRows
        self.last[run] = progress.timestamp

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


_counters: dict[str, _Counters] = {}
_lock = threading.Lock()


def watch(spark: SparkSession) -> None:
    """Count the streams that start from now on. The sinks call it; other streams' owners must."""
    with _lock:
        application = spark.sparkContext.applicationId
        if application not in _counters:
            _counters[application] = _Counters()
            spark.streams.addListener(_counters[application])


def _counted(query: StreamingQuery, limit_seconds: float = 10) -> tuple[_Counters, str]:
    """The counters, once they hold the latest report: reports reach them a little later."""
    run = str(query.runId)
    counters = _counters.get(SparkSession.active().sparkContext.applicationId)
    if counters is None:
        raise ValueError("call watch(spark) before the stream starts")
    limit = time.monotonic() + limit_seconds
    while time.monotonic() < limit:
        last = query.lastProgress
        if not last or counters.last.get(run, "") >= last.timestamp:
            if query.isActive or run in counters.ended:
                return counters, run
        time.sleep(0.02)
    raise TimeoutError(f"the last report of {run} has not arrived after {limit_seconds} seconds")


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark since the query's start.

    ``event_windows`` counts records. Spark's windowed aggregate counts after partial aggregation: late
    rows of one key and window in one task count once.
    """
    counters, run = _counted(query)
    return counters.late[run]


def input_rows(query: StreamingQuery) -> int:
    counters, run = _counted(query)
    return counters.read[run]


def wait_for_timers(query: StreamingQuery, limit_seconds: float = 6 * 3600) -> None:
    """Wait until a batch without input has left no state: all windows have been emitted.

    A query with processing-time timers runs batches without input for ever, so there is no point
    at which Spark itself calls it done.
    """
    limit = time.monotonic() + limit_seconds
    while query.isActive:
        last = query.lastProgress
        if last and last.numInputRows == 0 and not any(o.numRowsTotal for o in last.stateOperators):
            _wait_between_batches(query)
            return
        if time.monotonic() > limit:
            raise TimeoutError(f"state is not empty after {limit_seconds} seconds")
        time.sleep(0.2)
    if query.exception() is not None:
        raise query.exception()


def _wait_between_batches(query: StreamingQuery, limit_seconds: float = 5) -> None:
    """Give a stop that follows the chance not to interrupt a batch."""
    limit = time.monotonic() + limit_seconds
    while query.status["isTriggerActive"] and time.monotonic() < limit:
        time.sleep(0.01)

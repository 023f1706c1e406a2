"""The four jobs, from messages to table. ``messages`` is a stream with the JSON in ``value``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from salesflow.operators.decode import (
    decode_sales,
    good_sales,
    quarantined,
    sale_rows,
    strict_sales,
)
from salesflow.operators.windows import (
    DELAY,
    NO_LATENESS,
    SIZE,
    longer_delay,
    tumbling_totals,
    with_event_time,
)
from salesflow.schema import QUARANTINE, SALE, WINDOW_TOTAL, check_schema, totals_table
from salesflow.sources.topic import TOPIC_ARRIVAL
from salesflow.streaming.arrival import WINDOW_MILLIS, stream_arrival_totals
from salesflow.streaming.event_windows import stream_event_windows
from salesflow.streaming.running import stream_running_totals
from salesflow.streaming.sinks import Target, append_batch, append_each_batch, append_stream, read_appended


class Job(NamedTuple):
    """The query that fills the table, and, if they are separate, the one that keeps refused messages and the
    one that decodes for both."""

    main: StreamingQuery
    quarantine: StreamingQuery | None = None
    decoder: StreamingQuery | None = None

    def await_termination(self) -> None:
        """Wait for all; if one fails, stop the others and raise."""
        running = [query for query in self if query is not None]
        try:
            while running:
                running = [query for query in running if not query.awaitTermination(1)]
        except Exception:
            self.stop()
            raise

    def stop(self) -> None:
        for query in self:
            if query is not None:
                query.stop()


def _both_tables(
    decoded: DataFrame, target: Target, handle: Callable[[DataFrame, int], None]
) -> Job:
    """Per micro-batch, append the refused messages and ``handle`` the sales, from one decoding."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            refused = target.for_quarantine()
            append_batch(quarantined(batch), batch_id, refused, target.checkpoint).unpersist()
            handle(good_sales(batch), batch_id)
        finally:
            batch.unpersist()

    return Job(append_each_batch(decoded, target, step))


def _from_one_decoding(
    messages: DataFrame, target: Target, unknown_fields: str, start: Callable[[DataFrame], StreamingQuery]
) -> Job:
    """``start`` a query over the sales, for jobs whose state Spark keeps: what such a query refuses ahead of its
    state cannot be written from within it.

    With a quarantine the messages are decoded once, into a table beside the checkpoint, from which the
    sales and the quarantine are both streamed; it grows with the topic and holds what a restart needs, so
    clear it only together with the checkpoint. With ``available_now`` the decoding ends before the others start.
    """
    decoded = decode_sales(messages, unknown_fields=unknown_fields)
    if target.quarantine is None:
        return Job(start(strict_sales(decoded)))
    to = target.for_decoded()
    decoder = append_stream(decoded, to, decoded.schema)
    if target.available_now:
        decoder.awaitTermination()
    try:
        refused = append_stream(quarantined(read_appended(decoded, to)), target.for_quarantine(), QUARANTINE)
        try:
            return Job(start(good_sales(read_appended(decoded, to))), refused, decoder)
        except Exception:
            refused.stop()
            raise
    except Exception:
        decoder.stop()
        raise


def land_sales(messages: DataFrame, target: Target, unknown_fields: str = "ignore") -> Job:
    """Decode the messages and append the sales unchanged."""
    decoded = decode_sales(messages, unknown_fields=unknown_fields)

    def land(sales: DataFrame, batch_id: int) -> None:
        append_batch(check_schema(sale_rows(sales), SALE), batch_id, target).unpersist()

    if target.quarantine is None:  # the same layout, so that a quarantine can come and go
        return Job(append_each_batch(decoded, target, lambda batch, batch_id: land(strict_sales(batch), batch_id)))
    return _both_tables(decoded, target, land)


def running_totals(
    messages: DataFrame,
    target: Target,
    arrival: str | Sequence[str] = TOPIC_ARRIVAL,
    unknown_fields: str = "ignore",
    **options,
) -> Job:
    """Append the sales that move their product's clock forward, with the running total."""
    return _from_one_decoding(
        messages, target, unknown_fields, lambda sales: stream_running_totals(sales, target, arrival, **options)
    )


def processing_time_totals(
    messages: DataFrame,
    target: Target,
    size_millis: int = WINDOW_MILLIS,
    unknown_fields: str = "ignore",
    **options: str,
) -> Job:
    """Append the total per product and 30 seconds of arrival time.

    Windows close by the clock, so the job runs until it is stopped.
    """
    if target.available_now:
        raise ValueError("arrival windows close by the clock: run the job with `every`")
    table = totals_table(WINDOW_TOTAL, options.get("overflow", "error"))

    def start(sales: DataFrame) -> StreamingQuery:
        return append_stream(stream_arrival_totals(sales, size_millis=size_millis, **options), target, table)

    return _from_one_decoding(messages, target, unknown_fields, start)


def event_time_totals(
    messages: DataFrame,
    target: Target,
    size: str = SIZE,
    delay: str = DELAY,
    lateness: str = NO_LATENESS,
    unknown_fields: str = "ignore",
    refires: bool = False,
    **options: str,
) -> Job:
    """Append the total per product and 30 seconds of event time, once the window has closed.

    ``lateness`` keeps windows open longer: one later row with the late sales in it. With ``refires`` the row comes
    at the window's end and corrected ones follow, one per micro-batch with late sales, until the lateness is over.
    ``target.late`` keeps sales that are later still; it and ``refires`` use ``event_windows``, which counts late records one by one.
    """
    by_record = refires or target.late is not None
    if by_record and lateness != NO_LATENESS and not refires:
        raise ValueError("a table of late sales with lateness needs refires")
    table = totals_table(WINDOW_TOTAL, options.get("overflow", "error"))

    def start(sales: DataFrame) -> StreamingQuery:
        if by_record:
            return stream_event_windows(sales, target, size, delay, lateness, **options)
        timed = with_event_time(sales, "EventProcessingTime", longer_delay(delay, lateness))
        return append_stream(tumbling_totals(timed, size=size, **options), target, table)

    return _from_one_decoding(messages, target, unknown_fields, start)

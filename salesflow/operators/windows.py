"""Per-key totals over tumbling time windows, on batch data and on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions.amounts import narrow
from salesflow.functions.guards import batch_only, known, without_nulls
from salesflow.functions.ids import window_id
from salesflow.schema import WINDOW_TOTAL

# The window size of both window jobs and the out-of-orderness bound.
SIZE = "30 seconds"
DELAY = "10 seconds"
NO_LATENESS = "0 seconds"


def interval(text: str) -> Column:
    return F.expr(f"interval {text}")


def longer_delay(delay: str, lateness: str) -> str:
    """``delay`` plus ``lateness`` as one interval text for ``withWatermark``."""
    return delay if lateness == NO_LATENESS else f"{delay} {lateness}"


def with_event_time(df: DataFrame, time: str, delay: str = DELAY) -> DataFrame:
    """Declare the event-time column of a stream and how far out of order it may be.

    Watermarks need the zoned type, so a zone-less time is read in the session zone (UTC).
    """
    zoned = known(time, "time").cast("timestamp")
    return df.withColumn(time, zoned).withWatermark(time, delay)


def tumbling_totals(
    df: DataFrame,
    key: str = "ProductName",
    time: str = "EventProcessingTime",
    amount: str = "SalesAmount",
    size: str = SIZE,
    overflow: str = "error",
    id: str = "random",
    stamp: str = "bounds",
) -> DataFrame:
    """One row per key and window: id, key, window start, sum, window end.

    The sum is partial before the shuffle, so neither a hot key nor a hot window is moved row by
    row. On a stream, call ``with_event_time`` first; each window is then emitted once, when the
    watermark reaches its end, and later rows for it are dropped.

    ``stamp="emitted"`` puts the window end and the time of emission in the two time columns.
    """
    if stamp not in ("bounds", "emitted"):
        raise ValueError(f"stamp must be 'bounds' or 'emitted', not {stamp!r}")
    df = without_nulls(df, {key: "key"})
    if not df.isStreaming:
        df = df.withColumn(time, known(time, "time"))
    value = F.coalesce(F.col(amount), F.lit(0)).cast("bigint")
    sums = df.groupBy(F.col(key), F.window(time, size).alias("_window")).agg(
        F.sum(value).alias("_sum")
    )
    return window_rows(
        sums, F.col(key), F.col("_window.start"), F.col("_sum"), F.col("_window.end"),
        overflow, id, stamp,
    )


def window_rows(
    sums: DataFrame,
    key: Column,
    start: Column,
    total: Column,
    end: Column,
    overflow: str = "error",
    id: str = "random",
    stamp: str = "bounds",
) -> DataFrame:
    """The output row of a finished window."""
    first, second = (start, end) if stamp == "bounds" else (end, F.current_timestamp())
    names = WINDOW_TOTAL.fieldNames()
    columns = [window_id(key, start, id), key, first, narrow(total, overflow), second]
    return sums.select(*[column.alias(name) for column, name in zip(columns, names)])


def closed_totals(
    df: DataFrame,
    key: str = "ProductName",
    time: str = "EventProcessingTime",
    amount: str = "SalesAmount",
    size: str = SIZE,
    delay: str = DELAY,
    lateness: str = NO_LATENESS,
    **options: str,
) -> DataFrame:
    """Batch: the windows a stream over the same rows has emitted, if none of them came late.

    Those are the windows that end at or before the last event time minus the delay. ``lateness``
    holds windows open that much longer.
    """
    batch_only(df, "with_event_time and tumbling_totals")
    wait = interval(delay) + interval(lateness)
    clock = df.select((F.max(time) - wait).alias("clock")).scalar()
    totals = tumbling_totals(df, key, time, amount, size, **options)
    return totals.where(F.col("WindowEndTime") <= clock)

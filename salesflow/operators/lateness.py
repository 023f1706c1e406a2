"""Which rows of a replay come too late for their event-time window."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.functions.guards import batch_only, known, without_nulls
from salesflow.operators.windows import DELAY, SIZE, interval, tumbling_totals

# Batch numbers spanning less than this are at most as many rows of 16 bytes to broadcast.
BROADCAST_BATCHES = 1_000_000


def _peak_before(per_batch: DataFrame, batch: str, peak: str, group_size: int) -> DataFrame:
    """Running maximum of ``peak`` over all earlier batches, in two steps.

    Batches are grouped by number. The maximum over earlier groups runs over the short group table;
    inside a group each group is its own window partition. No task sees the whole batch table.
    """
    per_batch = per_batch.withColumn("_group", F.expr(f"`{batch}` div {group_size}"))
    groups = per_batch.groupBy("_group").agg(F.max(peak).alias("_group_peak"))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("_group", F.max("_group_peak").over(earlier).alias("_earlier_groups"))
    inside = Window.partitionBy("_group").orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    in_group = per_batch.withColumn("_in_group", F.max(peak).over(inside))
    # A left join adds no null filter to one side only, so both sides share one aggregation.
    joined = in_group.join(groups, "_group", "left")
    return joined.select(batch, F.greatest("_in_group", "_earlier_groups").alias("_clock"))


def mark_late(
    df: DataFrame,
    batch: str,
    time: str = "EventProcessingTime",
    size: str = SIZE,
    delay: str = DELAY,
    late: str = "late",
) -> DataFrame:
    """Add a boolean column: did the row arrive after its window had closed?

    ``batch`` numbers the arrival batches with integers. A row is late if its window ends at or before the
    highest event time of all earlier batches minus ``delay``. The per-batch maxima are aggregated
    map-side and joined back: broadcast if the span of batch numbers bounds their count, so that the
    rows are not shuffled at all; else by a shuffle in which adaptive execution splits a batch that
    holds much of the data.
    """
    batch_only(df, "with_event_time and progress.late_rows_dropped")
    df = without_nulls(df, {batch: "batch"}).withColumn(time, known(time, "time"))
    first, last = df.agg(F.min(batch), F.max(batch)).first()
    span = 1 if first is None else last - first + 1
    peaks = df.groupBy(batch).agg(F.max(time).alias("_peak"))
    # Groups as large as there are groups: neither step outgrows the other.
    clocks = _peak_before(peaks, batch, "_peak", max(1, math.isqrt(span)))
    clocks = F.broadcast(clocks) if span <= BROADCAST_BATCHES else clocks
    end = F.window(time, size).end
    is_late = F.coalesce(end <= F.col("_clock") - interval(delay), F.lit(False))
    return df.join(clocks, batch, "left").withColumn(late, is_late).drop("_clock")


def count_late(marked: DataFrame, key: str = "ProductName", late: str = "late") -> DataFrame:
    """Late and on-time rows per key."""
    flag = F.col(late)
    return marked.groupBy(key).agg(
        F.count_if(flag).alias("late_rows"), F.count_if(~flag).alias("on_time_rows")
    )


def on_time_totals(
    df: DataFrame,
    batch: str,
    key: str = "ProductName",
    time: str = "EventProcessingTime",
    amount: str = "SalesAmount",
    size: str = SIZE,
    delay: str = DELAY,
    **options: str,
) -> DataFrame:
    """Window totals of a replay without its late rows, open windows included."""
    marked = mark_late(df, batch, time, size, delay, late="_late")
    on_time = marked.where(~F.col("_late"))
    return tumbling_totals(on_time, key, time, amount, size, **options)

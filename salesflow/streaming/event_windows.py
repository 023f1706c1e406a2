"""Event-time windows that fire again for late records, and that know every late record.

Spark's own windowed aggregate (``tumbling_totals`` on a stream) drops what comes too late behind its partial
sums. Here sums and record counts per window go to a processor that holds each window until its
lateness is over and compares it with the watermark itself: what is too late is counted by record, and,
with the watermark that decided it, the records of the same micro-batch are told apart. No record
passes through the processor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesflow.functions.guards import without_nulls
from salesflow.operators.windows import DELAY, NO_LATENESS, SIZE, window_rows, with_event_time
from salesflow.schema import SALE, WINDOW_TOTAL, check_schema, totals_table
from salesflow.streaming.progress import LATE_METRIC
from salesflow.streaming.sinks import Target, append_batch, append_each_batch, append_stream

KEY, TIME, AMOUNT = "ProductName", "EventProcessingTime", "SalesAmount"


def millis(spark: SparkSession, interval: str) -> int:
    return spark.sql(f"SELECT unix_millis(timestamp_seconds(0) + interval {interval})").first()[0]


def _partial_sums(key: str) -> Callable:
    """Sum and records per key and window within each Arrow batch, ahead of the shuffle."""

    def combine(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by([key, "end_millis"]).aggregate([("amount", "sum"), ("amount", "count")])
            sums = sums.select([key, "end_millis", "amount_sum", "amount_count"]).rename_columns([key, "end_millis", "amount", "records"])
            yield from sums.to_batches()

    return combine


def _processor(lateness: int):
    # The class is made here so that it is sent to the workers by value.
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class Window(StatefulProcessor):
        """The sum of one key's window, from its first record until its lateness is over."""

        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("window", "total bigint, fired boolean")

        def _row(self, key, total=None, late=None, watermark=None):
            names = ["key", "end_millis", "total", "late_records", "watermark"]
            return pd.DataFrame([(key[0], int(key[1]), total, late, watermark)], columns=names, dtype=object)

        def _wait(self, time):
            self.handle.registerTimer(time - 1)  # timers before the watermark expire: that is at `time`

        def handleInputRows(self, key, rows, timerValues):
            amount = records = 0
            for chunk in rows:
                amount, records = amount + int(chunk["amount"].sum()), records + int(chunk["records"].sum())
            watermark, end = timerValues.getCurrentWatermarkInMs(), int(key[1])
            if end + lateness <= watermark:
                yield self._row(key, late=records, watermark=watermark)
                return
            total, fired = self.state.get() or (0, False)
            total += amount
            if end <= watermark:
                self.state.update((total, True))
                self._wait(end + lateness)
                yield self._row(key, total=total)
            else:
                self.state.update((total, fired))
                self._wait(end)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            held = self.state.get()
            if held is None:
                return
            total, fired = held
            if lateness and not fired:
                self.state.update((total, True))
                self._wait(int(key[1]) + lateness)
            else:
                self.state.clear()
            if not fired:
                yield self._row(key, total=total)

        def close(self) -> None:
            pass

    return Window()


def _fired(timed: DataFrame, key: str, amount: str, lateness: int) -> DataFrame:
    """(key, end_millis, total) of windows that end or get late records, and (key, end_millis, late_records,
    watermark) of records that come after all lateness."""
    key_type = timed.schema[key].dataType
    value = F.coalesce(F.col(amount), F.lit(0)).cast("bigint").alias("amount")
    number = lambda name: T.StructField(name, T.LongType())
    partial = T.StructType([T.StructField(key, key_type), number("end_millis"), number("amount"), number("records")])
    out = T.StructType([T.StructField("key", key_type), *map(number, ("end_millis", "total", "late_records", "watermark"))])
    return (
        timed.select(key, "end_millis", value)
        .mapInArrow(_partial_sums(key), partial)
        .groupBy(key, "end_millis")
        .transformWithStateInPandas(statefulProcessor=_processor(lateness), outputStructType=out, outputMode="append", timeMode="eventTime")
    )


def stream_event_windows(
    sales: DataFrame,
    target: Target,
    size: str = SIZE,
    delay: str = DELAY,
    lateness: str = NO_LATENESS,
    overflow: str = "error",
    id: str = "random",
    stamp: str = "bounds",
) -> StreamingQuery:
    """Append the total per product and window when the watermark reaches the window's end, and a corrected total
    for each micro-batch that brings more records for it until ``lateness`` is over.

    Later records are dropped, and counted one by one (``progress.late_rows_dropped``); with ``target.late`` they
    are kept in that table as they came. The watermark is that of the micro-batch: the highest event time
    of all earlier ones less ``delay``, as in ``operators.lateness.mark_late``. The corrected row of a window has the same
    id as the first with ``id="deterministic"``. Needs the RocksDB state store (see ``session.configure``).
    """
    spark = sales.sparkSession
    size_millis, wait = millis(spark, size), millis(spark, lateness)
    timed = with_event_time(without_nulls(sales, {KEY: "key"}), TIME, delay)
    # Numbers carry no watermark: Spark would drop rows behind it before the processor sees them.
    timed = timed.withColumn("end_millis", F.unix_millis(F.window(TIME, size).end))
    fired = _fired(timed, KEY, AMOUNT, wait).observe(LATE_METRIC, F.sum("late_records").alias("records"))
    table = totals_table(WINDOW_TOTAL, overflow)

    def totals(rows: DataFrame) -> DataFrame:
        end = F.col("end_millis")
        rows = rows.where("total IS NOT NULL")
        return window_rows(
            rows, F.col("key"), F.timestamp_millis(end - size_millis), F.col("total"), F.timestamp_millis(end), overflow, id, stamp
        )

    if target.late is None:
        return append_stream(totals(fired), target, table)
    records = timed.select(*[F.col(c).cast(f.dataType).alias(c) for c, f in zip(SALE.fieldNames(), SALE.fields, strict=True)], "end_millis")

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            append_batch(check_schema(totals(batch), table), batch_id, target).unpersist()
            watermark = batch.agg(F.max("watermark")).first()[0]
            if watermark is not None:
                late = batch.where("key IS NULL").where(F.col("end_millis") + wait <= watermark).select(*SALE.fieldNames())
                append_batch(check_schema(late, SALE), batch_id, target.for_late(), target.checkpoint).unpersist()
        finally:
            batch.unpersist()

    return append_each_batch(fired.unionByName(records, allowMissingColumns=True), target, step)

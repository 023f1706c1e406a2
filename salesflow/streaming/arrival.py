"""Tumbling totals by the wall clock at arrival.

The only operator with Python-side state: a window must close when its time is up even if no
message arrives any more, which takes processing-time timers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.functions.guards import without_nulls
from salesflow.operators.windows import window_rows

WINDOW_MILLIS = 30_000


def _partial_sums(key: str, amount: str) -> Callable:
    """Sum per key within each Arrow batch, ahead of the shuffle, so that a hot key sends one row
    per batch to its task."""

    def combine(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by(key).aggregate([(amount, "sum")])
            sums = sums.select([key, f"{amount}_sum"]).rename_columns([key, "amount"])
            yield from sums.to_batches()

    return combine


def _window_processor(size: int):
    # The class is made here so that it is sent to the workers by value.
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class OpenWindows(StatefulProcessor):
        """Sums of the open windows of one key, by window end, and one timer for each."""

        def init(self, handle) -> None:
            self.handle = handle
            self.sums = handle.getMapState("sums", "end_millis bigint", "total bigint")

        def handleInputRows(self, key, rows, timerValues):
            total = sum(int(chunk["amount"].sum()) for chunk in rows)
            now = timerValues.getCurrentProcessingTimeInMs()
            end = now - now % size + size
            if self.sums.containsKey((end,)):
                total += self.sums.getValue((end,))[0]
            self.sums.updateValue((end,), (total,))
            self.handle.registerTimer(end)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            end = expiredTimerInfo.getExpiryTimeInMs()
            total = self.sums.getValue((end,))[0]
            self.sums.removeKey((end,))
            yield pd.DataFrame({"key": [key[0]], "total": [total], "end_millis": [end]})

        def close(self) -> None:
            pass

    return OpenWindows()


def stream_arrival_totals(
    sales: DataFrame,
    key: str = "ProductName",
    amount: str = "SalesAmount",
    size_millis: int = WINDOW_MILLIS,
    overflow: str = "error",
    id: str = "random",
    stamp: str = "bounds",
) -> DataFrame:
    """One row per key and wall-clock window, emitted by the first micro-batch after its end.

    All rows of a micro-batch count at the time it started, so trigger well below the window size.
    Needs the RocksDB state store (see ``session.configure``). For recorded arrival times use
    ``tumbling_totals`` on that column.
    """
    sales = without_nulls(sales, {key: "key"})
    key_type = sales.schema[key].dataType
    partial = T.StructType([T.StructField(key, key_type), T.StructField("amount", T.LongType())])
    closed = T.StructType(
        [
            T.StructField("key", key_type),
            T.StructField("total", T.LongType()),
            T.StructField("end_millis", T.LongType()),
        ]
    )
    value = F.coalesce(F.col(amount), F.lit(0)).cast("bigint").alias(amount)
    sums = (
        sales.select(key, value)
        .mapInArrow(_partial_sums(key, amount), partial)
        .groupBy(key)
        .transformWithStateInPandas(
            statefulProcessor=_window_processor(size_millis),
            outputStructType=closed,
            outputMode="append",
            timeMode="processingTime",
        )
    )
    end = F.col("end_millis")
    return window_rows(
        sums, F.col("key"), F.timestamp_millis(end - size_millis), F.col("total"),
        F.timestamp_millis(end), overflow, id, stamp,
    )

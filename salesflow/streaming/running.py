"""Running totals on a stream: each product's last time and total are in Spark's state store.

A micro-batch is cut into stretches of the arrival order, and ``(product, stretch)`` is the unit of work.
Tasks boil each unit down to its staircase: the times that rose above all before them in it, with their
amounts. Whatever time a stretch inherits, the records it lets through are the steps beyond that time, so a
binary search tells what it adds. The stateful processor sees one such row per product and stretch, never
records, keeps each product's state in a page of the map of its bucket of products, and gives back what each stretch
inherits. The records, in the same micro-batch, are then gated and totalled by windows over
``(product, stretch)``: a hot product is as many tasks as it has stretches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesflow.functions.amounts import narrow
from salesflow.functions.guards import without_nulls
from salesflow.operators.hot_keys import arrival_columns
from salesflow.schema import RUNNING_TOTAL, check_schema, totals_table
from salesflow.streaming.sinks import Target, append_batch, append_each_batch

KEY, TIME, AMOUNT, TOTAL = "ProductName", "EventProcessingTime", "SalesAmount", "TotalSalesAmount"
# Arrival numbers per stretch: a staircase has at most so many steps of 16 bytes for each topic partition.
ROWS_PER_RANGE = 1 << 18
STATE = "state"
# The processor is called per bucket of products, and asks the state store per page of a bucket, as either call costs
# far more than a product in it. Fixed for a checkpoint.
BUCKETS = 1024
PAGES = 64  # of a bucket

# Names without a leading underscore: the processor gets its rows as named tuples.
_RANGE, _LAST, _BASE, _INHERITED = "arrival_range", "inherited_last", "inherited_total", "is_inherited"
_HELD_ROWS = 1 << 20


def _staircases(key: str, arrival: Sequence[str]) -> Callable:
    """(key, range, times, amounts) of each unit of a partition. Rows that an earlier one of the unit
    covers are dropped whenever many are held."""

    def steps(table):
        import numpy as np
        import pyarrow.compute as pc

        order = pc.sort_indices(table, [(c, "ascending") for c in (key, _RANGE, *arrival)])
        table = table.take(order).combine_chunks()
        ranges = table.column(_RANGE).to_numpy()
        times = table.column("time").to_numpy()
        codes = table.column(key).combine_chunks().dictionary_encode().indices.to_numpy() if len(table) else ranges
        new = np.ones(len(table), dtype=bool)
        new[1:] = (ranges[1:] != ranges[:-1]) | (codes[1:] != codes[:-1])
        first = np.flatnonzero(new)
        # The running maximum within a unit: ranks of times, lifted unit by unit.
        rank = np.unique(times, return_inverse=True)[1].astype(np.int64)
        lifted = rank + (np.cumsum(new) - 1) * (len(table) + 1)
        peak = np.maximum.accumulate(lifted) if len(table) else lifted
        kept = new.copy()
        kept[1:] |= lifted[1:] > peak[:-1]
        return table.filter(kept), np.searchsorted(np.flatnonzero(kept), first)

    columns = [key, _RANGE, *arrival, "time", "amount"]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, rows, limit = [], 0, _HELD_ROWS
        for batch in batches:
            held.append(batch.select(columns))
            rows += len(batch)
            if rows > limit:
                held = steps(pa.Table.from_batches(held))[0].to_batches()
                rows = sum(map(len, held))
                limit = max(_HELD_ROWS, 2 * rows)
        if not rows:
            return
        table, first = steps(pa.Table.from_batches(held))
        ends = np.append(first[1:], len(table))
        for a in range(0, len(first), 1000):
            z = min(a + 1000, len(first))
            part = table.slice(first[a], ends[z - 1] - first[a]).combine_chunks()
            offsets = pa.array(np.append(first[a:z], ends[z - 1]) - first[a], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, part.column(c).combine_chunks()) for c in ("time", "amount")]
            heads = part.select([key, _RANGE]).take(offsets[:-1]).combine_chunks()
            units = [heads.column(c).combine_chunks() for c in (key, _RANGE)] + lists
            yield pa.RecordBatch.from_arrays(units, names=[key, _RANGE, "times", "amounts"])

    return run


def _processor(key: T.StructField, page: T.StructField, ttl_millis: int | None, wraps: bool):
    # The class is made here so that it is sent to the workers by value.
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class LastTimesAndTotals(StatefulProcessor):
        """The last accepted time and total of each product of a bucket, by page."""

        def init(self, handle) -> None:
            ttl = {} if ttl_millis is None else {"ttlDurationMs": ttl_millis}
            lists = [T.StructField("products", T.ArrayType(key.dataType)), *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("last_micros", "totals"))]
            self.state = handle.getMapState(STATE, T.StructType([page]), T.StructType(lists), **ttl)

        def _follow(self, product, units, last, total, out):
            for number, times, amounts in sorted(units, key=lambda u: u[0]):
                out.append((product, number, last, total))
                first = 0 if last is None else int(np.searchsorted(times, last, side="right"))
                total += int(np.asarray(amounts[first:], dtype=np.int64).sum())
                last = int(times[-1]) if last is None else max(last, int(times[-1]))
            if not -(1 << 63) <= total < 1 << 63:
                if not wraps:
                    raise OverflowError(f"the total of {product} does not fit 64 bits: {total}")
                total = (total + (1 << 63)) % (1 << 64) - (1 << 63)
            return last, total

        def handleInputRows(self, bucket, rows, timerValues):
            pages: dict = {}
            for chunk in rows:
                for number, product, *unit in zip(chunk[page.name], chunk[key.name], chunk[_RANGE], chunk["times"], chunk["amounts"], strict=True):
                    pages.setdefault(number, {}).setdefault(product, []).append(unit)
            out: list = []
            kept = self.state.exists()
            for number, products in pages.items():
                found = self.state.getValue((number,)) if kept else None
                states = {p: (last, total) for p, last, total in zip(*found, strict=True)} if found else {}
                for product, units in products.items():
                    states[product] = self._follow(product, units, *states.get(product, (None, 0)), out)
                lasts, totals = zip(*states.values(), strict=True)
                self.state.updateValue((number,), (list(states), list(lasts), list(totals)))
            yield pd.DataFrame(out, columns=["key", _RANGE, _LAST, _BASE], dtype=object)

        def close(self) -> None:
            pass

    return LastTimesAndTotals()


def _with_range(sales: DataFrame, arrival: Sequence[str], rows_per_range: int | None) -> DataFrame:
    """``_range``: the stretch of the leading arrival column. One for all without a length, or for times."""
    if rows_per_range is None or not isinstance(sales.schema[arrival[0]].dataType, T.NumericType):
        return sales.withColumn(_RANGE, F.lit(0).cast("bigint"))
    return sales.withColumn(_RANGE, F.floor(F.col(arrival[0]) / F.lit(rows_per_range)).cast("bigint"))


def _with_inherited(sales: DataFrame, key: str, time: str, amount: str, arrival: Sequence[str], overflow: str, expire_after: str | None) -> DataFrame:
    """The sales of a micro-batch, and beside them a row for each (key, range) with what it inherits."""
    millis = None
    if expire_after is not None:
        millis = sales.sparkSession.sql(f"SELECT unix_millis(timestamp_seconds(0) + interval {expire_after})").first()[0]
    sales = sales.repartition(key, _RANGE)  # all columns for both sides, so that Spark decodes and shuffles them once
    key_type = sales.schema[key].dataType
    unit = [T.StructField(key, key_type), T.StructField(_RANGE, T.LongType())]
    lists = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("times", "amounts")]
    states = [T.StructField("key", key_type), *(T.StructField(c, T.LongType()) for c in (_RANGE, _LAST, _BASE))]
    slot = F.pmod(F.xxhash64(key), F.lit(BUCKETS * PAGES))
    # Spark expires whole pages: products that expire have one each.
    page = F.floor(slot / BUCKETS).cast("int") if millis is None else F.col(key)
    page_type = T.StructField("page", T.IntegerType() if millis is None else key_type)
    inherited = (
        sales.mapInArrow(_staircases(key, arrival), T.StructType(unit + lists))
        .withColumns({"bucket": F.pmod(slot, F.lit(BUCKETS)).cast("int"), "page": page})
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=_processor(T.StructField(key, key_type), page_type, millis, overflow == "wrap"),
            outputStructType=T.StructType(states),
            outputMode="append",
            timeMode="none" if millis is None else "processingTime",
        )
        .withColumnRenamed("key", key)
        .withColumn(_INHERITED, F.lit(True))
    )
    # In this order: the optimizer keeps renamed source columns in a union's first side, and the two would differ.
    return inherited.unionByName(sales.withColumn(_INHERITED, F.lit(False)), allowMissingColumns=True)


def _totals(batch: DataFrame, key: str, time: str, amount: str, arrival: Sequence[str], total: str, overflow: str) -> DataFrame:
    """The sales of a batch that pass, with their totals."""
    inherited = batch.where(_INHERITED).select(key, _RANGE, F.col(_LAST).alias("_peak"), F.col(_BASE).alias("_carried"))
    rows = batch.where(f"NOT {_INHERITED}").drop(_LAST, _BASE, _INHERITED).join(inherited, [key, _RANGE])
    rows = rows.where(F.col("_peak").isNull() | (F.col("time") > F.col("_peak")))
    order = Window.partitionBy(key, _RANGE).orderBy(*arrival)
    earlier = F.max("time").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_earlier", earlier).where(F.col("_earlier").isNull() | (F.col("time") > F.col("_earlier")))
    so_far = F.sum("amount").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn(total, narrow(F.col("_carried") + so_far, overflow))


def stream_running_totals(
    sales: DataFrame,
    target: Target,
    arrival: str | Sequence[str],
    overflow: str = "error",
    rows_per_range: int | None = ROWS_PER_RANGE,
    expire_after: str | None = None,
) -> StreamingQuery:
    """Append each sale that moves its product's clock forward, with the running total.

    ``sales`` has the sale columns and ``arrival``, which orders the rows inside a micro-batch;
    micro-batches follow one another. Its first column, if a number, is cut into stretches of
    ``rows_per_range``. ``expire_after`` is an interval such as ``"90 days"``: a product without a sale for so
    long, by the clock of the cluster, starts anew; without it none does. Needs the RocksDB state store (see
    ``session.configure``). The source is read twice per micro-batch, once for four of its columns.
    """
    if expire_after is not None and target.available_now:
        raise ValueError("products expire by the clock: run the job with `every`")
    arrival = arrival_columns(arrival)
    value = F.coalesce(F.col(AMOUNT), F.lit(0)).cast("bigint")
    sales = sales.withColumns({"time": F.unix_micros(TIME), "amount": value})
    sales = without_nulls(sales, {KEY: "key", TIME: "time"} | {c: "arrival" for c in arrival})
    sales = _with_range(sales, arrival, rows_per_range)
    table = totals_table(RUNNING_TOTAL, overflow)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the state is asked once, whatever the plan below reads twice
        try:
            if not batch.where(_INHERITED).isEmpty():
                totals = _totals(batch, KEY, TIME, AMOUNT, arrival, TOTAL, overflow)
                append_batch(check_schema(totals.select(*RUNNING_TOTAL.fieldNames()), table), batch_id, target).unpersist()
        finally:
            batch.unpersist()

    return append_each_batch(_with_inherited(sales, KEY, TIME, AMOUNT, arrival, overflow, expire_after), target, step)


def read_state(spark: SparkSession, target: Target, key: str = KEY) -> DataFrame:
    """key, ``last_time``, ``total`` of a running stream, as of its last committed micro-batch, read from its
    checkpoint by Spark's state reader."""
    state = spark.read.format("statestore").option("path", target.checkpoint).option("stateVarName", STATE).load()
    value = "user_map_value"
    if "value" in state.schema[value].dataType.names:  # beside the time it expires
        value = f"{value}.value"
    products = F.explode(F.arrays_zip(*(f"{value}.{c}" for c in ("products", "last_micros", "totals")))).alias("state")
    last = F.timestamp_micros("state.last_micros").alias("last_time")
    return state.select(products).select(F.col("state.products").alias(key), last, F.col("state.totals").alias("total"))

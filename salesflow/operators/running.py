"""Per-key gate on time, and the running total over the rows it lets through.

A row passes if it is the first of its key in arrival order, or its time is strictly later than
that of the last row that passed. A refused row never exceeds the last passed time, so that time is
the running maximum over all earlier rows of the key: a window function, no sequential fold.
Row ids play no part: a repeated id with a later time counts again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from salesflow.functions.amounts import narrow
from salesflow.functions.guards import batch_only, without_nulls
from salesflow.operators.hot_keys import (
    HOT,
    NO_HOT_KEYS,
    RANGE,
    HotKeys,
    arrival_columns,
    find_hot_keys,
    join_per_range,
    with_ranges,
)
from salesflow.session import work_dir

ROWS_PER_RANGE = 4_000_000
# Steps of a staircase kept in one row: 1 MB.
STEPS = 1 << 16


@dataclass(frozen=True)
class _Gate:
    """Rows before the gate, the time (and total) each (key, range) inherits, and how to apply it."""

    rows: DataFrame
    inherited: DataFrame | None
    bound: int | None
    time: str
    key: str
    order: WindowSpec

    def passed(self) -> DataFrame:
        """The rows later than what their range inherits and than all before them in it."""
        rows, time = self.rows, F.col(self.time)
        if self.inherited is not None:
            # Most rows of an unordered hot key end here, ahead of the shuffle if this is a
            # broadcast join.
            rows = join_per_range(rows, self.inherited, self.key, self.bound)
            rows = rows.where(F.col("_peak").isNull() | (time > F.col("_peak"))).drop("_peak")
        rows = rows.withColumn("_earlier", F.max(time).over(_before(self.order)))
        rows = rows.where(F.col("_earlier").isNull() | (time > F.col("_earlier")))
        return rows.drop("_earlier")


def _before(order: WindowSpec) -> WindowSpec:
    return order.rowsBetween(Window.unboundedPreceding, -1)


def _gate(
    df: DataFrame,
    key: str,
    time: str,
    amount: str | None,
    arrival: Sequence[str],
    rows_per_range: int | None,
    state: DataFrame | None,
    state_rows: int | None,
) -> _Gate:
    """The gate; with an ``amount`` its ranges inherit a total, ``_base``, too."""
    batch_only(df, "streaming.running.stream_running_totals")
    hot = NO_HOT_KEYS
    if rows_per_range is not None:
        hot = find_hot_keys(df, key, arrival, rows_per_range)
    roles = {key: "key", time: "time"} | {column: "arrival" for column in arrival}
    rows = with_ranges(without_nulls(df, roles), key, arrival, hot)
    order = Window.partitionBy(key, RANGE).orderBy(*arrival)
    inherited = None
    if hot.keys is not None and amount is None:
        peaks = rows.where(HOT).groupBy(key, RANGE).agg(F.max(time).alias("_peak"))
        inherited = _carry(peaks, "_peak", F.max, key, hot, state, "last_time")
    elif hot.keys is not None:
        # Nulls fail the result, not this: it is computed ahead of it.
        stairs = _staircases(with_ranges(df, key, arrival, hot).where(HOT), key, time, amount, order, arrival)
        inherited = _times_and_totals(stairs, key, hot, state)
    elif state is not None:
        inherited = state.select(key, F.lit(0).alias(RANGE), F.col("last_time").alias("_peak"), F.col("total").alias("_base"))
        inherited = inherited if amount is not None else inherited.drop("_base")
    bound = hot.range_rows
    if state is not None:
        bound = None if state_rows is None else bound + state_rows
    return _Gate(rows, inherited, bound, time, key, order)


def _staircases(rows: DataFrame, key: str, time: str, amount: str, order: WindowSpec, arrival: Sequence[str]) -> DataFrame:
    """Of each (key, range) the steps: the times later than all before them in it, with the amounts up to and
    with each. Whatever a range inherits, its rows that pass are the steps beyond that time. Blocks of
    STEPS steps are a row: ``_times`` and ``_sums``, both sorted, with the sum ``_before`` and the last time ``_peak``.
    Written at once, so that the rows are read and sorted for them only here."""
    value = F.coalesce(F.col(amount), F.lit(0)).cast("bigint").alias("_value")
    rows = rows.select(key, RANGE, *arrival, F.col(time).alias("_time"), value)
    steps = rows.withColumn("_earlier", F.max("_time").over(_before(order))).where("_earlier IS NULL OR _time > _earlier")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    block = F.floor((F.row_number().over(order) - 1) / F.lit(STEPS)).cast("int")
    steps = steps.withColumns({"_sum": F.sum("_value").over(so_far), "_block": block})
    sorted_steps = F.array_sort(F.collect_list(F.struct("_time", "_sum")))
    blocks = steps.groupBy(key, RANGE, "_block").agg(
        sorted_steps.alias("_steps"), F.max("_time").alias("_peak"), F.min_by(F.col("_sum") - F.col("_value"), "_time").alias("_before")
    )
    blocks = blocks.select(key, RANGE, "_block", F.col("_steps._time").alias("_times"), F.col("_steps._sum").alias("_sums"), "_peak", "_before")
    path = work_dir(rows.sparkSession, "staircases")
    blocks.write.parquet(path)
    return rows.sparkSession.read.schema(blocks.schema).parquet(path)


def _times_and_totals(blocks: DataFrame, key: str, hot: HotKeys, state: DataFrame | None) -> DataFrame:
    """The time ``_peak`` and total ``_base`` that each (key, range) inherits. What a block adds for a time is a
    binary search in its steps."""
    peaks = blocks.groupBy(key, RANGE).agg(F.max("_peak").alias("_peak"))
    times = _carry(peaks, "_peak", F.max, key, hot, state, "last_time")
    given = blocks.drop("_peak").join(times.hint("shuffle_hash"), [key, RANGE])
    halving = F.transform(F.sequence(F.lit(STEPS.bit_length() - 1), F.lit(0)), lambda i: F.call_function("shiftleft", F.lit(1), i))
    time = F.col("_peak")
    passed = F.aggregate(halving, F.lit(0), lambda at, n: F.when(F.get("_times", at + n - 1) <= time, at + n).otherwise(at))
    added = F.element_at("_sums", -1) - F.coalesce(F.get("_sums", passed - 1), F.col("_before"))
    sums = given.groupBy(key, RANGE).agg(F.sum(added).alias("_base"))
    totals = _carry(sums, "_base", F.sum, key, hot, state, "total")
    return times.join(totals.hint("shuffle_hash"), [key, RANGE], "left")


def _carry(
    per_range: DataFrame,
    column: str,
    combine,
    key: str,
    hot: HotKeys,
    state: DataFrame | None,
    state_column: str,
) -> DataFrame:
    """What each (hot key, range) inherits: ``combine`` over the key's earlier ranges and state.

    The state of a hot key enters as a range before its first one; that of any other key belongs to
    its only range, 0.
    """
    others = None
    if state is not None:
        seeds = state.select(key, F.col(state_column).alias(column))
        hot_seeds = seeds.join(hot.table(key), key, "left_semi")
        others = seeds.join(hot.table(key), key, "left_anti")
        per_range = per_range.unionByName(hot_seeds.withColumn(RANGE, F.lit(-1)))
    inherited = combine(column).over(_before(Window.partitionBy(key).orderBy(RANGE)))
    table = per_range.select(key, RANGE, inherited.alias(column))
    if others is not None:
        table = table.unionByName(others.withColumn(RANGE, F.lit(0)))
    return table


def monotone_gate(
    df: DataFrame,
    key: str = "ProductName",
    time: str = "EventProcessingTime",
    arrival: str | Sequence[str] = "arrival",
    rows_per_range: int | None = ROWS_PER_RANGE,
    state: DataFrame | None = None,
    state_rows: int | None = None,
) -> DataFrame:
    """The rows of ``df`` whose time moves their key's clock forward, in arrival order.

    ``arrival`` must order the rows of a key uniquely; its first column must be nearly unique, as
    ranges are cut on it. Keys with more than ``rows_per_range`` rows are cut into arrival ranges
    (see ``hot_keys``); ``None`` leaves every key whole.

    ``state``, as ``key_state`` gives it, continues from earlier data; ``state_rows`` is an upper
    bound on its rows, if known. ``df`` is read several times, each time fewer columns: land or
    persist it first if it is costly to compute. The search for hot keys, and for totals the staircases of
    those found, run Spark jobs when this is called, ahead of any action; ``rows_per_range=None`` runs none.
    """
    gate = _gate(df, key, time, None, arrival_columns(arrival), rows_per_range, state, state_rows)
    return gate.passed().select(*df.columns)


def dedupe_running_total(
    df: DataFrame,
    key: str = "ProductName",
    time: str = "EventProcessingTime",
    amount: str = "SalesAmount",
    arrival: str | Sequence[str] = "arrival",
    total: str = "TotalSalesAmount",
    overflow: str = "error",
    rows_per_range: int | None = ROWS_PER_RANGE,
    state: DataFrame | None = None,
    state_rows: int | None = None,
) -> DataFrame:
    """``monotone_gate`` plus, in column ``total``, the key's total up to and with each row."""
    gate = _gate(df, key, time, amount, arrival_columns(arrival), rows_per_range, state, state_rows)
    value = F.coalesce(F.col(amount), F.lit(0)).cast("bigint")
    so_far = gate.order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = gate.passed().withColumn("_sum", F.sum(value).over(so_far))
    grand = F.col("_sum")
    if gate.inherited is not None:
        grand = grand + F.coalesce(F.col("_base"), F.lit(0))
    kept = [c for c in df.columns if c != total]
    return rows.select(*kept, narrow(grand, overflow).alias(total))


def key_state(
    df: DataFrame,
    key: str = "ProductName",
    time: str = "EventProcessingTime",
    amount: str = "SalesAmount",
    arrival: str | Sequence[str] = "arrival",
    overflow: str = "error",
    rows_per_range: int | None = ROWS_PER_RANGE,
) -> DataFrame:
    """Last passed time and total per key: key, last_time, total.

    The same as the last row of each key in ``dedupe_running_total``, by one partial aggregate.
    """
    passed = monotone_gate(df, key, time, arrival, rows_per_range)
    value = F.coalesce(F.col(amount), F.lit(0)).cast("bigint")
    state = passed.groupBy(key).agg(F.max(time).alias("last_time"), F.sum(value).alias("_sum"))
    return state.select(key, "last_time", narrow(F.col("_sum"), overflow).alias("total"))


def latest_state(
    totals: DataFrame,
    key: str = "ProductName",
    time: str = "EventProcessingTime",
    total: str = "TotalSalesAmount",
) -> DataFrame:
    """The same table from rows that already carry totals: the latest row of each key."""
    return totals.groupBy(key).agg(
        F.max(time).alias("last_time"), F.max_by(total, time).alias("total")
    )

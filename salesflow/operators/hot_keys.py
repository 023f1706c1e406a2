"""Cutting the rows of hot keys into contiguous arrival ranges.

A per-key fold over arrival order puts all rows of a key in one task. Here the few keys with more
rows than a task should hold are cut into ranges of the arrival order, so that ``(key, range)`` is
the unit of work. What a range needs to know of the ranges before it is a small per-range table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.session import work_dir

# Expected sample rows per range: a key at the threshold is estimated to within about 15 percent.
SAMPLES_PER_RANGE = 200
# Per-range tables up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000
# The table of hot keys and their cuts is broadcast up to this size, and joined by shuffle beyond.
BROADCAST_BYTES = 64 << 20

RANGE = "_range"
HOT = "_hot"
_CUTS = "_cuts"
_POSITION = "_position"


@dataclass(frozen=True)
class HotKeys:
    """A written table of the hot keys and their sorted cuts, its size, and all ranges together."""

    keys: DataFrame | None
    bytes: int
    range_rows: int
    most_cuts: int

    def table(self, *columns: str) -> DataFrame:
        """Some columns of the table, marked for broadcasting if the whole is small enough."""
        table = self.keys.select(*columns)
        return F.broadcast(table) if self.bytes <= BROADCAST_BYTES else table


NO_HOT_KEYS = HotKeys(None, 0, 0, 0)


def arrival_columns(arrival: str | Sequence[str]) -> list[str]:
    return [arrival] if isinstance(arrival, str) else list(arrival)


def _position(df: DataFrame, arrival: Sequence[str]) -> Column:
    """The leading arrival column as a double; a monotone mapping, which is all ranges need."""
    first, dtype = F.col(arrival[0]), df.schema[arrival[0]].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(first.cast("timestamp")).cast("double")
    if isinstance(dtype, T.NumericType):
        return first.cast("double")
    raise TypeError(f"arrival column {arrival[0]} must be numeric or a time, not {dtype}")


def find_hot_keys(df: DataFrame, key: str, arrival: Sequence[str], rows_per_range: int) -> HotKeys:
    """Estimate which keys have more than ``rows_per_range`` rows, and cut each by its own rows.

    Runs Spark jobs at once: one pass over the key and arrival columns keeps a thin sample, which
    is sorted by key and position over all tasks; every so many sample rows of the sorted order are
    a cut. Hot keys, if there are any, and cuts stay a table in the work folder and only its size comes to the driver.
    The sample only balances the work: every row is assigned to its range afterwards and no result
    depends on the estimate.
    """
    spark = df.sparkSession
    fraction = min(1.0, SAMPLES_PER_RANGE / rows_per_range)
    sample = df.select(key, _position(df, arrival).alias(_POSITION))
    if fraction < 1.0:
        sample = sample.sample(fraction=fraction, seed=0)
    sample = sample.where(F.col(key).isNotNull()).persist()
    try:
        per_range = max(1, round(rows_per_range * fraction))
        sizes = sample.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        hot = sizes.where(F.col("_rows") > rows_per_range * fraction).select(key)
        if hot.isEmpty():
            return NO_HOT_KEYS
        # Numbered within its partition, each partition's first row included, so that no stretch
        # of a key's rows longer than per_range is without a cut.
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ordered = sample.join(hot, key, "left_semi").orderBy(key, _POSITION).withColumn("_place", place)
        cuts = ordered.where(F.col("_place") % per_range == 0).groupBy(key).agg(F.array_sort(F.collect_set(_POSITION)).alias(_CUTS))
        path = work_dir(spark, "hot-keys")
        # A hot key has no cut if all its sample rows lie between two of the sorted order.
        table = hot.join(cuts, key, "left").select(key, F.coalesce(_CUTS, F.array().cast("array<double>")).alias(_CUTS))
        table.write.parquet(path)
    finally:
        sample.unpersist()
    keys = spark.read.schema(table.schema).parquet(path)
    length = F.octet_length(F.col(key).cast("string")) + 8 * F.size(_CUTS) + 64
    size, ranges, most = keys.agg(F.sum(length), F.sum(F.size(_CUTS) + 1), F.max(F.size(_CUTS))).first()
    return HotKeys(keys, size, ranges, most)


def _cuts_up_to(position: Column, most: int) -> Column:
    """How many of the sorted cuts are not beyond ``position``, by steps of halved length."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(most.bit_length()))])
    cuts = F.col(_CUTS)
    return F.aggregate(
        steps,
        F.lit(0),
        lambda passed, step: F.when(F.get(cuts, passed + step - 1) <= position, passed + step).otherwise(passed),
    )


def with_ranges(df: DataFrame, key: str, arrival: Sequence[str], hot: HotKeys) -> DataFrame:
    """Add ``_hot`` and ``_range``; range numbers follow arrival order, and are 0 for other keys."""
    if hot.keys is None:
        return df.withColumn(HOT, F.lit(False)).withColumn(RANGE, F.lit(0))
    marked = df.join(hot.table(key, _CUTS), key, "left")
    marked = marked.withColumn(HOT, F.col(_CUTS).isNotNull())
    if not hot.most_cuts:
        return marked.withColumn(RANGE, F.lit(0)).drop(_CUTS)
    number = F.when(F.col(HOT), _cuts_up_to(_position(df, arrival), hot.most_cuts)).otherwise(0)
    return marked.withColumn(RANGE, number).drop(_CUTS)


def join_per_range(rows: DataFrame, table: DataFrame, key: str, bound: int | None) -> DataFrame:
    """Left-join a per-(key, range) table of at most ``bound`` rows, or of unknown size if None.

    A small table is broadcast. Otherwise both sides are partitioned by (key, range), which the
    windows that follow reuse. The hash form saves sorting the rows for the join; its bound keeps
    one partition's share in memory. A table of unknown size gets the join that can spill.
    """
    if bound is None:
        return rows.join(table, [key, RANGE], "left")
    table = F.broadcast(table) if bound <= BROADCAST_ROWS else table.hint("shuffle_hash")
    return rows.join(table, [key, RANGE], "left")

"""The registered queries: every operator over the whole of a given table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.functions.amounts import narrow
from salesflow.functions.ids import sale_line
from salesflow.operators.decode import decode_sales, good_sales, sale_rows, strict_sales
from salesflow.operators.lateness import count_late, mark_late, on_time_totals
from salesflow.operators.running import dedupe_running_total, key_state, monotone_gate
from salesflow.operators.windows import closed_totals, tumbling_totals
from salesflow.plans import jobs
from salesflow.plans.tables import (
    as_messages,
    as_topic,
    events_as_sales,
    orders_as_mixed_messages,
    orders_as_sales,
    orders_with_bad_fields,
    orders_with_bad_messages,
    table,
    table_stream,
)
from salesflow.schema import QUARANTINE, RUNNING_TOTAL, SALE, WINDOW_TOTAL, check_schema, totals_table
from salesflow.session import configure, work_dir
from salesflow.sources.replay import replay
from salesflow.sources.topic import TOPIC_ARRIVAL, value_only
from salesflow.streaming.progress import late_rows_dropped, wait_for_timers
from salesflow.streaming.running import read_state
from salesflow.streaming.sinks import Target, read_table

HOT_ROWS = 1000


def _plain_times(df: DataFrame) -> DataFrame:
    """Zone-less times, as the oracle's TIMESTAMP columns are."""
    zoned = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if c in zoned else F.col(c) for c in df.columns]
    )


def _orders(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return orders_as_sales(table(spark, sf_dir, "orders"), **options)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_sales(table(spark, sf_dir, "events"))


def _totals_table(df: DataFrame) -> DataFrame:
    return check_schema(df.select(*RUNNING_TOTAL.fieldNames()), RUNNING_TOTAL)


def land_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_schema(sale_rows(_orders(spark, sf_dir)), SALE)


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("arrival", sale_line().alias("line"))


def decode_sales_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = orders_as_mixed_messages(table(spark, sf_dir, "orders"))
    return sale_rows(good_sales(decode_sales(messages)))


def decode_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_sales(orders_with_bad_messages(table(spark, sf_dir, "orders")))
    return decoded.select("arrival", F.coalesce("reason", F.lit("good")).alias("reason"))


def decode_refused_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = orders_with_bad_fields(table(spark, sf_dir, "orders"))
    decoded = decode_sales(messages, unknown_fields="reject")
    amount = F.when(F.col("reason").isNull(), F.col("SalesAmount"))
    reason = F.coalesce("reason", F.lit("good"))
    return decoded.select("arrival", reason.alias("reason"), amount.alias("SalesAmount"))


def gate_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monotone_gate(_orders(spark, sf_dir)).select("SalesId", "ProductName")


def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals_table(dedupe_running_total(_orders(spark, sf_dir)))


def running_total_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _orders(spark, sf_dir, key="o_orderpriority")
    return _totals_table(dedupe_running_total(sales, rows_per_range=HOT_ROWS))


def running_total_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _orders(spark, sf_dir, key="o_orderpriority", scale=4000)
    return _totals_table(
        dedupe_running_total(sales, rows_per_range=HOT_ROWS, overflow="wrap")
    )


def running_total_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _orders(spark, sf_dir, key="o_orderpriority", scale=4000)
    totals = dedupe_running_total(sales, rows_per_range=HOT_ROWS, overflow="bigint")
    return check_schema(
        totals.select(*RUNNING_TOTAL.fieldNames()), totals_table(RUNNING_TOTAL, "bigint")
    )


def running_total_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a topic's rows, totalled in the order of offsets and partitions."""
    sales = strict_sales(decode_sales(value_only(as_topic(as_messages(_orders(spark, sf_dir))))))
    return _totals_table(dedupe_running_total(sales, arrival=TOPIC_ARRIVAL))


def running_total_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events come in time order, so every row passes: the case with the most rows to total."""
    sales = _events(spark, sf_dir)
    return _totals_table(dedupe_running_total(sales, rows_per_range=HOT_ROWS, overflow="wrap"))


def state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_state(_orders(spark, sf_dir))


def state_snapshot_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_state(_orders(spark, sf_dir, key="o_orderpriority"), rows_per_range=HOT_ROWS)


def event_time_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = tumbling_totals(_events(spark, sf_dir), id="deterministic")
    return check_schema(totals, WINDOW_TOTAL)


def event_time_totals_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _events(spark, sf_dir)
    return tumbling_totals(sales, size="1 hour", overflow="wrap", id="deterministic")


def event_time_totals_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _orders(spark, sf_dir, key="o_orderpriority", scale=100)
    return tumbling_totals(sales, size="365 days", overflow="wrap", id="deterministic")


def event_time_totals_emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = tumbling_totals(_events(spark, sf_dir), id="deterministic", stamp="emitted")
    emitted = F.col("WindowEndTime") >= F.col("WindowStartTime")
    return totals.withColumn("WindowEndTime", emitted).withColumnRenamed(
        "WindowEndTime", "emitted_after_end"
    )


def event_time_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closed_totals(_events(spark, sf_dir), id="deterministic")


def event_time_allowed_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closed_totals(_events(spark, sf_dir), lateness="36 hours", id="deterministic")


def _delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive up to two hours late, in batches of six hours."""
    batch = F.expr("(unix_seconds(EventProcessingTime) + arrival * 7919 % 7200) div 21600")
    return _events(spark, sf_dir).withColumn("arrival_batch", batch)


def late_data_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_late(mark_late(_delayed(spark, sf_dir), "arrival_batch"))


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_late(_delayed(spark, sf_dir), "arrival_batch").select("SalesId", "late")


def event_time_late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_time_totals(_delayed(spark, sf_dir), "arrival_batch", id="deterministic")


def processing_time_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.pmod("arrival", F.lit(25))
    arrived = F.col("EventProcessingTime") + F.make_interval(secs=seconds)
    sales = _events(spark, sf_dir).withColumn("arrived", arrived)
    return tumbling_totals(sales, time="arrived", id="deterministic")


def _target(spark: SparkSession, purpose: str) -> Target:
    folder = work_dir(spark, purpose)
    return Target(f"{folder}/table", f"{folder}/checkpoint", available_now=True)


def table_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all orders from messages as a stream, then query the table with SQL."""
    target = _target(spark, "land")
    messages = as_messages(orders_as_sales(table_stream(spark, sf_dir, "orders")))
    jobs.land_sales(messages, target).await_termination()
    read_table(spark, target.path, SALE, view="landed_sales")
    return spark.sql(
        "SELECT ProductName, count(*) AS sales, sum(SalesAmount) AS amount,"
        " max(EventProcessingTime) AS last_sale FROM landed_sales GROUP BY ProductName"
    )


def stream_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, "running")
    messages = as_messages(orders_as_sales(table_stream(spark, sf_dir, "orders")))
    jobs.running_totals(messages, target, arrival="arrival").await_termination()
    return read_table(spark, target.path, RUNNING_TOTAL)


def stream_processing_time_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall-clock windows differ from run to run. What they add up to per product does not, and all
    have the asked length, are aligned to it, and occur once, each with an id of its own."""
    target = replace(_target(spark, "arrival"), available_now=False, every="500 milliseconds")
    messages = as_messages(events_as_sales(table_stream(spark, sf_dir, "events")))
    size = 2000
    job = jobs.processing_time_totals(messages, target, size_millis=size, overflow="wrap")
    try:
        wait_for_timers(job.main)
    finally:
        job.stop()
    windows = read_table(spark, target.path, WINDOW_TOTAL)
    amount = narrow(F.sum("SalesAmount"), "wrap")
    start, end = F.unix_millis("WindowStartTime"), F.unix_millis("WindowEndTime")
    once, ids = F.count_distinct("WindowStartTime"), F.count_distinct("SalesId")
    return windows.groupBy("ProductName").agg(
        amount.alias("amount"),
        F.bool_and((end - start == size) & (start % size == 0)).alias("aligned"),
        (once == F.count(F.lit(1))).alias("windows_once"),
        (ids == F.count(F.lit(1))).alias("ids_once"),
    )


def stream_event_time_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, "windows")
    messages = as_messages(events_as_sales(table_stream(spark, sf_dir, "events")))
    jobs.event_time_totals(messages, target, id="deterministic").await_termination()
    return read_table(spark, target.path, WINDOW_TOTAL)


def _in_runs(
    spark: SparkSession, messages: DataFrame, parts: Sequence[Column], folder: str,
    start: Callable[[DataFrame], jobs.Job],
) -> None:
    """Write one part of the messages after another; after each, start the job again from its
    checkpoint and let it end."""
    for number, part in enumerate(parts):
        messages.where(part).write.parquet(f"{folder}/part{number}")
        start(replay(spark, f"{folder}/*", messages.schema)).await_termination()


def _fourths(messages: DataFrame) -> list[Column]:
    """Four equal stretches of the arrival numbers."""
    low, high = messages.agg(F.min("arrival"), F.max("arrival")).first()
    if low is None:
        return [F.lit(True)]
    cuts = [low + (high - low) * i // 4 for i in range(1, 4)]
    arrival = F.col("arrival")
    pairs = zip([None, *cuts], [*cuts, None])
    return [
        (F.lit(True) if a is None else arrival > a) & (F.lit(True) if b is None else arrival <= b)
        for a, b in pairs
    ]


def land_with_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing that is given a quarantine table halfway, before the first bad message: what both
    tables hold after two runs from one checkpoint."""
    target = _target(spark, "quarantine")
    kept_apart = replace(target, quarantine=f"{target.path}-refused")
    targets = iter([target, kept_apart])
    messages = orders_with_bad_messages(table(spark, sf_dir, "orders"))
    early = (F.pmod("arrival", F.lit(2)) == 0) & ~F.col("value").isin("not json", "")
    _in_runs(
        spark, messages, [early, ~early], work_dir(spark, "quarantine-in"),
        lambda part: jobs.land_sales(part, next(targets)),
    )
    landed = read_table(spark, target.path, SALE).select("SalesId", "SalesAmount", F.lit("good").alias("reason"))
    refused = read_table(spark, kept_apart.quarantine, QUARANTINE)
    nothing = F.lit(None)
    return landed.unionByName(
        refused.select(nothing.cast("string").alias("SalesId"), nothing.cast("int").alias("SalesAmount"), "reason")
    )


def stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals in four runs, each going on from the state the one before left."""
    target = _target(spark, "resumed")
    messages = as_messages(_orders(spark, sf_dir))
    _in_runs(
        spark, messages, _fourths(messages), work_dir(spark, "resumed-in"),
        lambda part: jobs.running_totals(part, target, arrival="arrival"),
    )
    return read_table(spark, target.path, RUNNING_TOTAL)


def stream_event_time_totals_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time windows over several data batches, some open from one run to the next."""
    target = _target(spark, "window-batches")
    messages = as_messages(_events(spark, sf_dir))
    _in_runs(
        spark, messages, _fourths(messages), work_dir(spark, "window-batches-in"),
        lambda part: jobs.event_time_totals(part, target, id="deterministic"),
    )
    return read_table(spark, target.path, WINDOW_TOTAL)


def stream_late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th event comes after all others: it counts only if its window is still open."""
    target = _target(spark, "late")
    messages = as_messages(_events(spark, sf_dir))
    held = F.pmod("arrival", F.lit(50)) == 0
    _in_runs(
        spark, messages, [~held, held], work_dir(spark, "late-in"),
        lambda part: jobs.event_time_totals(part, target, id="deterministic"),
    )
    return read_table(spark, target.path, WINDOW_TOTAL)


def _in_two_runs(spark: SparkSession, sf_dir: str, target: Target, **options) -> list[jobs.Job]:
    """Every 50th event after all others, in a run of its own."""
    started: list[jobs.Job] = []
    messages = as_messages(_events(spark, sf_dir))
    held = F.pmod("arrival", F.lit(50)) == 0

    def start(part: DataFrame) -> jobs.Job:
        started.append(jobs.event_time_totals(part, target, id="deterministic", **options))
        return started[-1]

    _in_runs(spark, messages, [~held, held], work_dir(spark, "late-in"), start)
    return started


def stream_late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late events, kept in a table of their own, and the amount that counted per product."""
    target = _target(spark, "late-records")
    target = replace(target, late=f"{target.path}-late")
    _in_two_runs(spark, sf_dir, target)
    late = read_table(spark, target.late, SALE).select("ProductName", "SalesId", F.col("SalesAmount").cast("bigint").alias("amount"))
    counted = read_table(spark, target.path, WINDOW_TOTAL).groupBy("ProductName").agg(F.sum("SalesAmount").alias("amount"))
    return late.unionByName(counted, allowMissingColumns=True)


def stream_late_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events came too late, as the stream's counter has it: each one, not each key and window."""
    target = _target(spark, "late-counted")
    started = _in_two_runs(spark, sf_dir, replace(target, late=f"{target.path}-late"))
    return spark.createDataFrame([(sum(late_rows_dropped(job.main) for job in started),)], "late_rows bigint")


def stream_refires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and corrected totals of windows, held for a day beyond their end."""
    target = _target(spark, "refires")
    _in_two_runs(spark, sf_dir, target, lateness="1 day", refires=True)
    return read_table(spark, target.path, WINDOW_TOTAL)


def stream_state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of running totals, read from the checkpoint of the stream that keeps it."""
    target = _target(spark, "snapshot")
    messages = as_messages(orders_as_sales(table_stream(spark, sf_dir, "orders")))
    jobs.running_totals(messages, target, arrival="arrival").await_termination()
    return read_state(spark, target).withColumn("total", F.col("total").cast("int"))


def stream_totals_beside_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream's window totals add up to, the messages decoded for them, and those refused: all from
    one decoding."""
    target = _target(spark, "beside")
    target = replace(target, quarantine=f"{target.path}-refused")
    messages = orders_with_bad_messages(table(spark, sf_dir, "orders"))
    _in_runs(
        spark, messages, [F.lit(True)], work_dir(spark, "beside-in"),
        lambda part: jobs.event_time_totals(part, target, size="30 days", id="deterministic"),
    )
    kinds = lambda df, kind, n: df.groupBy(kind.alias("kind")).agg(n.cast("bigint").alias("n"))
    decoded = spark.read.parquet(target.for_decoded().path)
    windows = kinds(read_table(spark, target.path, WINDOW_TOTAL), F.lit("window amount"), F.sum("SalesAmount"))
    return windows.union(kinds(decoded.where("reason IS NULL"), F.lit("good"), F.count("*"))).union(
        kinds(read_table(spark, target.quarantine, QUARANTINE), F.col("reason"), F.count("*"))
    )


QUERIES = {
    "land_sales": land_sales,
    "sales_lines": sales_lines,
    "decode_sales_json": decode_sales_json,
    "decode_quarantine": decode_quarantine,
    "decode_refused_fields": decode_refused_fields,
    "monotone_gate": gate_only,
    "dedupe_running_total": running_total,
    "dedupe_running_total_skewed": running_total_skewed,
    "dedupe_running_total_wrapped": running_total_wrapped,
    "dedupe_running_total_in_order": running_total_in_order,
    "dedupe_running_total_bigint": running_total_bigint,
    "dedupe_running_total_topic": running_total_topic,
    "product_state_snapshot": state_snapshot,
    "product_state_snapshot_skewed": state_snapshot_skewed,
    "event_time_totals": event_time_totals,
    "event_time_totals_hourly": event_time_totals_hourly,
    "event_time_totals_wrapped": event_time_totals_wrapped,
    "event_time_totals_emitted": event_time_totals_emitted,
    "event_time_closed_windows": event_time_closed_windows,
    "event_time_allowed_lateness": event_time_allowed_lateness,
    "event_time_late_dropped": event_time_late_dropped,
    "late_data_audit": late_data_audit,
    "late_rows": late_rows,
    "processing_time_totals": processing_time_totals,
    "table_readback": table_readback,
    "stream_running_total": stream_running_total,
    "stream_processing_time_totals": stream_processing_time_totals,
    "stream_event_time_totals": stream_event_time_totals,
    "land_with_quarantine": land_with_quarantine,
    "stream_resumed": stream_resumed,
    "stream_event_time_totals_batches": stream_event_time_totals_batches,
    "stream_late_dropped": stream_late_dropped,
    "stream_late_records": stream_late_records,
    "stream_late_counted": stream_late_counted,
    "stream_refires": stream_refires,
    "stream_state_snapshot": stream_state_snapshot,
    "stream_totals_beside_quarantine": stream_totals_beside_quarantine,
}


def registered(name: str):
    """The query as the driver calls it: settings applied first, zone-less times in the result."""
    query = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_times(query(configure(spark), str(sf_dir).rstrip("/")))

    run.__name__ = name
    return run

"""The given tables seen as sales, and as the JSON messages that carry them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.sources.replay import replay


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table as one micro-batch, since its files need not be in arrival order.

    The pattern matches a single file as well as a folder of files; a plain path would have to be
    a folder.
    """
    schema = table(spark, sf_dir, name).schema
    return replay(spark, f"{sf_dir}/{name}.parque[t]", schema)


def orders_as_sales(
    orders: DataFrame, key: str = "o_custkey", scale: int = 1, also: Sequence[str] = ()
) -> DataFrame:
    """One sale per order; ``arrival`` is the unique order number."""
    time = F.col("o_orderdate").cast("timestamp")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("SalesId"),
        F.col(key).cast("string").alias("ProductName"),
        time.alias("SalesDateTime"),
        F.floor(F.col("o_totalprice") * scale).cast("int").alias("SalesAmount"),
        time.alias("EventProcessingTime"),
        F.col("o_orderkey").alias("arrival"),
        *also,
    )


def events_as_sales(events: DataFrame) -> DataFrame:
    """One sale per event; ``arrival`` is the unique event number."""
    time = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").cast("string").alias("SalesId"),
        F.col("event_type").alias("ProductName"),
        time.alias("SalesDateTime"),
        F.round("value").cast("int").alias("SalesAmount"),
        time.alias("EventProcessingTime"),
        F.col("event_id").alias("arrival"),
    )


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def sale_message(sale_time: Column, amount: Column, event_time: Column, extra: str = "") -> Column:
    """JSON text of a sale whose times and amount are given as JSON texts."""
    return F.format_string(
        '{"SalesId":"%s","ProductName":"%s","SalesDateTime":%s,"SalesAmount":%s,'
        '"EventProcessingTime":%s' + extra + "}",
        "SalesId", "ProductName", sale_time, amount, event_time,
    )


def as_messages(sales: DataFrame) -> DataFrame:
    """Sales as JSON messages with millisecond ISO times: ``value`` and ``arrival``."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    sold, seen = (
        _quoted(F.date_format(c, pattern)) for c in ("SalesDateTime", "EventProcessingTime")
    )
    value = sale_message(sold, F.col("SalesAmount").cast("string"), seen)
    return sales.select(value.alias("value"), "arrival")


def as_topic(messages: DataFrame) -> DataFrame:
    """Messages with the columns of a topic, spread over eight partitions against their order."""
    arrival = F.col("arrival")
    return messages.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        (7 - F.pmod(arrival, F.lit(8))).cast("int").alias("partition"),
        F.floor(arrival / 8).cast("bigint").alias("offset"),
        F.lit(0).cast("timestamp").alias("timestamp"),
    )


def orders_as_mixed_messages(orders: DataFrame) -> DataFrame:
    """Every order as a message, in turn with ISO times, with epoch milliseconds and an
    untruncated amount, and with quoted milliseconds and amount."""
    sales = orders_as_sales(orders, also=["o_totalprice"])
    time = F.col("EventProcessingTime")
    price = F.col("o_totalprice").cast("string")
    whole = F.col("SalesAmount").cast("string")
    millis = F.unix_millis(time).cast("string")
    iso = _quoted(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSZ"))
    form = F.pmod("arrival", F.lit(3))
    value = (
        F.when(form == 0, sale_message(iso, whole, iso))
        .when(form == 1, sale_message(millis, price, millis))
        .otherwise(sale_message(_quoted(millis), _quoted(whole), _quoted(millis)))
    )
    return sales.select(value.alias("value"), "arrival")


def orders_with_bad_messages(orders: DataFrame) -> DataFrame:
    """Every order as a message, some replaced: text that is no JSON, nothing, a JSON null."""
    messages = as_messages(orders_as_sales(orders))
    replaced = (
        F.when(F.pmod("arrival", F.lit(97)) == 0, "not json")
        .when(F.pmod("arrival", F.lit(101)) == 0, "")
        .when(F.pmod("arrival", F.lit(103)) == 0, "null")
        .otherwise(F.col("value"))
    )
    return messages.withColumn("value", replaced)


def orders_with_bad_fields(orders: DataFrame) -> DataFrame:
    """Every order as a message, some with a field that is wrong, missing or unknown."""
    time = _quoted(F.col("EventProcessingTime").cast("string"))
    amount = F.col("SalesAmount").cast("string")
    good = sale_message(time, amount, time)
    no_key = F.regexp_replace(good, '"ProductName":"[^"]*"', '"ProductName":null')
    value = (
        F.when(F.pmod("arrival", F.lit(7)) == 0, sale_message(time, F.lit("99999999999"), time))
        .when(F.pmod("arrival", F.lit(11)) == 0, sale_message(F.lit('"garbage"'), amount, time))
        .when(F.pmod("arrival", F.lit(13)) == 0, no_key)
        .when(F.pmod("arrival", F.lit(17)) == 0, sale_message(time, amount, F.lit("null")))
        .when(F.pmod("arrival", F.lit(19)) == 0, sale_message(time, amount, time, ',"Extra":1'))
        .when(F.pmod("arrival", F.lit(23)) == 0, sale_message(time, F.lit("null"), time))
        .otherwise(good)
    )
    return orders_as_sales(orders).select(value.alias("value"), "arrival")

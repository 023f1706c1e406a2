"""Message-topic source: connection options and the stream of messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Arrival order of topic messages: every partition's own order, made total by its number.
TOPIC_ARRIVAL = ("offset", "partition")


def connection_options(config: Mapping, *path: str) -> dict[str, str]:
    """Flat client options from a block of a configuration mapping.

    ``path`` names the nested block. Client properties such as ``bootstrap.servers`` or
    ``sasl.mechanism`` get the ``kafka.`` prefix that Spark passes on. Secrets come from the caller.
    """
    block = config
    for name in path:
        block = block[name]
    options = {}
    for name, value in block.items():
        if isinstance(value, Mapping):
            raise ValueError(f"option {name} is a block, not a value")
        options[name if name.startswith("kafka.") else f"kafka.{name}"] = str(value)
    if "kafka.bootstrap.servers" not in options:
        raise ValueError("the connection options lack bootstrap.servers")
    return options


def topic_options(
    connection: Mapping[str, str],
    topic: str,
    starting_offsets: str = "earliest",
    group_id: str | None = None,
    max_per_batch: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. Offsets live in the checkpoint, so a consumer group is optional.

    ``starting_offsets`` applies to the first start only; a restart resumes from the checkpoint.
    ``max_per_batch`` bounds a micro-batch, ``min_partitions`` splits large topic partitions.
    """
    options = {**connection, "subscribe": topic, "startingOffsets": starting_offsets}
    if group_id is not None:
        options["kafka.group.id"] = group_id
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Stream of message bodies. Key, headers and broker time are dropped; the position is kept
    until arrival order has been used. Needs the Kafka connector on the classpath."""
    return value_only(spark.readStream.format("kafka").options(**options).load())


def value_only(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("value"), *TOPIC_ARRIVAL)

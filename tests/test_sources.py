"""Connection and reader options, and the shared work folder."""

import pytest

from salesflow.sources.topic import connection_options, topic_options, value_only
from salesflow.session import work_dir

CONFIG = {
    "home": {
        "consumer": {
            "bootstrap.servers": "broker:9093",
            "request.timeout.ms": 60000,
            "security.protocol": "SASL_SSL",
            "sasl.mechanism": "PLAIN",
            "sasl.jaas.config": "<from the caller>",
        }
    }
}


def test_connection_options():
    assert connection_options(CONFIG, "home", "consumer") == {
        "kafka.bootstrap.servers": "broker:9093",
        "kafka.request.timeout.ms": "60000",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": "<from the caller>",
    }
    assert connection_options({"kafka.bootstrap.servers": "b:1"}) == {
        "kafka.bootstrap.servers": "b:1"
    }


def test_connection_options_refused():
    with pytest.raises(ValueError, match="bootstrap.servers"):
        connection_options({"sasl.mechanism": "PLAIN"})
    with pytest.raises(ValueError, match="is a block"):
        connection_options(CONFIG, "home")


def test_topic_options():
    connection = {"kafka.bootstrap.servers": "b:1"}
    assert topic_options(connection, "sales") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "sales", "startingOffsets": "earliest"
    }
    more = topic_options(
        connection, "sales", starting_offsets="latest", group_id="g", max_per_batch=10,
        min_partitions=64,
    )
    assert more == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "sales",
        "startingOffsets": "latest",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "10",
        "minPartitions": "64",
    }


def test_value_only(spark):
    df = spark.sql(
        "SELECT cast('k' as binary) AS key, cast('v' as binary) AS value, 't' AS topic,"
        " 3 AS partition, 9L AS offset, current_timestamp() AS timestamp, 0 AS timestampType"
    )
    assert value_only(df).columns == ["value", "offset", "partition"]


def test_work_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = work_dir(spark, "a"), work_dir(spark, "a")
    assert one.startswith(f"{root}/a-") and one != two


def test_job_arguments(tmp_path):
    import json

    import run_job

    (tmp_path / "connection.json").write_text(json.dumps(CONFIG))
    args = run_job.arguments(
        ["running-totals", "--config", str(tmp_path / "connection.json"), "--block", "home",
         "--block", "consumer", "--topic", "sales", "--table", "/t", "--checkpoint", "/c",
         "--max-per-batch", "5"]
    )
    options = run_job.reader_options(args)
    assert options["subscribe"] == "sales" and options["maxOffsetsPerTrigger"] == "5"
    assert options["kafka.bootstrap.servers"] == "broker:9093"
    to = run_job.target(args)
    assert (to.path, to.checkpoint, to.format, to.every) == ("/t", "/c", "delta", "10 seconds")
    assert run_job.job_options(args) == {"unknown_fields": "ignore"}
    assert set(run_job.JOBS) == {
        "land", "running-totals", "processing-time-totals", "event-time-totals"
    }


def test_topic_needs_its_connector(spark):
    """The connector is not part of Spark's own jars; without it the source says so."""
    from salesflow.sources.topic import read_topic

    options = topic_options({"kafka.bootstrap.servers": "b:1"}, "sales")
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, options)

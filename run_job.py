"""Start one of the four jobs on a message topic, for use with spark-submit.

    spark-submit --packages <kafka and delta connectors> run_job.py land \
        --config connection.json --block kafka-consumer --topic sales \
        --table <path> --checkpoint <path> --format delta

The connection file is JSON; it holds the client properties, or a block that does.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from salesflow.plans import jobs  # noqa: E402
from salesflow.session import configure  # noqa: E402
from salesflow.sources.topic import connection_options, read_topic, topic_options  # noqa: E402
from salesflow.streaming.sinks import Target  # noqa: E402

JOBS = {
    "land": jobs.land_sales,
    "running-totals": jobs.running_totals,
    "processing-time-totals": jobs.processing_time_totals,
    "event-time-totals": jobs.event_time_totals,
}


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--config", required=True, help="JSON file with the client properties")
    parser.add_argument("--block", action="append", default=[], help="block in it; repeatable")
    parser.add_argument("--topic", required=True)
    parser.add_argument("--group-id")
    parser.add_argument("--starting-offsets", default="earliest")
    parser.add_argument("--max-per-batch", type=int)
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--table", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--format", default="delta")
    parser.add_argument("--every", default="10 seconds")
    parser.add_argument("--available-now", action="store_true")
    parser.add_argument("--quarantine", help="table for refused messages; without it they fail")
    parser.add_argument("--files", type=int, help="files per commit, for window totals")
    parser.add_argument("--unknown-fields", default="ignore", choices=["ignore", "reject"])
    parser.add_argument("--overflow", choices=["error", "wrap"], help="not for land")
    parser.add_argument("--id", choices=["random", "deterministic"], help="for window totals")
    parser.add_argument("--lateness", help="keeps event-time windows open longer")
    parser.add_argument("--refires", action="store_const", const=True, help="corrected totals for late sales within the lateness")
    parser.add_argument("--late", help="table for sales that come after their event-time window")
    parser.add_argument("--expire-after", help="for running totals: forget products without a sale for so long")
    return parser.parse_args(argv)


def reader_options(args: argparse.Namespace) -> dict[str, str]:
    connection = connection_options(json.loads(Path(args.config).read_text()), *args.block)
    return topic_options(
        connection, args.topic, args.starting_offsets, args.group_id, args.max_per_batch,
        args.min_partitions,
    )


def target(args: argparse.Namespace) -> Target:
    return Target(
        args.table, args.checkpoint, args.format, args.every, args.available_now, args.quarantine,
        args.files, args.late,
    )


def job_options(args: argparse.Namespace) -> dict[str, str]:
    """The options given; a job refuses those that are not its own."""
    names = ("unknown_fields", "overflow", "id", "lateness", "refires", "expire_after")
    return {name: getattr(args, name) for name in names if getattr(args, name) is not None}


def start(spark: SparkSession, args: argparse.Namespace) -> jobs.Job:
    messages = read_topic(configure(spark), reader_options(args))
    return JOBS[args.job](messages, target(args), **job_options(args))


if __name__ == "__main__":
    session = SparkSession.builder.appName("salesflow").getOrCreate()
    start(session, arguments()).await_termination()

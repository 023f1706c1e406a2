"""Append-only table sinks, their commit cadence, and reading the tables back."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from salesflow.functions.ids import sale_line
from salesflow.schema import check_schema
from salesflow.sources.replay import replay
from salesflow.streaming.progress import watch

BATCH = "batch_id"
WRITER = "writer"
ATTEMPT = "attempt"
COMMITS = "_commits"
FILE_LOG = "_spark_metadata"


@dataclass(frozen=True)
class Target:
    """Where a job appends: table path, checkpoint folder, format and commit cadence.

    Refused messages go to ``quarantine``; without it the first one fails the job.
    ``available_now`` handles what is there and stops, instead of running every ``every``.
    ``files`` bounds the files a commit adds, by one more shuffle of the result rows: for window
    totals, which are few but come from as many tasks as there are state partitions. ``late`` keeps the
    records that come after their event-time window is over.
    """

    path: str
    checkpoint: str
    format: str = "parquet"
    every: str = "10 seconds"
    available_now: bool = False
    quarantine: str | None = None
    files: int | None = None
    late: str | None = None

    def for_quarantine(self) -> Target:
        return replace(self, path=self.quarantine, checkpoint=f"{self.checkpoint}-quarantine")

    def for_late(self) -> Target:
        return replace(self, path=self.late, late=None)

    def for_decoded(self) -> Target:
        """Where messages are decoded to for the queries of one job."""
        folder = f"{self.checkpoint}-decoded"
        return replace(self, path=f"{folder}/table", checkpoint=f"{folder}/checkpoint", format="parquet", files=None)


def _writer(df: DataFrame, target: Target) -> DataStreamWriter:
    watch(df.sparkSession)
    writer = df.writeStream.outputMode("append").option("checkpointLocation", target.checkpoint)
    if target.available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=target.every)


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's for a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _refuse(spark: SparkSession, target: Target, other: str) -> None:
    """Fail if the table holds files of the other layout, which readers would hide or mix up."""
    files, path = _files(spark, f"{target.path}/{other}")
    found = files.globStatus(path)
    if target.format != "delta" and found is not None and len(found):
        raise ValueError(f"{target.path} was written in another layout ({other}); use a new table path")


def _records(spark: SparkSession, path: str, pattern: str) -> list[tuple[str, str, str]] | None:
    """(writer, batch, attempt) of the committed batches; None if the table has no such records."""
    files, folder = _files(spark, f"{path}/{COMMITS}")
    if not files.exists(folder):
        return None
    found = [(s.getPath().getParent().getName(), *s.getPath().getName().split("-", 1)) for s in files.globStatus(_files(spark, f"{path}/{COMMITS}/{pattern}")[1])]
    first: dict[tuple[str, str], str] = {}  # of two attempts, which only a driver believed dead could commit, one counts
    for writer, batch, attempt in sorted(found):
        first.setdefault((writer, batch), attempt)
    return [(*key, attempt) for key, attempt in first.items()]


def _folder(writer: str, batch: str | int, attempt: str) -> str:
    return f"{WRITER}={writer}/{BATCH}={int(batch)}/{ATTEMPT}={attempt}"


def _commit(spark: SparkSession, path: str, writer: str, batch_id: int, attempt: str) -> None:
    """Make an attempt's folder the batch, by creating an empty file, and drop what other attempts left."""
    files, record = _files(spark, f"{path}/{COMMITS}/{writer}/{batch_id:012d}-{attempt}")
    files.create(record, False).close()
    for other in files.listStatus(_files(spark, f"{path}/{WRITER}={writer}/{BATCH}={batch_id}")[1]):
        if other.getPath().getName() != f"{ATTEMPT}={attempt}":
            files.delete(other.getPath(), True)


def _writer_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark drew for a checkpoint when it was made; a new checkpoint at the same path has another."""
    return spark.read.json(f"{checkpoint}/metadata").first().id


def append_stream(df: DataFrame, target: Target, table: StructType) -> StreamingQuery:
    """Append a stream to its table, exactly once per checkpoint, after checking the columns."""
    check_schema(df, table)
    _refuse(df.sparkSession, target, f"{WRITER}=*")
    if target.files is not None:
        df = df.repartition(target.files)
    return _writer(df, target).format(target.format).option("path", target.path).start()


def read_appended(df: DataFrame, target: Target) -> DataFrame:
    """Stream over the table that ``append_stream`` fills from ``df``, by the sink's log: committed files only."""
    files, log = _files(df.sparkSession, f"{target.path}/{FILE_LOG}")
    files.mkdirs(log)  # a source that finds no log at its start would take all files for committed
    return replay(df.sparkSession, target.path, df.schema, target.format)


def append_each_batch(df: DataFrame, target: Target, handle) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` per micro-batch; it must be repeatable for one batch id."""
    for other in (FILE_LOG, f"{BATCH}=*", f"{WRITER}=*/{BATCH}=*/*.*"):
        _refuse(df.sparkSession, target, other)
    return _writer(df, target).foreachBatch(handle).start()


def append_batch(df: DataFrame, batch_id: int, target: Target, checkpoint: str | None = None) -> DataFrame:
    """Append one micro-batch so that a repeated batch id leaves the table unchanged.

    Batch ids count per checkpoint, so they are kept under the checkpoint's own id: a new
    checkpoint on an old table appends. Delta tables remember both. For plain files an attempt
    writes a folder of its own, which becomes the batch when its commit record is created: readers that follow the
    records (``read_table``) see a batch whole or not at all, and a repeated batch that is committed is not
    written again. ``checkpoint`` is that of the running query, if not the target's. Returns the
    appended rows, not to be computed again.
    """
    spark = df.sparkSession
    writer = _writer_id(spark, checkpoint or target.checkpoint)
    if target.files is not None:
        df = df.repartition(target.files)
    if target.format == "delta":
        df = df.persist()
        (
            df.write.format("delta").mode("append")
            .option("txnAppId", writer).option("txnVersion", batch_id)
            .save(target.path)
        )
        return df
    done = _records(spark, target.path, f"{writer}/{batch_id:012d}-*")
    attempt = done[0][2] if done else uuid.uuid4().hex
    folder = f"{target.path}/{_folder(writer, batch_id, attempt)}"
    if not done:
        df.write.format(target.format).save(folder)
        _commit(spark, target.path, writer, batch_id, attempt)
    return spark.read.schema(df.schema).format(target.format).load(folder)


def print_sales(sales: DataFrame, checkpoint: str, every: str = "10 seconds") -> StreamingQuery:
    """Print each sale of a stream as one line."""
    lines = sales.select(sale_line().alias("sale"))
    return (
        _writer(lines, Target("", checkpoint, every=every))
        .format("console").option("truncate", "false").start()
    )


def read_table(
    spark: SparkSession,
    path: str,
    table: StructType,
    format: str = "parquet",
    view: str | None = None,
) -> DataFrame:
    """The landed table with its declared columns, as a temporary view for SQL if ``view`` is set.

    It holds the batches committed when this is called, whole: by the records of ``append_batch``, or the
    file sink's own log."""
    reader = spark.read.format(format)
    records = None
    if format != "delta":
        reader = reader.schema(table)
        records = _records(spark, path, "*/*")
    if records == []:
        df = spark.createDataFrame([], table)
    else:
        df = reader.load(path if records is None else [f"{path}/{_folder(*r)}" for r in records])
    df = df.select(*[F.col(name) for name in table.fieldNames()])
    if view is not None:
        df.createOrReplaceTempView(view)
    return df

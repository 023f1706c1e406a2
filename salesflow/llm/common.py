"""Tables, shared folders, and what Python workers need."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from salesflow.session import work_dir

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared work folder and read back: cuts lineage, survives lost
    executors, and fixes whatever a second evaluation might decide otherwise."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, as ``--py-files`` would, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{PACKAGE.name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


BATCH_BYTES = 8 << 20


def _release() -> None:
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _released(function: Callable) -> Callable:
    """The function, after which an idle worker holds no freed memory."""

    def run(batches):
        yield from function(batches)
        _release()

    return run


def released_group(function: Callable) -> Callable:
    """The function of a group and its key, after which the worker holds no freed memory."""

    def run(key, table):
        out = function(key, table)
        _release()
        return out

    return run


def drop_shuffles(spark: SparkSession) -> None:
    """Collects the driver's garbage, upon which Spark deletes shuffle files of tables that nothing refers to any more.
    Without it those of all rounds stay until the driver happens to do so."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def arrow_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable on the workers, and batches of up to BATCH_BYTES: the
    session's bound is lowered to that, so that memory does not follow the length of texts."""
    spark = df.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(_released(function), schema)


def store(uri: str):
    """(file system, path) of a folder, for files that tasks read and write by themselves."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))

"""Session settings the engine relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROCKSDB_SETTINGS = "spark.sql.streaming.stateStore.rocksdb"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results depend on; sizing stays with the cluster.

    UTC makes record timestamps and epoch-based window bounds agree. ANSI makes a bad cast an
    error instead of a null. The RocksDB store is required by ``transformWithState``; with the
    changelog a micro-batch uploads what it changed instead of whole state files.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set(f"{ROCKSDB_SETTINGS}.changelogCheckpointing.enabled", "true")
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, reachable from every executor.

    Only a local session without that setting gets a folder on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="salesflow-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

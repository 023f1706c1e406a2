"""File sources: the same jobs over recorded messages or tables, as a stream or as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def replay(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    format: str = "parquet",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream over files, oldest first; without ``files_per_batch`` all files form one batch."""
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(format).load(path)


def recorded(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    format: str = "parquet",
    **options: str,
) -> DataFrame:
    """The same files as a batch."""
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(format).load(path)

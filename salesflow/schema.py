"""Record and table schemas, and the check made before anything is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


# Field names and types of the sales record and of the four output tables.
SALE = _table(
    ("SalesId", T.StringType()),
    ("ProductName", T.StringType()),
    ("SalesDateTime", T.TimestampType()),
    ("SalesAmount", T.IntegerType()),
    ("EventProcessingTime", T.TimestampType()),
)
RUNNING_TOTAL = _table(
    ("SalesId", T.StringType()),
    ("ProductName", T.StringType()),
    ("SalesDateTime", T.TimestampType()),
    ("TotalSalesAmount", T.IntegerType()),
    ("EventProcessingTime", T.TimestampType()),
)
WINDOW_TOTAL = _table(
    ("SalesId", T.StringType()),
    ("ProductName", T.StringType()),
    ("WindowStartTime", T.TimestampType()),
    ("SalesAmount", T.IntegerType()),
    ("WindowEndTime", T.TimestampType()),
)


def totals_table(table: T.StructType, overflow: str) -> T.StructType:
    """The table with the type that totals have under ``overflow``: 64 bits for ``"bigint"``."""
    if overflow != "bigint":
        return table
    wide = T.LongType()
    return T.StructType([T.StructField(f.name, wide if f.dataType == T.IntegerType() else f.dataType) for f in table.fields])


QUARANTINE = _table(("value", T.StringType()), ("reason", T.StringType()))


def check_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Return ``df`` if its column names, order and types are the declared ones, else raise."""
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    wanted = [(f.name, f.dataType.simpleString()) for f in declared.fields]
    if actual != wanted:
        raise ValueError(f"output columns {actual} differ from the declared table {wanted}")
    return df

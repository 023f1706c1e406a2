"""What must stop a query.

Spark would group a null key and drop a null time without a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _message(column: str, role: str) -> Column:
    return F.lit(f"null {role} in column {column}")


def known(column: str, role: str) -> Column:
    """The column's value; a null fails the query."""
    return F.coalesce(F.col(column), F.raise_error(_message(column, role)))


def without_nulls(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    """``df``, failing on a null in these columns.

    As a filter it leaves the columns themselves alone, so that a condition on them still reaches
    the scan. Not for a column that an operator drops nulls of, such as a window's time: that
    would go first.
    """
    for column, role in roles.items():
        failed = F.raise_error(_message(column, role))
        df = df.where(F.when(F.col(column).isNotNull(), F.lit(True)).otherwise(failed))
    return df


def batch_only(df: DataFrame, instead: str) -> None:
    """Refuse a streaming DataFrame and name what to use for it."""
    if df.isStreaming:
        raise ValueError(f"this operator takes batch data; on a stream use {instead}")

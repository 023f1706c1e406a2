"""Amounts: sums run in bigint and are narrowed once, at the output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def narrow(total: Column, overflow: str = "error") -> Column:
    """Narrow a bigint sum to int.

    ``overflow="error"`` raises for a sum outside the int range; ``"wrap"`` keeps the low 32 bits,
    as 32-bit addition would; ``"bigint"`` keeps the sum as it is.
    """
    if overflow == "bigint":
        return total
    if overflow == "wrap":
        low = total.bitwiseAND(F.lit(2**32 - 1))
        return (low.bitwiseXOR(F.lit(2**31)) - F.lit(2**31)).cast("int")
    if overflow != "error":
        raise ValueError(f"overflow must be 'error', 'wrap' or 'bigint', not {overflow!r}")
    message = F.concat(F.lit("sales total does not fit a 32-bit int: "), total.cast("string"))
    return F.when(
        total.isNull() | total.between(INT_MIN, INT_MAX), total.cast("int")
    ).otherwise(F.raise_error(message))

"""Ids and display texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesflow.schema import SALE


def window_id(key: Column, start: Column, kind: str = "random") -> Column:
    """Id of a window total: a new UUID, or a digest of key and start that survives replays."""
    if kind == "random":
        return F.expr("uuid()")
    if kind != "deterministic":
        raise ValueError(f"id must be 'random' or 'deterministic', not {kind!r}")
    micros = F.unix_micros(start.cast("timestamp"))
    return F.md5(F.concat_ws("~", key.cast("string"), micros.cast("string")))


def sale_line() -> Column:
    """One readable line per sale, for console output."""
    parts = ", ".join(f"{f.name}: %s" for f in SALE.fields)
    return F.format_string(parts, *[F.col(f.name).cast("string") for f in SALE.fields])

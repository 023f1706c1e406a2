"""Typing of the raw JSON field texts of a sales record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last millisecond of the years 0001 to 9999, the range Spark timestamps print in.
FIRST_MILLI, LAST_MILLI = -62135596800000, 253402300799999


def amount(raw: Column) -> Column:
    """Int from a JSON number or numeric text; fractions truncate, null and blank count as 0.

    Null only for a text that is no number or does not fit. The fraction is cut off the text, since
    a decimal cast would round it first; numbers with an exponent are read as doubles.
    """
    plain = raw.rlike(r"^\s*[+-]?\d+(\.\d*)?\s*$")
    whole = F.regexp_extract(raw, r"^\s*([+-]?\d+)", 1).try_cast("decimal(38,0)").try_cast("int")
    other = raw.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
    number = F.when(plain, whole).when(other, raw.try_cast("double").try_cast("int"))
    return F.when(raw.isNull() | (F.trim(raw) == ""), F.lit(0)).otherwise(number)


def instant(raw: Column) -> Column:
    """Timestamp from epoch milliseconds, an ISO-8601 text or an RFC-1123 date.

    Null for anything else. A full date is required: a bare time or a word such as ``now`` would
    otherwise be read relative to today.
    """
    millis = raw.try_cast("bigint")
    iso = raw.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([T ].*)?$")
    rfc = raw.rlike(r"^[A-Z][a-z]{2}, \d{2} [A-Z][a-z]{2} \d{4} ")
    return (
        F.when(
            raw.rlike(r"^-?\d+$"),
            F.when(millis.between(FIRST_MILLI, LAST_MILLI), F.timestamp_millis(millis)),
        )
        .when(iso, raw.try_cast("timestamp"))
        .when(rfc, F.try_to_timestamp(F.substring(raw, 6, 64), F.lit("dd MMM yyyy HH:mm:ss zzz")))
    )

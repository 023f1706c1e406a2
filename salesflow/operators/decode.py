"""JSON messages to typed sales, with a reason for every message that is not one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions.fields import amount, instant
from salesflow.schema import QUARANTINE, SALE

_CORRUPT = "_corrupt"
_NO_RECORD = "no_record"
_JSON_SPACE = " \t\n\r"
_BYTE_ORDER_MARK = "\ufeff"
_RAW_FIELDS = ", ".join([f"{f.name} string" for f in SALE.fields] + [f"{_CORRUPT} string"])


def _nested(raw: Column, name: str) -> Column:
    """Whether a text field holds an object or array. Only values that look like one are parsed again."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(F.col("_text")), f"$.{name}", "variant"))
    return F.when(raw.rlike(r"^[\[{]"), F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.lit(False))).otherwise(F.lit(False))


def decode_sales(df: DataFrame, value: str = "value", unknown_fields: str = "ignore") -> DataFrame:
    """Decode the JSON text or bytes in ``value``.

    Returns the other columns of ``df`` (arrival order, for instance), the five sale columns, the
    message text as ``value`` and ``reason``: null for a sale, else why the message is refused.
    A literal ``null`` message is no record and is left out. All fields are parsed as text and
    typed afterwards, so that numbers, numeric texts and epoch milliseconds are told apart. Objects and
    arrays are no text. JSON's white space and a byte order mark around a message do not count.

    ``unknown_fields="reject"`` refuses messages with fields outside the record. Batch and stream.
    """
    if unknown_fields not in ("ignore", "reject"):
        raise ValueError(f"unknown_fields must be 'ignore' or 'reject', not {unknown_fields!r}")
    body = F.col(value)
    text = F.ltrim(F.coalesce(body.cast("string"), F.lit("")), F.lit(_BYTE_ORDER_MARK + _JSON_SPACE))
    text = F.rtrim(text, F.lit(_JSON_SPACE))
    json = F.col("_json")
    raw_sold, raw_seen, raw_amount = json.SalesDateTime, json.EventProcessingTime, json.SalesAmount

    unknown = F.lit(False)
    if unknown_fields == "reject":
        known = F.array(*[F.lit(f.name) for f in SALE.fields])
        extra = F.array_except(F.json_object_keys(F.col("_text")), known)
        unknown = F.coalesce(F.size(extra) > 0, F.lit(False))

    typed = F.struct(
        json.SalesId.alias("SalesId"),
        json.ProductName.alias("ProductName"),
        instant(raw_sold).alias("SalesDateTime"),
        amount(raw_amount).alias("SalesAmount"),
        instant(raw_seen).alias("EventProcessingTime"),
    )
    sale = F.col("_sale")
    no_time = F.lit(False)
    for raw, time in ((raw_sold, sale.SalesDateTime), (raw_seen, sale.EventProcessingTime)):
        no_time = no_time | (time.isNull() & raw.isNotNull() & (F.trim(raw) != ""))
    reason = (
        F.when(F.col("_text") == "", "empty")
        .when(F.col("_text") == "null", _NO_RECORD)
        .when(json[_CORRUPT].isNotNull() | ~F.col("_utf8"), "corrupt")
        .when(unknown, "unknown_field")
        .when(_nested(json.ProductName, "ProductName") | _nested(json.SalesId, "SalesId"), "bad_field")
        .when(sale.SalesAmount.isNull(), "bad_amount")
        .when(no_time, "bad_time")
        .when(sale.ProductName.isNull(), "null_key")
        .when(sale.SalesDateTime.isNull() | sale.EventProcessingTime.isNull(), "null_time")
    )

    keep = [F.col(c) for c in df.columns if c != value]
    utf8 = F.coalesce(F.is_valid_utf8(body.cast("string")), F.lit(True)).alias("_utf8")
    parsed = df.select(*keep, text.alias("_text"), utf8)
    parsed = parsed.withColumn(
        "_json", F.from_json("_text", _RAW_FIELDS, {"columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"})
    )
    parsed = parsed.withColumn("_sale", typed)
    # inline() keeps later filters on the result above the parser. Pushed below it, a filter on
    # `reason` would parse every message once more per field it looks at.
    row = F.struct("_sale.*", F.col("_text").alias("value"), reason.alias("reason"))
    decoded = parsed.select(*keep, F.inline(F.array(row)))
    return decoded.where(~F.col("reason").eqNullSafe(_NO_RECORD))


def good_sales(decoded: DataFrame) -> DataFrame:
    """The decoded sales, without ``value`` and ``reason``."""
    return decoded.where(F.col("reason").isNull()).drop("value", "reason")


def quarantined(decoded: DataFrame) -> DataFrame:
    """The refused messages with the reason."""
    return decoded.where(F.col("reason").isNotNull()).select(*QUARANTINE.fieldNames())


def strict_sales(decoded: DataFrame) -> DataFrame:
    """The decoded sales; the first refused message fails the query."""
    message = F.concat(F.lit("malformed sales message: "), F.col("reason"))
    # The literal null is named here too: Spark may test this filter before the one that skips it.
    fine = F.col("reason").isNull() | (F.col("reason") == _NO_RECORD)
    ok = F.when(fine, F.lit(True)).otherwise(F.raise_error(message))
    return decoded.where(ok).drop("value", "reason")


def sale_rows(df: DataFrame) -> DataFrame:
    """The five sale columns, in table order and with the table's types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SALE.fields])

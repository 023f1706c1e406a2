"""The coercion table, message by message."""

import datetime as dt

import pytest

from salesflow.operators.decode import decode_sales, good_sales, quarantined, strict_sales

FIELDS = {
    "SalesId": '"s"',
    "ProductName": '"p"',
    "SalesDateTime": "1704067200000",
    "SalesAmount": "5",
    "EventProcessingTime": "1704067200000",
}


def sale(**changes):
    fields = {**FIELDS, **changes}
    return "{" + ",".join(f'"{k}":{v}' for k, v in fields.items() if v is not None) + "}"


def utc(*parts):
    return dt.datetime(*parts)


def decode(spark, value, **options):
    df = spark.createDataFrame([(value, 1)], "value string, arrival int")
    return decode_sales(df, **options)


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("1704067200123", utc(2024, 1, 1, 0, 0, 0, 123000)),
        ('"1704067200123"', utc(2024, 1, 1, 0, 0, 0, 123000)),
        ("-1000", utc(1969, 12, 31, 23, 59, 59)),
        ('"2024-01-01T00:00:00.123+0000"', utc(2024, 1, 1, 0, 0, 0, 123000)),
        ('"2024-01-01T00:00:00.123Z"', utc(2024, 1, 1, 0, 0, 0, 123000)),
        ('"2024-01-01T02:00:00+02:00"', utc(2024, 1, 1)),
        ('"2024-01-01T00:00:00"', utc(2024, 1, 1)),
        ('"2024-01-01 00:00:01"', utc(2024, 1, 1, 0, 0, 1)),
        ('"2024-01-01"', utc(2024, 1, 1)),
        ('"Mon, 01 Jan 2024 00:00:05 GMT"', utc(2024, 1, 1, 0, 0, 5)),
    ],
)
def test_times(spark, raw, expected):
    row = decode(spark, sale(SalesDateTime=raw)).selectExpr(
        "reason", "cast(SalesDateTime as timestamp_ntz) as t"
    ).first()
    assert (row.reason, row.t) == (None, expected)


@pytest.mark.parametrize(
    "raw,expected",
    [
        ('"7"', 7), ("7.9", 7), ("-7.9", -7), ("1e2", 100), ("null", 0), (None, 0), ('""', 0),
        ("2147483647", 2147483647), ("-2147483648", -2147483648),
        ("29.999999999999996", 29), ("-29.999999999999996", -29), ("2147483647.9", 2147483647),
        ("2.9999999999999996e1", 29), ('".5"', 0), ('" 8.99 "', 8),
    ],
)
def test_amounts(spark, raw, expected):
    row = decode(spark, sale(SalesAmount=raw)).first()
    assert (row.reason, row.SalesAmount) == (None, expected)


@pytest.mark.parametrize(
    "value,reason",
    [
        ("not json", "corrupt"),
        ("[1]", "corrupt"),
        ("5", "corrupt"),
        ('{"SalesId":"a",}', "corrupt"),
        ("", "empty"),
        ("  ", "empty"),
        (None, "empty"),
        (sale(SalesAmount="99999999999"), "bad_amount"),
        (sale(SalesAmount="2147483648"), "bad_amount"),
        (sale(SalesAmount='"x"'), "bad_amount"),
        (sale(SalesAmount="true"), "bad_amount"),
        (sale(SalesAmount="1e60"), "bad_amount"),
        (sale(SalesDateTime='"garbage"'), "bad_time"),
        (sale(SalesDateTime='"now"'), "bad_time"),
        (sale(EventProcessingTime='"10:00:00"'), "bad_time"),
        (sale(EventProcessingTime='"2024-13-01"'), "bad_time"),
        (sale(EventProcessingTime="9223372036854775807"), "bad_time"),
        (sale(EventProcessingTime="99999999999999999999999"), "bad_time"),
        (sale(ProductName="null"), "null_key"),
        (sale(ProductName=None), "null_key"),
        (sale(SalesDateTime="null"), "null_time"),
        (sale(SalesDateTime='""'), "null_time"),
        (sale(EventProcessingTime=None), "null_time"),
        ('{"productname":"p"}', "null_key"),
        (sale(ProductName='{"x":1}'), "bad_field"),
        (sale(ProductName='["p"]'), "bad_field"),
        (sale(SalesId='{"x":{"y":[]}}'), "bad_field"),
        ("{'SalesId':'s'}", "corrupt"),
        ("\n", "empty"),
        (sale(SalesAmount='"NaN"'), "bad_amount"),
        (sale(SalesAmount='"1d"'), "bad_amount"),
    ],
)
def test_refused(spark, value, reason):
    decoded = decode(spark, value)
    row = quarantined(decoded).first()
    assert row.reason == reason
    assert row.value == (value or "").strip()
    assert good_sales(decoded).isEmpty()


def test_json_null_is_no_record(spark):
    assert decode(spark, "null").isEmpty()
    assert decode(spark, " null ").isEmpty()
    assert decode(spark, "\tnull\r\n").isEmpty()


@pytest.mark.parametrize("value", ["\ufeff" + sale(), "\n\t" + sale() + "\r\n", sale(ProductName='"{x}"'), sale(ProductName='"[p]"')])
def test_accepted(spark, value):
    assert decode(spark, value).first().reason is None


def test_unknown_fields(spark):
    value = sale(Extra="1")
    assert decode(spark, value).first().reason is None
    assert decode(spark, value, unknown_fields="reject").first().reason == "unknown_field"
    assert decode(spark, sale(), unknown_fields="reject").first().reason is None
    with pytest.raises(ValueError):
        decode(spark, value, unknown_fields="drop")


def test_bytes(spark):
    rows = [(bytearray(sale().encode()),), (bytearray(b'{"SalesId":"\xff"}'),), (None,)]
    df = decode_sales(spark.createDataFrame(rows, "value binary"))
    assert [r.reason for r in df.collect()] == [None, "corrupt", "empty"]


def test_a_null_id_passes(spark):
    assert decode(spark, sale(SalesId="null")).first().reason is None


def test_other_columns_are_kept(spark):
    assert good_sales(decode(spark, sale())).columns == ["arrival", *FIELDS]


def test_strict(spark):
    assert strict_sales(decode(spark, sale())).count() == 1
    assert strict_sales(decode(spark, "null")).collect() == []
    with pytest.raises(Exception, match="malformed sales message: bad_time"):
        strict_sales(decode(spark, sale(SalesDateTime='"x"'))).collect()


def test_messages_are_parsed_once(spark):
    """A filter on the outcome must not make the parser run again."""
    df = good_sales(decode(spark, sale()))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1

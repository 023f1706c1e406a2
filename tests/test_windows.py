"""Window totals, their options, lateness marks and the wall-clock windows."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from salesflow.operators import lateness
from salesflow.operators.lateness import count_late, mark_late, on_time_totals
from salesflow.operators.windows import closed_totals, longer_delay, tumbling_totals
from salesflow.plans import jobs
from salesflow.schema import SALE, WINDOW_TOTAL, check_schema
from salesflow.sources.replay import replay
from salesflow.streaming.sinks import Target, read_table

START = dt.datetime(2024, 1, 1)
SALES = "ProductName string, EventProcessingTime timestamp, SalesAmount int"


def sales(spark, *rows):
    data = [(key, START + dt.timedelta(seconds=s), amount) for key, s, amount in rows]
    return spark.createDataFrame(data, SALES)


def test_bounds_and_sums(spark):
    df = sales(spark, ("A", 0, 1), ("A", 29.999999, 2), ("A", 30, 4), ("B", 1, 8))
    rows = tumbling_totals(df).orderBy("ProductName", "WindowStartTime").collect()
    assert [(r.ProductName, r.SalesAmount) for r in rows] == [("A", 3), ("A", 4), ("B", 8)]
    assert rows[1].WindowStartTime == START + dt.timedelta(seconds=30)
    assert rows[1].WindowEndTime == START + dt.timedelta(seconds=60)
    assert len({r.SalesId for r in rows}) == 3


def test_schema(spark):
    check_schema(tumbling_totals(sales(spark, ("A", 0, 1))), WINDOW_TOTAL)
    with pytest.raises(ValueError, match="differ"):
        check_schema(tumbling_totals(sales(spark, ("A", 0, 1))), SALE)


def test_ids(spark):
    df = sales(spark, ("A", 0, 1))
    fixed = tumbling_totals(df, id="deterministic")
    assert fixed.first().SalesId == fixed.first().SalesId
    assert len(tumbling_totals(df).first().SalesId) == 36
    with pytest.raises(ValueError):
        tumbling_totals(df, id="none")
    with pytest.raises(ValueError):
        tumbling_totals(df, stamp="none")


def test_overflow(spark):
    df = sales(spark, ("A", 0, 2**31 - 1), ("A", 1, 1))
    assert tumbling_totals(df, overflow="wrap").first().SalesAmount == -(2**31)
    with pytest.raises(Exception, match="does not fit a 32-bit int"):
        tumbling_totals(df).collect()


def test_overflow_raises_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="does not fit a 32-bit int"):
            tumbling_totals(sales(spark, ("A", 0, 2**31 - 1), ("A", 1, 1))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("column,role", [("ProductName", "key"), ("EventProcessingTime", "time")])
def test_a_null_fails(spark, column, role):
    df = sales(spark, ("A", 0, 1), ("B", 100, 2))
    broken = df.withColumn(column, F.when(F.col("SalesAmount") < 2, F.col(column)))
    message = f"null {role} in column {column}"
    for totals in (tumbling_totals, closed_totals):
        with pytest.raises(Exception, match=message):
            totals(broken).collect()
    if role == "time":
        with pytest.raises(Exception, match=message):
            mark_late(broken.withColumn("batch", F.lit(1)), "batch").collect()


def test_a_null_amount_counts_as_nothing(spark):
    df = sales(spark, ("A", 0, None), ("B", 0, None), ("B", 0, 2))
    rows = tumbling_totals(df).collect()
    assert sorted((r.ProductName, r.SalesAmount) for r in rows) == [("A", 0), ("B", 2)]


def test_other_columns(spark):
    """Any keyed event table will do, zone-less times included."""
    df = sales(spark, ("7", 0, 1), ("7", 29, 2)).selectExpr(
        "cast(ProductName as bigint) as user", "cast(EventProcessingTime as timestamp_ntz) as ts",
        "SalesAmount as n",
    )
    rows = tumbling_totals(df, key="user", time="ts", amount="n", size="1 minute").collect()
    assert [(r.ProductName, r.SalesAmount) for r in rows] == [(7, 3)]


def test_emitted_stamp(spark):
    row = tumbling_totals(sales(spark, ("A", 0, 1)), stamp="emitted").first()
    assert row.WindowStartTime == START + dt.timedelta(seconds=30)
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    assert abs((row.WindowEndTime - now).total_seconds()) < 3600


def test_closed_at_the_threshold(spark):
    open_at = sales(spark, ("A", 0, 1), ("A", 39.999, 2))
    assert closed_totals(open_at).isEmpty()
    closed_at = sales(spark, ("A", 0, 1), ("A", 40, 2))
    assert [r.SalesAmount for r in closed_totals(closed_at).collect()] == [1]
    assert closed_totals(closed_at, lateness="1 second").isEmpty()


def test_longer_delay(spark):
    assert longer_delay("10 seconds", "0 seconds") == "10 seconds"
    text = longer_delay("10 seconds", "20 seconds")
    assert spark.sql(f"SELECT interval {text} = interval 30 seconds").first()[0]


@pytest.mark.parametrize("broadcast", [0, 100])
@pytest.mark.parametrize("first", [0, 1_000_003])
def test_late_marks_equal_a_loop(spark, broadcast, first, monkeypatch):
    monkeypatch.setattr(lateness, "BROADCAST_BATCHES", broadcast)
    rows = [
        (batch, "A" if i % 3 else "B", (batch * 37 + i * 53) % 300 + batch * 9)
        for batch in (0, 1, 2, 5, 6, 9) for i in range(12)
    ]
    expected, clock = [], None
    for batch in sorted({r[0] for r in rows}):
        for _, key, seconds in (r for r in rows if r[0] == batch):
            end = seconds - seconds % 30 + 30
            expected.append((batch, key, seconds, clock is not None and end <= clock - 10))
        clock = max([r[2] for r in rows if r[0] == batch] + [clock or 0])
    df = spark.createDataFrame(
        [(first + b, k, START + dt.timedelta(seconds=s), s) for b, k, s in rows],
        "batch bigint, ProductName string, EventProcessingTime timestamp, seconds int",
    )
    marked = mark_late(df, "batch")
    found = marked.select(F.col("batch") - first, "ProductName", "seconds", "late").collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    late = sum(r[3] for r in expected)
    counts = count_late(marked).agg(F.sum("late_rows"), F.sum("on_time_rows")).first()
    assert tuple(counts) == (late, len(rows) - late) and 0 < late < len(rows)
    totals = on_time_totals(df, "batch", amount="seconds").agg(F.sum("SalesAmount")).first()[0]
    assert totals == sum(r[2] for r in expected if not r[3])


def put_sales(path, rows):
    with open(path, "w") as out:
        for key, amount in rows:
            sale = {
                "SalesId": "s", "ProductName": key, "SalesAmount": amount,
                "SalesDateTime": 0, "EventProcessingTime": 0,
            }
            out.write(json.dumps({"value": json.dumps(sale)}) + "\n")


@pytest.fixture
def chunk_rows(spark, request):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


@pytest.mark.parametrize("chunk_rows", [1, 10000], indirect=True)
def test_wall_clock_windows_close_without_input(spark, tmp_path, chunk_rows):
    """Totals per window of arrival come out once, after the window's time, with no new messages.

    They do not depend on how many rows the Python workers are sent at a time.
    """
    folder = tmp_path / "in"
    folder.mkdir()
    put_sales(folder / "0.json", [("A", 1), ("A", 2), ("B", 4)])
    to = Target(str(tmp_path / "out"), str(tmp_path / "checkpoint"), every="500 milliseconds")
    source = replay(spark, str(folder), "value string", format="json")
    size = 4000
    began = time.time()
    job = jobs.processing_time_totals(source, to, size_millis=size)
    try:
        wait_for(job, lambda: total(spark, to) == {"A": 3, "B": 4})
        put_sales(folder / "1.json", [("A", 8), ("C", None)])
        wait_for(job, lambda: total(spark, to) == {"A": 11, "B": 4, "C": 0})
    finally:
        job.stop()
    rows = read_table(spark, to.path, WINDOW_TOTAL).collect()
    assert sorted((r.ProductName, r.SalesAmount) for r in rows) == [
        ("A", 3), ("A", 8), ("B", 4), ("C", 0)
    ]
    for row in rows:
        start = row.WindowStartTime.replace(tzinfo=dt.timezone.utc).timestamp()
        end = row.WindowEndTime.replace(tzinfo=dt.timezone.utc).timestamp()
        assert end - start == size / 1000 and end * 1000 % size == 0
        assert began - size / 1000 <= start <= time.time()


def total(spark, to):
    from pathlib import Path

    if not list(Path(to.path).glob("*.parquet")):
        return {}
    sums = read_table(spark, to.path, WINDOW_TOTAL).groupBy("ProductName").sum("SalesAmount")
    return {r[0]: r[1] for r in sums.collect()}


def wait_for(job, done, seconds=90):
    limit = time.time() + seconds
    while not done():
        assert job.main.exception() is None
        assert time.time() < limit, "the windows did not close"
        time.sleep(0.5)

"""Physical plans: what is shuffled, read and pushed down."""

import re

import pytest
from pyspark.sql import functions as F

from salesflow.operators import hot_keys
from salesflow.operators.lateness import mark_late
from salesflow.operators.running import dedupe_running_total, key_state
from salesflow.operators.windows import tumbling_totals
from salesflow.plans.tables import events_as_sales, orders_as_sales, table


@pytest.fixture(scope="module")
def events(spark, testdata):
    return events_as_sales(table(spark, str(testdata / "sf0.001"), "events"))


@pytest.fixture(scope="module")
def orders(spark, testdata):
    return orders_as_sales(table(spark, str(testdata / "sf0.001"), "orders"), "o_orderpriority")


def plan(df):
    """The physical plan before adaptive execution changes it."""
    return df._jdf.queryExecution().sparkPlan().toString(), (
        df._jdf.queryExecution().executedPlan().toString()
    )


def exchanges(df):
    return re.findall(r"Exchange (\w+\([^)]*\)|\w+)", plan(df)[1])


def read_columns(df):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(df)[1])
    return [set(re.findall(r"(\w+):", schema)) for schema in schemas]


def test_running_total_has_one_shuffle_and_one_sort(events):
    df = dedupe_running_total(events, rows_per_range=None)
    assert len(exchanges(df)) == 1
    assert plan(df)[1].count("Sort [") == 1
    assert plan(df)[1].count("Window [") == 2


def test_a_condition_on_the_key_reaches_the_scan(events):
    # Not through random ids: Spark keeps conditions above anything nondeterministic.
    windows = tumbling_totals(events, id="deterministic")
    for df in (dedupe_running_total(events, rows_per_range=None), windows):
        assert "EqualTo(event_type,click)" in plan(df.where(F.col("ProductName") == "click"))[1]


def test_windows_aggregate_before_the_shuffle(events):
    df = tumbling_totals(events)
    text = plan(df)[1]
    assert len(exchanges(df)) == 1
    assert text.index("functions=[sum") < text.index("Exchange") < text.index("partial_sum")
    assert read_columns(df) == [{"ts", "event_type", "value"}]


def test_hot_keys_are_shuffled_by_key_and_range(orders):
    df = dedupe_running_total(orders, rows_per_range=100)
    text = plan(df)[1]
    sorts = re.findall(r"Sort \[(.*?)\], false", text)
    # Rows are only ever sorted within (key, range); the other sorts are of per-range tables.
    rows = [s for s in sorts if "arrival" in s]
    assert len(rows) == 1 and all("_range" in s for s in rows)
    assert "SortMergeJoin" not in text
    # What ranges inherit comes from their staircases: no other pass over the rows.
    assert sum("o_orderkey" in columns for columns in read_columns(df)) == 1
    assert "o_custkey" not in set().union(*read_columns(df))


def test_large_per_range_tables_are_not_broadcast(orders, monkeypatch):
    monkeypatch.setattr(hot_keys, "BROADCAST_ROWS", 0)
    text = plan(dedupe_running_total(orders, rows_per_range=100))[1]
    assert text.count("ShuffledHashJoin") == 3
    # What is still broadcast is the bounded list of hot keys.
    assert len(re.findall(r"BroadcastHashJoin \[([^\]]*)\]", text)) == len(
        re.findall(r"BroadcastHashJoin \[ProductName#\d+\]", text)
    )


def test_state_is_one_aggregate_more_than_the_gate(events):
    df = key_state(events, rows_per_range=None)
    # The rows of a key are together already: no second shuffle.
    assert len(exchanges(df)) == 1


def test_late_marks_do_not_shuffle_the_rows(events):
    batched = events.withColumn("batch", F.col("arrival").cast("bigint") % 50)
    df = mark_late(batched, "batch").select("SalesId", "late")
    joins = plan(df)[0]
    assert "BroadcastHashJoin [batch" in joins and "SortMergeJoin [batch" not in joins

"""The gate and running total against a sequential fold, whole and cut into ranges."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesflow.operators import hot_keys
from salesflow.operators.running import (
    dedupe_running_total,
    key_state,
    latest_state,
    monotone_gate,
)

SALES = "SalesId string, ProductName string, EventProcessingTime timestamp, SalesAmount int, " \
    "offset bigint, partition int"
START = dt.datetime(2024, 1, 1)


def fold(rows):
    """What a per-record loop gives: rows in arrival order, (id, key, total) of those that pass."""
    last, total, out = {}, {}, []
    for sale_id, key, seconds, amount in rows:
        if key not in last or seconds > last[key]:
            last[key] = seconds
            total[key] = total.get(key, 0) + amount
            out.append((sale_id, key, total[key]))
    return sorted(out), {k: (last[k], total[k]) for k in last}


def frame(spark, rows, first=0):
    data = [
        (sale_id, key, START + dt.timedelta(seconds=seconds), amount, first + i // 2, i % 2)
        for i, (sale_id, key, seconds, amount) in enumerate(rows)
    ]
    random.Random(7).shuffle(data)
    return spark.createDataFrame(data, SALES)


ARRIVAL = ("offset", "partition")


def result(df):
    rows = df.select("SalesId", "ProductName", "TotalSalesAmount").collect()
    return sorted(map(tuple, rows))


def state_of(df):
    return {
        r.ProductName: ((r.last_time - START).total_seconds(), r.total) for r in df.collect()
    }


def random_rows(seed, count, drift):
    """Mostly one product; times wander, with ties, and follow arrival if ``drift`` is large."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        key = "hot" if rng.random() < 0.6 else rng.choice("abcdef")
        rows.append((str(i), key, int(i * drift) + rng.randrange(200), rng.randrange(-50, 100)))
    return rows


@pytest.mark.parametrize("drift", [0, 0.3, 300])
@pytest.mark.parametrize("rows_per_range", [None, 1, 13, 150, 10**9])
def test_equals_fold(spark, drift, rows_per_range):
    rows = random_rows(3, 400, drift)
    expected, expected_state = fold(rows)
    df = frame(spark, rows)
    options = dict(arrival=ARRIVAL, rows_per_range=rows_per_range)
    totals = dedupe_running_total(df, **options)
    assert result(totals) == expected
    passed = monotone_gate(df, **options)
    assert passed.columns == df.columns
    assert sorted(r.SalesId for r in passed.collect()) == sorted(r[0] for r in expected)
    assert state_of(key_state(df, **options)) == expected_state
    assert state_of(latest_state(totals)) == expected_state


@pytest.mark.parametrize("bound", [0, 10**9])
def test_both_joins(spark, bound, monkeypatch):
    """The per-range tables give the same rows broadcast and shuffled."""
    monkeypatch.setattr(hot_keys, "BROADCAST_ROWS", bound)
    rows = random_rows(5, 300, 0.3)
    totals = dedupe_running_total(frame(spark, rows), arrival=ARRIVAL, rows_per_range=20)
    assert result(totals) == fold(rows)[0]


@pytest.mark.parametrize("rows_per_range", [None, 5])
@pytest.mark.parametrize("cut,state_rows", [(1, None), (37, 7), (200, None), (200, 10**9)])
def test_continues_from_state(spark, rows_per_range, cut, state_rows):
    rows = random_rows(11, 240, 0.3)
    expected, expected_state = fold(rows)
    options = dict(arrival=ARRIVAL, rows_per_range=rows_per_range)
    first = dedupe_running_total(frame(spark, rows[:cut]), **options)
    state = latest_state(first)
    later = frame(spark, rows[cut:], cut)
    rest = dedupe_running_total(later, state=state, state_rows=state_rows, **options)
    assert sorted(result(first) + result(rest)) == expected


@pytest.mark.parametrize("bound", [0, 64 << 20])
def test_very_many_hot_keys_are_all_split(spark, monkeypatch, bound):
    """12,000 hot keys, each cut by its own rows, with their table broadcast or shuffled."""
    monkeypatch.setattr(hot_keys, "BROADCAST_BYTES", bound)
    df = spark.range(120_000).selectExpr(
        "cast(id as string) as SalesId", "cast(id % 12000 as string) as ProductName",
        "timestamp_seconds(id * 7919 % 1000) as EventProcessingTime", "1 as SalesAmount", "id as arrival",
    )
    hot = hot_keys.find_hot_keys(df, "ProductName", ["arrival"], 4)
    assert hot.keys.count() == 12_000
    sizes = hot_keys.with_ranges(df, "ProductName", ["arrival"], hot).groupBy("ProductName", "_range").count()
    most, groups = sizes.agg(F.max("count"), F.count("*")).first()
    assert most <= 4 and 30_000 <= groups <= hot.range_rows
    split, whole = (dedupe_running_total(df, rows_per_range=n) for n in (4, None))
    assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.sampled_from("AB"), st.integers(0, 20), st.integers(-(2**20), 2**20)
        ),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([None, 1, 4]),
)
def test_any_arrival_order(spark, rows, rows_per_range):
    rows = [(str(i), *row) for i, row in enumerate(rows)]
    totals = dedupe_running_total(
        frame(spark, rows), arrival=ARRIVAL, rows_per_range=rows_per_range
    )
    assert result(totals) == fold(rows)[0]


@pytest.mark.parametrize("rows_per_range", [None, 1])
def test_ties_and_repeated_ids(spark, rows_per_range):
    rows = [("x", "A", 10.0, 1), ("y", "A", 10.0, 2), ("z", "A", 10.001, 4), ("x", "A", 11.0, 8)]
    totals = dedupe_running_total(
        frame(spark, rows), arrival=ARRIVAL, rows_per_range=rows_per_range
    )
    assert result(totals) == [("x", "A", 1), ("x", "A", 13), ("z", "A", 5)]


def test_overflow(spark):
    rows = [("a", "A", 1, 2147483647), ("b", "A", 2, 1)]
    df = frame(spark, rows)
    with pytest.raises(Exception, match="does not fit a 32-bit int: 2147483648"):
        dedupe_running_total(df, arrival=ARRIVAL).collect()
    wrapped = dedupe_running_total(df, arrival=ARRIVAL, overflow="wrap")
    assert result(wrapped) == [("a", "A", 2147483647), ("b", "A", -2147483648)]
    wide = dedupe_running_total(df, arrival=ARRIVAL, overflow="bigint")
    assert result(wide) == [("a", "A", 2147483647), ("b", "A", 2147483648)]
    with pytest.raises(ValueError):
        dedupe_running_total(df, arrival=ARRIVAL, overflow="ignore")


@pytest.mark.parametrize("rows_per_range", [None, 1])
@pytest.mark.parametrize(
    "column,role", [("ProductName", "key"), ("EventProcessingTime", "time"), ("offset", "arrival")]
)
def test_a_null_fails(spark, column, role, rows_per_range):
    df = frame(spark, [("a", "A", 1, 1), ("b", "A", 2, 1), ("c", "A", 3, 1)])
    broken = df.withColumn(column, F.when(F.col("SalesId") != "c", F.col(column)))
    totals = dedupe_running_total(broken, arrival=ARRIVAL, rows_per_range=rows_per_range)
    with pytest.raises(Exception, match=f"null {role} in column {column}"):
        totals.collect()


@pytest.mark.parametrize("rows_per_range", [None, 10])
def test_a_leading_arrival_column_with_many_ties(spark, rows_per_range):
    """Ranges cannot cut inside a tie, so there are fewer of them; the result stays the same."""
    rows = random_rows(23, 200, 0.3)
    in_order = rows[0::2] + rows[1::2]
    totals = dedupe_running_total(
        frame(spark, rows), arrival=("partition", "offset"), rows_per_range=rows_per_range
    )
    assert result(totals) == fold(in_order)[0]


def test_arrival_may_be_a_time_or_any_number(spark):
    rows = random_rows(17, 200, 0.3)
    df = frame(spark, rows).selectExpr(
        "*", "timestamp_micros(offset * 2 + partition) as arrived",
        "cast(timestamp_micros(offset * 2 + partition) as timestamp_ntz) as arrived_ntz",
        "cast(timestamp_micros(offset * 2 + partition) as string) as text",
        "1152921504606846976 + 40 * (offset * 2 + partition) as beyond_doubles",
    )
    for arrival in ("arrived", "arrived_ntz", "beyond_doubles"):
        totals = dedupe_running_total(df, arrival=arrival, rows_per_range=10)
        assert result(totals) == fold(rows)[0]
    with pytest.raises(TypeError, match="must be numeric or a time"):
        dedupe_running_total(df, arrival="text", rows_per_range=10)


@pytest.mark.parametrize("rows_per_range", [None, 10])
def test_other_columns_and_a_numeric_key(spark, rows_per_range):
    rows = random_rows(19, 150, 0.3)
    df = frame(spark, rows).selectExpr(
        "SalesId as id", "ascii(ProductName) as user", "EventProcessingTime as ts",
        "SalesAmount as n", "offset * 2 + partition as position",
    )
    totals = dedupe_running_total(
        df, key="user", time="ts", amount="n", arrival="position", total="sum_n",
        rows_per_range=rows_per_range,
    )
    assert totals.columns == [*df.columns, "sum_n"]
    expected = [(sale_id, ord(key[0]), total) for sale_id, key, total in fold(rows)[0]]
    found = totals.select("id", "user", "sum_n").collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_a_hot_key_is_spread(spark):
    """No (key, range) group of a hot key is much larger than asked for."""
    rows = [(str(i), "hot" if i % 3 else "cold", i, 1) for i in range(3000)]
    df = frame(spark, rows)
    hot = hot_keys.find_hot_keys(df, "ProductName", ARRIVAL, 1500)
    assert [r.ProductName for r in hot.keys.collect()] == ["hot"]
    hot = hot_keys.find_hot_keys(df, "ProductName", ARRIVAL, 100)
    ranged = hot_keys.with_ranges(df, "ProductName", ARRIVAL, hot)
    sizes = ranged.groupBy("ProductName", "_range").count().collect()
    assert max(r["count"] for r in sizes) < 300
    assert len(sizes) <= hot.range_rows

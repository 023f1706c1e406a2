"""Every registered query against its SQL, on all rows of the sf0.01 tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from salesflow.plans.catalog import QUERIES

SF = "/root/testdata/sf0.01"
TABLES = sorted(p.stem for p in Path(SF).glob("*.parquet"))


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


# DuckDB type of each Spark type that the results use.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    df = contract.queries()[name](spark, SF)
    expected = oracle.execute(contract.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in expected.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    wanted = normal(expected.fetchall(), list(types))
    assert normal([tuple(r) for r in df.collect()], df.columns) == wanted
    assert wanted


def test_entry(spark):
    assert contract.entry(spark).count() == 1000


def test_known_counts(spark):
    queries = contract.queries()
    assert queries["dedupe_running_total"](spark, SF).count() == 4330
    assert queries["dedupe_running_total_skewed"](spark, SF).count() == 45
    assert queries["event_time_totals"](spark, SF).count() == 9913
    late = queries["late_data_audit"](spark, SF).agg({"late_rows": "sum", "on_time_rows": "sum"})
    assert sorted(late.first()) == [1058, 10000 - 1058]
    reasons = queries["decode_quarantine"](spark, SF).groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in reasons} == {
        "corrupt": 155, "empty": 147, "good": 14555
    }

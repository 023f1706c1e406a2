"""The queries of the package that SQL can express, against that SQL on the sf0.01 tables."""

from pathlib import Path

import duckdb
import pytest

from salesflow.llm.oracle import ORACLE
from salesflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = con.execute(ORACLE[name])
    columns = sorted(d[0] for d in expected.description)
    wanted = expected.df()[columns].astype(object).where(lambda c: c.notna(), None)
    found = QUERIES[name](spark, SF).toPandas()
    assert sorted(found.columns) == columns
    found = found[columns].astype(object).where(lambda c: c.notna(), None)
    assert sorted(map(repr, found.values.tolist())) == sorted(map(repr, wanted.values.tolist()))
    assert len(wanted)

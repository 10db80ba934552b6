"""The registered queries against DuckDB where SQL can say it."""

import os

import duckdb
import pytest

from evigraph.llm import queries as q

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_same_rows_as_sql(name, spark):
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    got, want = q.queries()[name](spark, SF), con.sql(q.oracle_sql()[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in got.collect()) == sorted(repr([r[i] for i in at]) for r in want.fetchall())


def test_ten_operators():
    names = list(q.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]

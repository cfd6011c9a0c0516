"""The operators' queries against their SQL, and that every one is registered."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from firmfold.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(llm, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got, want = QUERIES[name](llm, SF), con.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    place = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r)) for r in got.select(columns).collect()) == sorted(
        repr(tuple(r[k] for k in place)) for r in want.fetchall())


def test_all_are_registered():
    names = set(entry_points.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}

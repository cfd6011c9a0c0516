"""Every registered query against its SQL, on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from firmfold.suite.queries import QUERIES
from firmfold.suite.staging import TABLES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = entry_points.queries()[name](spark, SF)
    want = duck.sql(entry_points.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert _sorted(got.columns, got.collect()) == _sorted(want.columns, want.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("table, column", [("pages", "html"), ("documents", "text")])
def test_tables_hold_no_numeric_entities(duck, table, column):
    """The SQL for visible text decodes named entities only."""
    found = f"SELECT count(*) FROM {table} WHERE regexp_matches({column}, '&#(x[0-9a-fA-F]+|[0-9]+);')"
    assert duck.sql(found).fetchall() == [(0,)]


def test_master_table_is_derived_per_call(spark, monkeypatch):
    """A later call sees tables that have changed at the same path; no call is a read of an earlier one's work."""
    from firmfold.schemas import LEAD
    from firmfold.suite import frames

    made = iter(["first", "second"])
    monkeypatch.setattr(frames, "_lead", lambda spark, sf: spark.createDataFrame([], LEAD).union(
        spark.createDataFrame([(next(made),)], "lead_id string").selectExpr(
            *[n if n == "lead_id" else f"cast(null as {t}) as {n}" for n, t in (c.split() for c in LEAD.split(","))])))
    got = [frames.lead(spark, "/no/such/tables").collect() for _ in range(2)]
    assert [[r.lead_id for r in rows] for rows in got] == [["first"], ["second"]]

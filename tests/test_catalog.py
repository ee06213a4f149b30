"""Every registered query with SQL gives what DuckDB gives on the smallest tables."""

import os

import duckdb
import pytest

from millrace.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA).toArrow()
    duck.register("got", got)
    duck.sql(f"CREATE OR REPLACE TEMP TABLE want AS {catalog.SQL[name]}")
    columns = sorted(got.column_names)
    assert columns == sorted(r[0] for r in duck.sql("DESCRIBE want").fetchall())
    pick = ", ".join(f'CAST("{x}" AS VARCHAR)' for x in columns)
    for a, b in (("got", "want"), ("want", "got")):
        assert duck.sql(f"SELECT {pick} FROM {a} EXCEPT ALL SELECT {pick} FROM {b}").fetchall() == []


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0

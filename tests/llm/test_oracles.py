from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tallysheet.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(spark, name):
    found = entry.queries()[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    expected = con.sql(entry.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rows = con.sql(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, rows)) == sorted(str(tuple(r)) for r in found.select(columns).collect())

"""Every registered query against its DuckDB counterpart, on the smallest supplied tables."""

import os
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from tallysheet import queries as core  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
# The queries of the llm subpackage have their own tests.
QUERIES, ORACLES = core.queries(), core.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def text(v):
    if v is None or v is pd.NaT or v != v:
        return ""
    return repr(float(v)) if isinstance(v, float) else str(v)


def normal(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(text(v) for v in r) for r in df[columns].itertuples(index=False, name=None))


def test_every_query_has_a_counterpart():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_duckdb(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    expected = duck.execute(ORACLES[name]).df()
    assert len(expected) > 0
    assert normal(got) == normal(expected)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["year_month", "account_code", "brand_name"]
    assert not df.isEmpty()

"""Every registered query against its SQL on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lotflow.bindings.oracles import ORACLES
from lotflow.bindings.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    expected = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    want = sorted(expected.select(*[f'"{c}"' for c in columns]).fetchall(), key=str)
    assert got == want
    assert got

"""Every query of the subpackage that SQL can express, against DuckDB on whole tables."""

from __future__ import annotations

import duckdb
import pytest

from lotflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings", "pages"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(map(str, (tuple(r) for r in df.select(columns).collect())))
    found = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert got == sorted(map(str, found)) and got


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

"""Queries with DuckDB SQL agree with it, over whole tables."""

import pytest

from redeemflow.llm.queries import ORACLE, QUERIES
from tools.oracle_check import duck, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    cols = sorted(rel.columns)
    assert sorted(df.columns) == cols
    got = rows_of([r.asDict() for r in df.collect()], cols)
    assert got and got == rows_of([dict(zip(rel.columns, r)) for r in rel.fetchall()], cols)

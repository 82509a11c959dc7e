"""Every query with an oracle agrees with DuckDB on the smallest tables
(row count, column names, order-insensitive rounded values)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import duck, rows_of

from conftest import SF_SMALL

from redeemflow.plans.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [r.asDict() for r in sdf.collect()]
    rel = con.sql(ORACLE[name])
    dcols = rel.columns
    drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    cols = sorted(dcols)
    assert rows_of(srows, cols) == rows_of(drows, cols)


def test_every_query_has_an_oracle_or_is_a_model_fit():
    assert set(QUERIES) - set(ORACLE) == {"ml_score", "ml_importance", "ml_score_a",
                                              "ml_importance_a", "ml_validate", "ml_rounds"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:4] == ["user_id", "coupon_id", "distance", "date_received"]
    assert df.columns[-1] == "label"

"""Differential check of every registered query against its DuckDB SQL."""

import pytest

from helpers import SF_SMALL

import __spark_entry__ as entry
from tidemart.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def duck():
    from tools.compare_oracle import duck_conn

    return duck_conn(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    from tools.compare_oracle import rows_of

    oracles = entry.oracle_sql()
    assert name in oracles, f"{name} has no oracle SQL"
    ours = entry.queries()[name](spark, SF_SMALL).toPandas()
    theirs = duck.sql(oracles[name]).df()
    s_cols, s_rows = rows_of(ours)
    d_cols, d_rows = rows_of(theirs)
    assert s_cols == d_cols
    assert len(ours) == len(theirs)
    assert s_rows == d_rows

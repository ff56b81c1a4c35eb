"""Every core query against its SQL over the smallest tables."""

import pytest

from dialoom.plans import registry
from tests.oracle import differences

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name):
    missing, extra, rows = differences(spark, sf, QUERIES[name], SQL[name])
    assert not missing and not extra and rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.columns and df.count() > 0

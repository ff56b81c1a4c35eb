"""The queries for training text against their SQL, and their fixed columns."""

import pytest

from dialoom.llm import queries
from tests.oracle import differences

COLUMNS = {
    "p1_found": [("dialogue_id", "string"), ("defect", "string")],
    "p2_found": [("dialogue_id", "string"), ("turn_id", "int"), ("fact_pos", "int")],
    "p3_found": [("dialogue_id", "string"), ("block_id", "int"), ("defect", "string")],
    "p5_found": [("field", "string"), ("term", "string"), ("mark", "string")],
    "p6_found": [("dialogue_id", "string"), ("turn_id", "int"), ("fact_pos", "int"), ("code", "string")],
    "p8_found": [("doc_id", "bigint"), ("item_id", "bigint")],
    "p9_found": [("doc_id", "bigint"), ("seg", "int"), ("lang", "string")],
}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    missing, extra, _ = differences(spark, sf, queries.QUERIES[name], queries.ORACLE_SQL[name])
    assert not missing and not extra


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_runs(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).count() > 0


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    assert df.dtypes == COLUMNS[name]
    assert df.count() == df.distinct().count()

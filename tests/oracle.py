"""Compares a query with its SQL in DuckDB."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def differences(spark, sf, query, sql):
    """Rows that only one side has, and how many rows Spark has."""
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = Counter(repr([_norm(r[names.index(c)]) for c in sorted(names)]) for r in result.fetchall())
    df = query(spark, sf)
    assert sorted(df.columns) == sorted(names)
    got = Counter(repr([_norm(r[c]) for c in sorted(names)]) for r in df.collect())
    return list((want - got).items())[:3], list((got - want).items())[:3], sum(got.values())

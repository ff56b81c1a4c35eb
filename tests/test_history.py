import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dialoom.operators.history import P4_FOUND_SQL, p4_found, state_snapshots, version_history
from tests.oracle import differences

DDL = "k string, o int, at timestamp, items array<struct<item:string,version:string>>, key string, part string"
T = datetime(2024, 1, 1)


def brute(rows):
    last = {}
    for k, o, at, items in rows:
        if k is not None and o is not None:
            old = last.get((k, o))
            if old is None or (at, items is not None) >= (old[0], old[1] is not None):
                last[k, o] = (at, items)
    out = set()
    for k in {k for k, _ in last}:
        shots = sorted((o, dict(i)) for (kk, o), (_, i) in last.items() if kk == k and i is not None)
        for n, (o, items) in enumerate(shots):
            for item, version in items.items():
                if n and shots[n - 1][1].get(item) == version:
                    continue
                m = n
                while m + 1 < len(shots) and shots[m + 1][1].get(item) == version:
                    m += 1
                out.add((k, item, version, o, shots[m + 1][0] if m + 1 < len(shots) else -1))
    return out


@pytest.mark.parametrize("chunk", [1, 3, 256])
def test_history_equals_brute_force(spark, chunk):
    rng = random.Random(7)
    rows = []
    for _ in range(400):
        items = None if rng.random() < 0.1 else [(i, rng.choice("xyz")) for i in "abc" if rng.random() < 0.7]
        rows.append((rng.choice(["k1", "k2", None]), rng.choice([*range(25), None]), T + timedelta(seconds=rng.randrange(10**6)), items))
    rows += rows[:50]  # repeated rows
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], DDL)
    got = version_history(df, "k", "o", "items", "at", chunk).select("k", "item", "version", "valid_from", "valid_to").collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == brute(rows)


def test_empty_history(spark):
    assert version_history(spark.createDataFrame([], DDL), "k", "o", "items", "at").count() == 0


def test_meaningless_differences_are_none(spark):
    item = "struct<normalized_name:string,status:string,attributes:map<string,string>>"
    ddl = f"dialogue_id string, turn_id int, processed_at timestamp, patient_state_after_turn struct<chief_complaint:string,problems:array<{item}>>"
    rows = [
        ("d", 0, T, (" 腹痛", [("腹痛", "present", {"time": "夜间；午后", "x": " "})])),
        ("d", 1, T, ("腹痛　", [("腹痛", "present", {"time": "午后；夜间；"})])),
        ("d", 2, T, None),
        ("d", 3, T, ("", [("腹痛", "absent", None)])),
        ("d", 4, T, (None, None)),
    ]
    df = version_history(state_snapshots(spark.createDataFrame(rows, ddl)), "dialogue_id", "turn_id", "items", "processed_at")
    got = sorted(map(tuple, df.select("item", "valid_from", "valid_to").collect()))
    assert got == [("chief_complaint", 0, 3), ("腹痛", 0, 3), ("腹痛", 3, 4)]


def test_p4_equals_sql(spark, sf):
    missing, extra, rows = differences(spark, sf, p4_found, P4_FOUND_SQL)
    assert not missing and not extra and rows


def test_p4_columns(spark, sf):
    assert p4_found(spark, sf).dtypes == [("dialogue_id", "string"), ("item", "string"), ("valid_from_turn", "int"), ("valid_to_turn", "int")]
    assert p4_found(spark, sf).where(F.col("valid_to_turn").isNull()).isEmpty()

"""States of questions: how they are joined, read and written."""

import re

import pytest
from pyspark.sql import functions as F

from dialoom.operators import answers
from dialoom.operators.state import STATE_DDL

ROWS = "dialogue_id string, source_dialogue_id string, block_id int, patient_turn_ids array<int>, patient_block array<string>, utterance string"


@pytest.mark.parametrize("name", ["answerable_targets", "gated_decisions", "answerability", "known_targets", "resolved_targets"])
def test_states_reach_no_driver(spark, sf, name):
    df = answers.QUERIES[name](spark, sf)
    plan, tree = df._jdf.queryExecution().executedPlan().toString(), df._jdf.queryExecution().optimizedPlan().toString()
    assert "Broadcast" not in plan and "evidence:" not in plan
    assert len(re.findall(r"from_json\(", tree)) <= 2


def test_items_come_back_as_they_were(spark):
    item = '{"name":"腹\\"痛\\\\ \\u0001\\n","normalized_name":null,"aliases":["a","A b",null],"type":"symptom","status":null,"subject":"","attributes":{"程度":"重","性质":""}}'
    states = spark.createDataFrame([(f'{{"problems":[{item},null],"lifestyle":[{item}]}}',), ("{}",), (None,)], "j string").select(F.from_json("j", STATE_DDL).alias("s"))
    for seen, back in states.select(answers.seen_items(F.col("s")), answers.read_items(answers.written_items(F.col("s")))).collect():
        assert seen == back
    first = states.select(answers.seen_items(F.col("s"))).first()[0]
    assert [i["names"] for i in first[:1]] == [['a', 'ab', '腹"痛\\\x01']] and first[0]["known"] == ["severity"] and len(first) == 3


def test_the_next_block_may_be_of_another_dialogue(spark):
    rows = spark.createDataFrame([("s", "d1", 0, [0], ["x"], "?"), ("s", "d2", 1, [3, 1], ["y"], "?"), ("s", "d3", 2, None, None, "?")], ROWS)
    one = lambda name: f'{{"problems":[{{"name":"{name}","type":"symptom"}}]}}'
    turns = spark.createDataFrame([("d1", 0, one("old"), 1), ("d1", 0, one("a"), 2), ("d2", 3, one("b"), 1), ("d2", 1, one("c"), 1)], "dialogue_id string, turn_id int, j string, t int")
    turns = turns.select("dialogue_id", "turn_id", F.from_json("j", STATE_DDL).alias("patient_state_after_turn"), F.col("t").cast("timestamp").alias("processed_at"))
    got = answers.asked_states(rows, turns, "patient_block").orderBy("block_id").select("before.name", "after.name", "answer").collect()
    assert [tuple(r) for r in got] == [(["a"], ["b"], ["y"]), (["b"], [], None), ([], [], None)]

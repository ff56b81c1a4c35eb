import json

import pytest
from pyspark.sql import functions as F

from dialoom.operators import projection as P
from dialoom.operators.state import STATE_DDL, StateFold
from dialoom.session import bounded_rows, checkpoint_dir, cut


def state(*facts):
    fold = StateFold("d")
    fold.take_turn([{"normalized_name": f["name"], "type": "symptom", "status": "present", "subject": "patient", "evidence": f["name"], "standard_code": "C", "terminology": "T", "attribute": {}} | f for f in facts], 0)
    return fold.as_dict()


def test_views_hide_what_they_must(spark):
    df = spark.createDataFrame([(state({"name": "腹痛", "attribute": {"severity": "重"}}, {"name": "发热", "status": "absent", "standard_code": "D"}),), (None,)], f"state {STATE_DDL}").where("state is not null")
    row = df.select(F.to_json(P.prompt_state(F.col("state"))).alias("p"), F.to_json(P.question_state(F.col("state"))).alias("q"), F.to_json("state").alias("s")).first()
    prompt, question = json.loads(row["p"]), json.loads(row["q"])
    assert prompt["problems"] == [{"name": "腹痛", "normalized_name": "腹痛", "type": "symptom", "status": "present", "subject": "patient", "attributes": {"severity": "重"}}]
    assert "medications" not in prompt and "uncertain_findings" not in prompt
    assert question["negative_findings"] == [{"name": "发热", "type": "symptom", "status": "absent", "subject": "patient", "attributes": {}}]
    hidden = spark.createDataFrame([(row["p"],), (row["q"],), (row["s"],)], "j string").select(P.hidden_keys(F.col("j"))).collect()
    assert [bool(h[0]) for h in hidden] == [False, False, True]


@pytest.mark.parametrize(("before", "after", "want"), [([("a", "x")], [("a", "x")], []), ([("a", "x")], [("b", "x")], ["facts[0].n"]), ([("a", "x"), ("c", None)], [("a", "x"), ("c", "y")], ["facts[1].t"]), ([("a", "x")], [], ["number of facts"]), ([], [], [])])
def test_changes(spark, before, after, want):
    df = spark.createDataFrame([(before, after)], "b array<struct<n:string,t:string>>, a array<struct<n:string,t:string>>")
    assert df.select(P.changes(F.col("b"), F.col("a"), ["n", "t"])).first()[0] == want


def test_positional_join(spark):
    left = spark.createDataFrame([(n, f"l{n}") for n in range(500, 0, -1)], "o int, v string").repartition(7)
    right = spark.createDataFrame([(n * 3, f"r{n}") for n in range(1, 501)], "p int, w string").repartition(3)
    rows = P.positional_join(left, right, ["o"], ["p"]).collect()
    assert len(rows) == 500 and all(r["left"]["v"][1:] == r["right"]["w"][1:] for r in rows)
    with pytest.raises(ValueError, match="500 rows against 499"):
        P.positional_join(left, right.where("p > 3"), ["o"], ["p"])


@pytest.mark.parametrize(
    ("doctor", "asked", "problems", "want"),
    [
        (["腹痛多久了？"], [], [("腹痛", "symptom", "present")], ("腹痛多久了？", None)),
        (["您好。腹痛还有吗？腹痛多久了？"], [], [("腹痛", "symptom", "present")], ("腹痛多久了？", None)),
        (["腹痛多久了？"], [("symptom", "腹痛", "duration")], [("腹痛", "symptom", "present")], (None, "TARGET_ALREADY_ASKED")),
        (["腹痛还有吗？"], [], [("腹痛", "symptom", "present")], (None, "TARGET_ALREADY_KNOWN")),
        (["头晕吗？"], [], [("腹痛", "symptom", "present")], (None, "TARGET_NOT_RESOLVED")),
        (["腹痛多久了，在哪里？"], [], [("腹痛", "symptom", "present")], (None, "COMPOUND_QUESTION")),
        (["多休息。"], [], [], (None, "NO_SAFE_DOCTOR_QUESTION")),
        (None, [], None, (None, "NO_SAFE_DOCTOR_QUESTION")),
    ],
)
def test_the_first_fit_question_is_taken(spark, doctor, asked, problems, want):
    ddl = "original_doctor_block array<string>, asked array<struct<type:string,name:string,attribute:string>>, patient_state struct<problems:array<struct<name:string,type:string,status:string>>>"
    row = P.selected_question(P.question_candidates(spark.createDataFrame([(doctor, asked, (problems,))], ddl))).first()
    assert (row["selected"] and row["selected"]["source_text"], row["reason"]) == want


def test_session_helpers(spark):
    df = spark.range(5)
    assert len(bounded_rows(df, 5)) == 5 and bounded_rows(df, 4) is None
    assert cut(df).count() == 5 and checkpoint_dir(spark)

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from dialoom.operators.facts import distinct_facts
from dialoom.operators.state import ALL_BUCKETS, StateFold, fold_states, turn_facts
from dialoom.session import table
from dialoom.streaming.clients import RuleModel, with_retries
from dialoom.streaming.sessions import run_to_table, session_stream, step_session, stream_keyed_state


def fact(name, type="symptom", status="present", subject="patient", evidence=None, code=None, **attribute):
    return {"name": name, "normalized_name": name, "type": type, "status": status, "subject": subject, "evidence": evidence or name, "standard_code": code, "terminology": code and "T", "attribute": attribute}


def fold(*turns, questions=()):
    state = StateFold("d")
    for n, facts in enumerate(turns):
        state.take_turn(facts, n, dict(questions).get(n))
    return state.as_dict()


def test_status_flips_move_an_entity():
    s = fold([fact("腹痛")], [fact("腹痛", status="absent")])
    assert not s["problems"] and [i["name"] for i in s["negative_findings"]] == ["腹痛"]
    assert s["chief_complaint"] == "腹痛"  # never cleared


def test_repeated_facts_merge():
    s = fold([fact("腹痛", time_="x", severity="轻")], [fact("腹痛", severity="轻；重", evidence="还是疼")])
    (item,) = s["problems"]
    assert item["attributes"]["severity"] == "轻；重" and item["first_turn_id"] == 0 and item["last_turn_id"] == 1
    assert [e["text"] for e in item["evidence"]] == ["腹痛", "还是疼"]


def test_codes_settle_identity():
    s = fold([fact("腹痛", code="A")], [fact("肚子疼", code="A")], [fact("腹痛")])
    assert [i["standard_code"] for i in s["problems"]] == ["A", None]
    assert s["problems"][0]["aliases"] == ["肚子疼"]


def test_attributes_find_their_one_target():
    s = fold([fact("右下腹痛"), fact("头晕")], [fact("病程", type="attribute", target="腹痛", value="三天")], [fact("程度", type="attribute", target="恶心", value="重")])
    assert s["problems"][0]["attributes"] == {"course_duration": "三天"} and s["problems"][0]["time"] == "三天"
    assert [i["name"] for i in s["other_facts"]] == ["程度"]


def test_a_description_continues_the_asked_problem():
    s = fold([fact("腹痛")], [fact("刺痛", character="针扎")], questions=[(1, "疼了多久？")])
    assert [i["name"] for i in s["problems"]] == ["腹痛"]
    assert len(fold([fact("腹痛")], [fact("刺痛", character="针扎")])["problems"]) == 2


def test_types_have_their_buckets():
    s = fold([fact("阿司匹林", "medicine"), fact("胃镜", "examination"), fact("吸烟", "lifestyle"), fact("手术史", "history"), fact("其他", "other"), fact("  ")])
    assert [len(s[b]) for b in ("medications", "examinations", "lifestyle", "histories", "other_facts", "problems")] == [1, 1, 1, 1, 1, 0]


names = st.sampled_from(["腹痛", "右下腹痛", "头晕", "", "恶心"])
facts = st.builds(lambda n, t, s, a: fact(n, t, s, **a), names, st.sampled_from(["symptom", "disease", "medicine", "attribute"]), st.sampled_from(["present", "absent"]), st.dictionaries(st.sampled_from(["target", "severity", "value"]), names, max_size=2))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(facts, max_size=3), max_size=6))
def test_a_state_reloaded_goes_on_alike(turns):
    whole = fold(*turns)
    state = None
    for n, own in enumerate(turns):
        part = StateFold("d", json.loads(json.dumps(state)) if state else None)
        part.take_turn(own, n)
        state = part.as_dict()
    assert (state or fold()) == whole
    entities = [(i["type"], i["subject"], i["normalized_name"]) for b in ("problems", "negative_findings") for i in whole[b] if i["type"] != "attribute"]
    assert len(entities) == len(set(entities))


def test_batch_equals_stream(spark, sf):
    batch = fold_states(turn_facts(distinct_facts(table(spark, sf, "facts"))), last_only=True)
    want = {r["dialogue_id"]: [len(r["state"][b]) for b in ALL_BUCKETS] for r in batch.collect()}
    got = {r["dialogue_id"]: [r[b] for b in ALL_BUCKETS] for r in stream_keyed_state(spark, sf).collect()}
    assert got == want and want


MODEL = RuleModel({"腹痛": "symptom", "发热": "symptom"})


def test_sessions_ask_and_end():
    state, answers = None, []
    for text in ("我腹痛", "三天", "很重", "两次", "还有"):
        state, out = step_session(state, {"session_id": "s", "patient_utterance": text}, MODEL)
        answers.append((out["ok"], out["action"]))
    assert answers == [(True, "ask")] * 3 + [(True, "end"), (False, None)]
    state, out = step_session(state, {"session_id": "s", "patient_utterance": "没有发热", "reset": True}, MODEL)
    assert out["ok"] and out["turn_count"] == 1 and not state["medical_state"]["problems"]
    assert step_session(state, {"session_id": "s", "patient_utterance": " ", "reset": True}, MODEL)[0] is None


def test_a_failed_request_leaves_no_trace():
    class Broken(RuleModel):
        def ask(self, state, asked):
            raise RuntimeError("no answer")

    state, _ = step_session(None, {"session_id": "s", "patient_utterance": "腹痛"}, MODEL)
    again, out = step_session(state, {"session_id": "s", "patient_utterance": "发热"}, Broken(MODEL.names))
    assert again == state and not out["ok"] and out["error"] == "no answer"


def test_session_stream(spark, tmp_path):
    rows = [("a", 2, "三天", False), ("a", 1, "我腹痛", False), ("b", 1, "没有发热", False), (None, 1, "腹痛", False), ("a", 3, "", True)]
    spark.createDataFrame(rows, "session_id string, seq long, patient_utterance string, reset boolean").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("session_id string, seq long, patient_utterance string, reset boolean").json(str(tmp_path / "in"))
    out = {(r["session_id"], r["seq"]): (r["ok"], r["action"], r["turn_count"]) for r in run_to_table(session_stream(stream, MODEL), str(tmp_path / "out")).collect()}
    assert out == {("a", 1): (True, "ask", 1), ("a", 2): (True, "ask", 2), ("a", 3): (False, None, 0), ("b", 1): (True, "end", 1), ("default", 1): (True, "ask", 1)}


def test_retries():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    assert with_retries(flaky, 3, 0.5, waits.append)() == "ok" and waits == [0.5, 1.0]

"""Rules that the tables alone don't reach, empty tables, nulls, repeated rows and clashing columns."""

import hashlib
import json
import random
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dialoom.operators import answers, dialogue, facts, interview, ledger, metrics, projection, prompts, splits, terms
from dialoom.operators.state import ITEM_DDL, STATE_DDL
from dialoom.plans import pipelines
from dialoom.sources import io
from dialoom.streaming import clients, sessions

MESSAGES = "source_pos long, dialogue_id string, turn_id int, role string, content string, received_at timestamp"


def messages(spark, *rows):
    return dialogue.ordered_messages(spark.createDataFrame([(0, "d", n, role, text, None) for n, (role, text) in enumerate(rows)], MESSAGES))


def test_blocks_group_runs(spark):
    m = messages(spark, ("system", "s"), ("assistant", "a0"), ("user", "u1"), ("患者", "u2"), ("doctor", "a1"), ("assistant", "a2"), ("system", "x"), ("assistant", "lost"), ("user", "u3"))
    got = dialogue.dialogue_blocks_of(m).orderBy("block_id").collect()
    assert [(r["patient_block"], r["doctor_block"], r["next_patient_block"], r["is_terminal"]) for r in got] == [(["u1", "u2"], ["a1", "a2"], ["u3"], False), (["u3"], [], [], True)]


def test_contexts_keep_their_budgets(spark):
    m = messages(spark, ("user", "a" * 50), ("assistant", "b" * 5), ("system", "no"), ("user", ""), ("assistant", "c" * 9), ("user", "now"))
    last = dialogue.recent_context(m, 2, 20).where("turn_id = 5").first()["context"]
    assert [c["content"] for c in last] == ["c" * 9]
    assert [c["content"] for c in dialogue.recent_context(m, 3, 1000).where("turn_id = 5").first()["context"]] == ["a" * 50, "b" * 5, "c" * 9]
    cut = dialogue.truncated_context(m, 4, 16).where("turn_id = 5").first()["context"]
    assert [c["content"] for c in cut] == ["b" * 5, "no", "c" * 9]


def test_sessions_split_after_a_closed_exchange(spark):
    m = messages(spark, ("user", "腹痛"), ("assistant", "好的"), ("user", "谢谢医生"), ("assistant", "不客气"), ("user", "最近又头晕"), ("assistant", "多久"), ("user", "谢谢"), ("assistant", "再见"), ("user", "顺便问腹痛"))
    f = spark.createDataFrame([("d", 0, "腹痛", "腹痛", "symptom", "present", None), ("d", 4, "头晕", "头晕", "symptom", "present", None), ("d", 8, "腹痛", "腹痛", "symptom", "present", None)], "dialogue_id string, turn_id int, name string, normalized_name string, type string, status string, target string")
    got = dialogue.split_sessions(dialogue.dialogue_blocks_of(m), f).orderBy("block_id").collect()
    assert [(r["session_index"], r["session_block_id"], r["reason"]) for r in got] == [(0, 0, None), (0, 1, None), (1, 0, "independent_new_complaint"), (1, 1, None), (2, 0, "explicit_new_topic")]


def test_running_totals_over_ranges(spark):
    rng = random.Random(3)
    rows = [(n * 7, rng.randrange(5)) for n in range(300)]
    got = {r["o"]: r["before"] for r in dialogue.running_total(spark.createDataFrame(rows, "o long, v long"), "o", "v", share=100).collect()}
    total = 0
    for o, v in rows:
        assert got[o] == total
        total += v


FACT = "dialogue_id string, turn_id int, fact_pos int, name string, normalized_name string, type string, status string, subject string, evidence string, standard_code string, terminology string, attribute map<string,string>, patient_utterance string"


@pytest.mark.parametrize(
    ("change", "errors"),
    [
        ({}, []), ({"type": "body_part"}, ["type invalid"]), ({"status": None}, ["status invalid"]), ({"subject": "x"}, ["subject invalid"]), ({"attribute": {"name": "x"}}, ["attribute repeats core fields"]),
        ({"type": "attribute", "attribute": {"target": "未知", "duration": "1"}}, ["attribute target unknown"]), ({"type": "attribute", "attribute": {"target": "腹痛", "duration": ""}}, ["attribute has no value"]),
        ({"name": " "}, ["name empty"]), ({"normalized_name": None}, ["normalized name empty"]), ({"evidence": ""}, ["evidence empty"]), ({"evidence": "腹很痛"}, ["evidence not in utterance"]), ({"patient_utterance": None}, ["evidence not in utterance"]),
        ({"name": "用药", "type": "medicine", "status": "absent"}, ["generic negative"]), ({"name": "阿司匹林", "type": "medicine", "status": "absent"}, []), ({"standard_code": "X"}, ["code and terminology not paired"]), ({"attribute": None}, []),
    ],
)
def test_fact_errors(spark, change, errors):
    row = {"dialogue_id": "d", "turn_id": 0, "fact_pos": 0, "name": "腹痛", "normalized_name": "腹痛", "type": "symptom", "status": "present", "subject": "patient", "evidence": "腹痛", "standard_code": None, "terminology": None, "attribute": {"a": "b"}, "patient_utterance": "我腹痛"} | change
    df = spark.createDataFrame([tuple(row.values())], FACT)
    assert df.select(facts.fact_errors()).first()[0] == errors


def test_attributes_are_cleaned(spark):
    df = spark.createDataFrame([({"degree": "重", "severity": "轻；重", "value": "阴性", "name": "x", "count": " "}, "examination"), (None, "symptom")], "attribute map<string,string>, type string")
    got = [r[0] for r in df.select(facts.clean_attributes(F.col("attribute"), F.col("type"))).collect()]
    assert got == [{"severity": "重；轻", "result": "阴性"}, {}]


TERMS = "id long, terminology string, semantic_type string, code string, preferred_name string, alias string, normalized_key string, source string"


def test_lookups(spark):
    t = spark.createDataFrame([(3, "L", "symptom", "S1", "腹痛", "肚子疼", "", None), (1, "L", "symptom", "S1", "腹痛", "腹痛", "", None), (2, "L", "symptom", "S2", "腹胀", "肚子疼", "", None), (4, "LOINC", "examination", "E1", "胃镜检查", "胃镜", "", None), (5, "L", "symptom", "S3", "恶心", "， ", "", None)], TERMS)
    f = spark.createDataFrame([("symptom", "肚子疼", "腹痛"), ("symptom", "肚子疼", None), ("examination", "检查", "胃 镜"), ("examination", "肠镜", None), (None, None, None)], "type string, name string, normalized_name string")
    got = {(r["type"], r["name"], r["normalized_name"]): r["m"] and r["m"]["code"] for r in terms.match_facts(f, t).collect()}
    assert got == {("symptom", "肚子疼", "腹痛"): "S1", ("symptom", "肚子疼", None): None, ("examination", "检查", "胃 镜"): "28014-9", ("examination", "肠镜", None): "18746-8", (None, None, None): None}


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next(row, x, b)
    return row[-1]


def _next(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(out[-1], row[j + 1]))
    return out


def test_subsequences_side_by_side_equal_the_table():
    rng = random.Random(8)
    pairs = [("".join(rng.choice("上下左右腹痛") for _ in range(rng.randrange(9))), "".join(rng.choice("上下左右腹痛") for _ in range(rng.randrange(7)))) for _ in range(500)]
    assert terms.common_subsequences(*map(list, zip(*pairs, strict=True))).tolist() == [_lcs(a, b) for a, b in pairs]
    assert terms.common_subsequences([], []).tolist() == []


def test_fuzzy_candidates_lose_none(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("上下左右腹痛胀满刺") for _ in range(rng.randrange(1, 7)))
    aliases, queries = [word() for _ in range(60)], sorted({word() for _ in range(40)})
    t = spark.createDataFrame([(n, "L", "symptom", f"C{n}", a, a, "", None) for n, a in enumerate(aliases)], TERMS)
    got = terms.fuzzy_candidates(spark.createDataFrame([("symptom", q) for q in queries], "type string, query string"), t, k=100)
    want = {(q, f"C{n}", round(200 * _lcs(q, a) / (len(q) + len(a)), 6)) for q in queries for n, a in enumerate(aliases) if 200 * _lcs(q, a) >= 75 * (len(q) + len(a))}
    assert {(r["query"], r["code"], r["score"]) for r in got.collect()} == want


@pytest.mark.parametrize(
    ("target", "before", "after", "answer", "question", "method"),
    [
        (("腹痛", "symptom", None), [("腹痛", "symptom", "present")], [], ["有"], "腹痛吗？", None),
        (("腹痛", "symptom", None), [], [("腹痛", "symptom", "present")], ["有"], "腹痛吗？", "exact_state_match"),
        (("伴随症状", "symptom", None), [], [("头晕", "symptom", "present")], ["头晕"], "还有吗？", "generic_type_delta"),
        (("下腹痛", "symptom", None), [], [("腹痛感", "symptom", "present")], ["嗯"], "下腹痛？", "lexical_state_delta"),
        (("腹痛", "symptom", None), [], [], ["有点腹痛"], "哪里？", "lexical_answer_match"),
        (("发热", "symptom", None), [], [], ["没有。"], "有没有发热？", "explicit_short_answer"),
        (("发热", "symptom", None), [], [], ["不清楚"], "有没有发热？", None),
        (("腹痛", "symptom", "duration"), [("腹痛", "symptom", "present")], [], ["三天了"], "腹痛多久了？", "short_attribute_answer"),
        (("腹痛", "symptom", "duration"), [], [], ["三天了"], "腹痛几次？", None),
    ],
)
def test_answers_are_found(spark, target, before, after, answer, question, method):
    item = "array<struct<name:string,type:string,status:string>>"
    df = spark.createDataFrame([(target, before, after, answer, question)], f"t struct<name:string,type:string,attribute:string>, b {item}, a {item}, answer array<string>, q string")
    full = lambda c: F.transform(c, lambda i: answers.seen_item(F.from_json(F.to_json(i), ITEM_DDL)))
    assert df.select(answers.answer_method(F.col("t"), full("b"), full("a"), F.col("answer"), F.col("q"))).first()[0] == method


def test_every_rule_of_an_answer_shows_once(spark):
    method = answers.answer_method(F.col("next_question_target"), F.col("before"), F.col("after"), F.col("answer"), F.col("utterance"))
    got = {r[0]: r[1] for r in answers._planted(spark).select("dialogue_id", method).collect()}
    want = {f"planted {n}": case[0] if case[0] not in ("known before", "unsure") else None for n, case in enumerate(answers.PLANTED_ANSWERS)}
    assert got == want and {"unique_attribute_delta", "short_attribute_answer"} <= set(got.values())


def test_nulls_and_empty_states_answer_nothing(spark):
    target = "struct<name:string,type:string,attribute:string>"
    df = spark.createDataFrame([(None, None, None), (("", "symptom", None), [], ""), (("腹痛", None, "duration"), [None], "多久？")], f"t {target}, a array<string>, q string").withColumn("s", F.lit(None).cast(STATE_DDL))
    items = answers.seen_items(F.col("s"))
    rows = df.select(F.size(items), answers.answer_method(F.col("t"), items, items, F.col("a"), F.col("q")), answers.target_is_known(F.col("t"), items), F.size(answers.answerable(items, items))).collect()
    assert [tuple(r) for r in rows] == [(0, None, False, 0)] * 3


@pytest.mark.parametrize(
    ("fact", "want"),
    [
        (("腹痛加重", "symptom", "present", "patient", {"severity": "重"}), ("程度", "attribute", {"severity": "重", "target": "腹痛"})),
        (("隐痛", "symptom", "present", "patient", {"severity": "重", "time": "夜间"}), ("症状属性", "attribute", {"severity": "重", "time": "夜间", "target": "腹痛"})),
        (("肛周疼痛", "symptom", "present", "patient", {"severity": "重"}), None), (("腹痛", "symptom", "present", "family", {"severity": "重"}), None), (("腹痛", "symptom", "absent", "patient", {"severity": "重"}), None),
        (("腹痛", "symptom", "present", "patient", {}), None), (("头晕", "symptom", "present", "patient", {"severity": "重"}), None), (("腹痛", "disease", "present", "patient", {"severity": "重"}), None),
    ],
)
def test_continuations_become_attributes(spark, fact, want):
    ddl = "dialogue_id string, turn_id int, fact_pos int, name string, normalized_name string, type string, status string, subject string, attribute map<string,string>, evidence string"
    name, kind, status, subject, attribute = fact
    rows = spark.createDataFrame([("d", 1, 0, name, name, kind, status, subject, attribute, "clash")], ddl)
    problem = {"name": "腹痛", "normalized_name": "腹痛", "type": "symptom", "status": "present", "subject": "patient", "aliases": [], "last_turn_id": 0}
    turns = spark.createDataFrame([("d", 1, "腹痛的程度怎么样？", json.dumps({"problems": [problem]}))], "dialogue_id string, turn_id int, question string, s string").withColumn("state", F.from_json("s", STATE_DDL)).drop("s")
    (got,) = answers.continuation_rewrites(rows, turns).collect()
    assert got["rewritten"] == (want is not None)
    assert (got["name"], got["type"], got["attribute"]) == (want or (name, kind, attribute))
    unasked = answers.continuation_rewrites(rows, turns.withColumn("question", F.lit("还有吗？"))).first()
    assert not unasked["rewritten"] and unasked["name"] == name


@pytest.mark.parametrize(("question", "slots", "compound"), [("腹痛多久了？", ["duration"], False), ("多久一次？", ["frequency"], False), ("多久了，在哪里？", ["body_part", "duration"], True), ("有没有发热，有没有咳嗽？", [], True), ("", [], False)])
def test_slots(spark, question, slots, compound):
    df = spark.createDataFrame([(question,)], "q string")
    assert tuple(df.select(interview.question_slots(F.col("q")), interview.is_compound(F.col("q"))).first()) == (slots, compound)


def test_ledger_forgets_what_succeeded(spark):
    ts = lambda n: datetime(2024, 1, 1, n)
    rows = [("a", ts(1), False, "x", "e1"), ("a", ts(2), False, "y", "e2"), ("a", ts(2), False, "y", "e2"), ("b", ts(1), False, "x", "e"), ("b", ts(2), True, "x", None), ("c", ts(1), True, "x", None), ("c", ts(3), False, "z", None), (None, ts(1), False, "x", "e")]
    got = ledger.failure_ledger(spark.createDataFrame(rows, "k string, at timestamp, ok boolean, stage string, error string"), "k").drop("updated_at")
    assert sorted(map(tuple, got.collect())) == [("a", 2, "x", "y", "e2"), ("c", 1, "z", "z", None)]


def test_pending_covers_every_dialogue(spark, tmp_path):
    ids = [f"d{n:04d}" for n in range(1200)]
    spark.createDataFrame([(n, d, 0, "user", "x", None) for n, d in enumerate(ids)], MESSAGES).write.parquet(str(tmp_path / "messages.parquet"))
    spark.createDataFrame([(d,) for n, d in enumerate(ids) if n % 100 and n != 1150], "source_dialogue_id string").write.parquet(str(tmp_path / "interviewer_rows.parquet"))
    turns = "dialogue_id string, turn_id int, model string, api_format string, processed_at timestamp, patient_state_after_turn string"
    spark.createDataFrame([("d1100", 0, "m", "f", datetime(2024, 1, 1), None)], turns).write.parquet(str(tmp_path / "turn_rows.parquet"))
    got = ledger.pending_antijoin(spark, str(tmp_path)).collect()
    assert sorted(r["source_pos"] for r in got) == [*range(0, 1100, 100), 1150]
    assert all(r["dialogue_id"] == ids[r["source_pos"]] for r in got)


def test_unions_by_precedence_and_runs(spark):
    one = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    got = ledger.precedence_union([one(("a", 1)), one(("a", 2), ("b", 3)), one(("b", 4), ("c", 5))], "k")
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [("a", 1), ("b", 3), ("c", 5)]
    rows = spark.createDataFrame([(n, k) for n, k in zip([0, 1, 2, 9_999, 10_000, 10_001, 25_000], "aabbbac", strict=True)], "pos long, k string")
    got = ledger.consecutive_groups(rows, "k", "pos").orderBy("pos").collect()
    assert [r["group"] for r in got] == [1, 1, 2, 2, 2, 3, 4]


def test_splits_keep_dialogues_together(spark):
    ids = [f"d{n}" for n in range(1000)]
    whole = splits.split_by_shuffle(ids)
    assert [list(whole.values()).count(s) for s in splits.SPLITS] == [900, 50, 50] and whole == splits.split_by_shuffle(ids[::-1])
    rows = spark.createDataFrame([(d,) for d in ids * 2], "d string").select("d", splits.split_of(F.col("d")).alias("split"))
    assert splits.overlapping(rows, "d").isEmpty()
    assert 850 < rows.where("split = 'train'").select("d").distinct().count() < 940


def test_greedy_pairs_take_the_first_free(spark):
    ddl = "dialogue_id string, turn_id int, fact_pos int, name string, normalized_name string, type string, status string, subject string"
    f = lambda pos, name, status="present": ("d", 0, pos, name, None, "symptom", status, "patient")
    p, g = spark.createDataFrame([f(0, "A"), f(1, "a"), f(2, "a"), f(3, "b", "absent"), f(4, "c")], ddl), spark.createDataFrame([f(0, "a"), f(1, "a "), f(2, "b")], ddl)
    assert sorted((r["p_pos"], r["g_pos"]) for r in metrics.greedy_pairs(p, g).collect()) == [(0, 0), (1, 1)]
    # an unmatched fact is held against the unmatched ones of the other side alone: here against "b"
    causes = {(r["side"], r["pos"]): r["cause"] for r in metrics.failure_components(p, g).collect()}
    assert causes == {("predicted", 2): "single_name", ("predicted", 3): "single_status", ("predicted", 4): "single_name", ("gold", 2): "single_name"}


def test_files(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("编码;名称\nA;胃炎\n".encode("gb18030"))
    df = io.read_delimited(spark, str(tmp_path / "t.csv"))
    assert df.select(io.pick(df, ["code", " 编码 "]), io.pick(df, ["none"])).first()[:] == ("A", "")
    with pytest.raises(ValueError, match="unknown kind"):
        io.read_delimited(spark, "x.xls")
    (tmp_path / "j.jsonl").write_text('{"a": 1}\n\n[2]\n{"a": 3\n', encoding="utf-8")
    assert sorted(r["line"] for r in io.bad_lines(spark, str(tmp_path / "j.jsonl")).collect()) == ['[2]', '{"a": 3']
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        io.read_jsonl(spark, str(tmp_path / "j.jsonl"), "a int").collect()
    rows = spark.createDataFrame([("b", None), ("a", "x")], "dialogue_id string, e string")
    assert io.write_ledger(rows, str(tmp_path / "ledger"))
    assert [r["dialogue_id"] for r in io.read_jsonl(spark, str(tmp_path / "ledger"), "dialogue_id string, e string").collect()] == ["a", "b"]
    assert not io.write_ledger(rows.limit(0), str(tmp_path / "ledger")) and not (tmp_path / "ledger").exists()


def test_tables_of_other_kinds(spark, tmp_path):
    (tmp_path / "q.csv").write_bytes('编码,名称\nA,"胃炎，\n急性"\nB,"a,b"\n'.encode("gb18030"))
    assert sorted(map(tuple, io.read_delimited(spark, str(tmp_path / "q.csv")).collect())) == [("A", "胃炎，\n急性"), ("B", "a,b")]
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "t.xlsx", "w") as book:
        book.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>code</t></si><si><t>name</t></si><si><r><t>胃</t></r><r><t>炎</t></r></si></sst>")
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>12</v></c><c r="C2" t="s"><v>2</v></c></row><row><c r="C3" t="inlineStr"><is><t>x</t></is></c></row><row/></sheetData></worksheet>')
    df = io.read_table(spark, str(tmp_path / "t.xlsx"))
    assert df.columns == ["code", "", "name"] and sorted(map(tuple, df.collect()), key=str) == [("12", None, "胃炎"), (None, None, "x")]


def test_terminology_sources(spark, tmp_path):
    icd = spark.createDataFrame([("K29", "胃炎", "急性胃炎；胃粘膜炎"), ("", "x", ""), ("K30", " ", "")], "`疾病诊断代码` string, `疾病诊断名称` string, `同义词` string")
    got = terms.import_terms(terms.disease_rows(icd, io.pick)).select("code", "alias").collect()
    assert sorted(map(tuple, got)) == [("K29", "急性胃炎"), ("K29", "胃炎"), ("K29", "胃粘膜炎")]
    loinc = spark.createDataFrame([("1-8", "Glucose [Mass] in Blood"), ("2-6", "Iron")], "LOINC_NUM string, LONG_COMMON_NAME string")
    chinese = spark.createDataFrame([("1-8", "葡萄糖.血液.定量", "血糖测定", "葡萄糖"), ("3-4", "很长.的^名称", "", "")], "LOINC_NUM string, LONG_COMMON_NAME string, SHORTNAME string, COMPONENT string")
    rows = {r["code"]: (r["preferred_name"], set(r["aliases"])) for r in terms.examination_rows(loinc, chinese, io.pick).collect()}
    assert rows["1-8"] == ("葡萄糖", {"葡萄糖.血液.定量", "血糖测定", "葡萄糖", "Glucose [Mass] in Blood"})
    assert rows["2-6"][0] == "Iron" and rows["3-4"][0] == "很长.的^名称"
    assert {r["code"] for r in terms.examination_rows(loinc, None, io.pick).collect()} == {"1-8", "2-6"}


def test_reports_backups_and_registries(spark, tmp_path):
    assert io.read_report(str(tmp_path / "none.json")) == {}
    io.write_report({"rows": 3}, str(tmp_path / "r.json"))
    assert io.read_report(str(tmp_path / "r.json")) == {"rows": 3} and io.merged_report({"a": str(tmp_path / "r.json"), "b": str(tmp_path / "none.json")}) == {"a": {"rows": 3}}
    (copy,) = io.backup(spark, [str(tmp_path / "r.json"), str(tmp_path / "none.json")], str(tmp_path / "runs"))
    assert io.read_report(copy.removeprefix("file:")) == {"rows": 3}
    hashes = io.file_hashes(spark, str(tmp_path / "r.json")).first()
    assert hashes["sha256"] == hashlib.sha256((tmp_path / "r.json").read_bytes()).hexdigest()
    assert io.dataset_names(" a, b,,") == ["a", "b"] == io.dataset_names(["a", " b"]) and io.dataset_names(None) == []
    assert io.registry_errors({"a": {"file_name": "r.json"}, "b": {"file_name": "x"}}, ["a", "b", "c", "a"], str(tmp_path)) == ["a: named twice", "b: no file x", "c: not in the registry"]


def test_inputs_are_read_back(spark):
    rows = [("多久了？", "三天\n了 ", '{"a":1}', "患者：痛"), (None, None, None, None), ("", "当前问诊状态：x", "bad", "")]
    df = spark.createDataFrame(rows, "q string, u string, s string, c string").select(prompts.extractor_input(F.col("q"), F.col("u"), F.col("s"), F.col("c")).alias("t"))
    parsed = df.select(prompts.utterance_of(F.col("t")), prompts.section(F.col("t"), "没有：")).collect()
    assert [tuple(r) for r in parsed] == [("三天\n了", None), ("", None), ("当前问诊状态：x", None)]
    ask = spark.createDataFrame([(["痛"], '{"chief_complaint":"腹痛"}', '[{"type":"symptom","name":"腹痛","attribute":""}]'), (None, None, None), ([], "bad", "bad")], "b array<string>, s string, a string")
    text = prompts.interviewer_input(F.col("b"), F.col("s"), F.lit(None).cast("string"), F.col("a"))
    got = ask.select(prompts.runtime_state(text, "struct<chief_complaint:string>")["chief_complaint"], F.size(prompts.runtime_asked(text))).collect()
    assert [tuple(r) for r in got] == [("腹痛", 1), (None, 0), (None, 0)]


def test_prompts_show_what_they_may(spark):
    df = spark.createDataFrame([("有", ["e1", "e2"], "秘密")], "u string, e array<string>, next string")
    row = df.select(prompts.user_prompt(F.lit("痛吗？"), F.col("u"), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("p"), prompts.retry_prompt(F.col("e")).alias("r"), prompts.teacher_prompt({"patient_block": F.array("u"), "next_patient_block": F.col("next")}).alias("t")).first()
    assert "很短" in row["p"] and row["r"].endswith("- e1\n- e2") and row["t"] == '{"patient_block":["有"]}'
    assert df.select(prompts.unusable_decision("UNSAFE_QUESTION").alias("d")).first()["d"]["skip_reason_code"] == "UNSAFE_QUESTION"
    with pytest.raises(ValueError, match="no reason"):
        prompts.unusable_decision("OTHER")
    with pytest.raises(Exception, match="no reason"):
        df.select(prompts.unusable_decision(F.col("next"))).collect()


class Faulty(clients.RuleModel):
    """Answers wrongly until it is told its errors."""

    def extract(self, utterance, question, state, errors=None):
        good = super().extract(utterance, question, state)
        return good if errors or utterance == "腹痛" else [f | {"evidence": "没说"} for f in good]


def test_turns_are_read_with_feedback():
    model = Faulty({"腹痛": "symptom"})
    assert clients.extracted_turn(model, "好的，谢谢。", None, {}) == ([], 0)
    facts_, calls = clients.extracted_turn(model, "我腹痛", None, {})
    assert calls == 2 and facts_[0]["evidence"] == "腹痛"
    with pytest.raises(ValueError, match="evidence not in utterance"):
        clients.extracted_turn(model, "我腹痛", None, {}, attempts=1)
    assert clients.is_courtesy("嗯嗯，好的") and not clients.is_courtesy("好的，我去吃药") and not clients.is_courtesy("")


def test_retries_wait_and_give_up():
    waits, tries = [], []

    def call():
        tries.append(1)
        raise TimeoutError("late")

    with pytest.raises(TimeoutError):
        clients.with_retries(call, 3, 0.2, waits.append, jitter=lambda a, b: b)()
    assert len(tries) == 3 and waits == [1.0, 1.5]
    with pytest.raises(ValueError, match="bad"):
        clients.with_retries(lambda: (_ for _ in ()).throw(ValueError("bad")), 3, sleep=waits.append)()
    assert len(waits) == 2


def test_dialogues_stop_at_a_failed_turn(spark):
    rows = [("a", 0, None, "腹痛"), ("a", 1, None, "还有腹痛"), ("a", 2, None, "腹痛"), ("b", 0, None, "腹痛"), ("b", 1, None, None)]
    got = sessions.synthesized_turns(spark.createDataFrame(rows, "dialogue_id string, turn_id int, question string, utterance string"), Faulty({"腹痛": "symptom"}), attempts=1).collect()
    assert {(r["dialogue_id"], r["turn_id"]): r["ok"] for r in got} == {("a", 0): True, ("a", 1): False, ("a", 2): False, ("b", 0): True, ("b", 1): True}
    blocks = [("s", n, '{"problems": [{"type": "symptom", "normalized_name": "腹痛"}]}', n == 4) for n in range(5)]
    decided = sessions.synthesized_sessions(spark.createDataFrame(blocks, "dialogue_id string, block_id int, state string, is_terminal boolean"), Faulty({})).orderBy("block_id").collect()
    assert [(r["action"], r["calls"]) for r in decided] == [("ask", 1), ("ask", 1), ("ask", 1), ("end", 1), ("end", 0)] and len({r["utterance"] for r in decided[:3]}) == 3


def test_questions_over_a_stream(spark, tmp_path):
    state = '{"problems": [{"type": "symptom", "normalized_name": "腹痛"}]}'
    rows = [("s", 2, state, False), ("s", 1, state, False), ("s", 3, "[1]", False), (None, 1, None, False), ("s", 4, state, True)]
    schema = "session_id string, seq long, state string, reset boolean"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = sessions.question_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), clients.RuleModel({}))
    got = {(r["session_id"], r["seq"]): (r["ok"], r["action"], r["turn_count"]) for r in sessions.run_to_table(stream, str(tmp_path / "out")).collect()}
    assert got == {("s", 1): (True, "ask", 1), ("s", 2): (True, "ask", 2), ("s", 3): (False, None, 2), ("s", 4): (True, "ask", 1), ("default", 1): (True, "end", 1)}


def test_projections_are_checked(spark):
    fact = "array<struct<name:string,normalized_name:string,type:string,status:string,subject:string,evidence:string,standard_code:string>>"
    a, b = ("腹痛", "腹痛", "symptom", "present", "patient", "腹痛", "C"), ("腹痛", "腹痛", "symptom", "present", "patient", "腹痛", None)
    df = spark.createDataFrame([([a], [b]), ([a], [a]), ([a, a], [b]), ([a], [("胃痛", *b[1:])])], f"r {fact}, t {fact}")
    got = [r[0] for r in df.select(projection.projection_errors(F.col("r"), F.col("t"))).collect()]
    assert got == [[], ["facts[0].standard_code"], ["number of facts"], ["facts[0].name"]]
    seen = spark.createDataFrame([('{"dialogue_id":"d","chief_complaint":"","problems":[{"name":"腹痛"}],"uncertain_findings":[{"name":"x"}],"lifestyle":[]}',)], "j string").select(F.to_json(projection.model_visible_state(F.from_json("j", STATE_DDL)))).first()[0]
    assert json.loads(seen) == {"problems": [{"name": "腹痛"}]}


def test_shards_hold_a_key_each(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "dialogue_id string, v int")
    io.write_shards(df, str(tmp_path / "s"), "dialogue_id")
    assert len(list((tmp_path / "s").glob("shard=*"))) == 2
    assert sorted(map(tuple, spark.read.schema("dialogue_id string, v int").json(str(tmp_path / "s")).select("dialogue_id", "v").collect()), key=str) == [("a", 1), ("a", 2), ("b", None)]


def test_secrets_are_not_logged():
    import logging

    record = logging.LogRecord("x", 20, "", 0, "run --api-key %s token=abc", ("sk-1",), None)
    io.Redacting().filter(record)
    assert "sk-1" not in record.getMessage() and "abc" not in record.getMessage()


def test_pipelines(spark, sf, tmp_path):
    report = pipelines.extractor_pipeline(spark, sf, str(tmp_path / "e"))
    assert report["facts_kept"] <= report["facts"] and sum(report["training_rows"].values()) > 0
    again = pipelines.extractor_pipeline(spark, sf, str(tmp_path / "e"), resume=True)
    assert again == report
    report = pipelines.interviewer_pipeline(spark, sf, str(tmp_path / "i"))
    assert pipelines.interviewer_pipeline(spark, sf, str(tmp_path / "i"), run_dir=str(tmp_path / "runs")) == report and len(list((tmp_path / "runs").glob("*/*"))) == 2
    assert report["usable_rows"] <= report["rows"] and report["split_overlaps"] == 0

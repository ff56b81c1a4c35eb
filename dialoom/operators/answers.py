"""What successive states tell of a question: whether its target is known, which entity it binds, and whether the next
block of the patient answered it.

Items are compared in one flat form (``seen_items``): their comparable names and aliases, type, status, subject and
the attributes of a question that they have a value for. An attribute counts as known if any of its keys has a value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.functions.lexicon import ATTRIBUTE_CUES, BUCKETS, DEGREE_FORM, ELIDED_CUES, FACT_TYPES, GENERIC_TARGETS, NO_ANSWERS, SHORT_ANSWER_FORMS, UNCERTAIN_CUES, YES_ANSWERS, YES_NO_CUES
from dialoom.functions.text import lexically_related, question_text
from dialoom.operators.facts import distinct_facts, latest_turns
from dialoom.operators.interview import COMPOUND_SQL, ONCE_SQL, canonical_attribute, canonical_sql, flat_sql, is_compound, question_slots, questions, related_sql, slots_sql
from dialoom.operators.state import ITEM_DDL, names_of
from dialoom.session import table

SEEN_DDL = "struct<name:string,names:array<string>,type:string,status:string,subject:string,known:array<string>>"
_SEEN_LIST = f"array<{SEEN_DDL}>"
#: Fields of an item that the compared form is made of.
_READ_DDL = "struct<name:string,normalized_name:string,aliases:array<string>,type:string,status:string,subject:string,attributes:map<string,string>>"
_READ = ["name", "normalized_name", "aliases", "type", "status", "subject", "attributes"]


def known_attributes(attributes: Column) -> Column:
    """Attributes of a question that a map of attributes has a value for, by the attribute that each key names."""
    filled = F.filter(F.map_entries(attributes), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(filled, F.array().cast("array<struct<key:string,value:string>>")), lambda e: canonical_attribute(e["key"])), lambda k: k.isNotNull())))


def seen_item(item: Column) -> Column:
    """An item of a state in the form in which items are compared."""
    raw = F.concat(F.array(item["name"], item["normalized_name"]), F.coalesce(item["aliases"], F.array().cast("array<string>")))
    names = F.array_sort(F.array_distinct(F.filter(F.transform(raw, question_text), lambda n: n != "")))
    shown = F.coalesce(F.nullif(item["name"], F.lit("")), item["normalized_name"], F.lit(""))
    return F.struct(F.trim(shown).alias("name"), names.alias("names"), item["type"].alias("type"), item["status"].alias("status"), item["subject"].alias("subject"), known_attributes(item["attributes"]).alias("known")).cast(SEEN_DDL)


def seen_items(state: Column) -> Column:
    """All items of a state, bucket by bucket, in the form in which they are compared; none for a null state.

    Each field is taken by itself, so that a scan reads those alone.
    """
    read = f"array<{_READ_DDL}>"
    items = F.concat(*(F.coalesce(F.arrays_zip(*(state[b][f] for f in _READ)).cast(read), F.array().cast(read)) for b in BUCKETS))
    return F.transform(items, seen_item)


def written_items(state: Column) -> Column:
    """:func:`seen_items` of a state as JSON text: a sixth of what the state itself takes in a shuffle or a sort."""
    return F.to_json(seen_items(state))


def read_items(text: Column) -> Column:
    """Items that :func:`written_items` wrote; none for null."""
    return F.from_json(F.coalesce(text, F.lit("[]")), _SEEN_LIST, {"mode": "FAILFAST"})


def with_items(result: Callable[[Column, Column], Column], *columns: str) -> Column:
    """``result`` of the items in ``columns``, which are worked out once, however often it names them.

    The optimizer would copy what makes a column to every place that names it, if a filter or a lambda does.
    """
    return F.get(F.transform(F.array(F.struct(*columns)), lambda s: result(*(s[c] for c in columns))), F.lit(0))


def target_is_known(target: Column, items: Column) -> Column:
    """Whether an item has the target's name and type and, if it asks for an attribute, a value for it."""
    wanted, attribute = question_text(target["name"]), canonical_attribute(target["attribute"])
    return F.coalesce(F.exists(items, lambda i: F.array_contains(i["names"], wanted) & (i["type"] == target["type"]) & (attribute.isNull() | F.array_contains(i["known"], attribute))), F.lit(False))


def target_entity_exists(target: Column, items: Column) -> Column:
    """Whether exactly one item has the target's name and type."""
    return F.size(F.filter(items, lambda i: F.array_contains(i["names"], question_text(target["name"])) & (i["type"] == target["type"]))) == 1


def _alike(a: Column, b: Column, *fields: str) -> Column:
    out = F.lit(True)
    for f in fields:
        out = out & a[f].eqNullSafe(b[f])
    return out


def new_items(before: Column, after: Column) -> Column:
    """Items of ``after`` that ``before`` has none of, by names, type, status and subject."""
    return F.filter(after, lambda i: ~F.exists(before, lambda b: _alike(i, b, "names", "type", "status", "subject")))


def new_attributes(before: Column, after: Column) -> Column:
    """``item, keys`` of every item of ``after`` with attributes that its first counterpart in ``before`` hasn't.

    The counterpart has the same type, status and subject and a common name; without one there is no new attribute.
    """

    def compared(i: Column) -> Column:
        old = F.get(F.filter(before, lambda b: _alike(i, b, "type", "status", "subject") & F.arrays_overlap(i["names"], b["names"])), F.lit(0))
        return F.struct(i.alias("item"), F.when(old.isNotNull(), F.array_except(i["known"], old["known"])).otherwise(F.array().cast("array<string>")).alias("keys"))

    return F.filter(F.transform(after, compared), lambda c: F.size(c["keys"]) > 0)


def uncertain(text: Column) -> Column:
    """Whether a text says that it isn't sure."""
    return question_text(text).rlike("|".join(UNCERTAIN_CUES))


def short_answer_method(target: Column, answer: Column, question: Column) -> Column:
    """``explicit_short_answer`` to a yes-or-no question, ``short_attribute_answer`` to one for an attribute, or null."""
    attribute, said = canonical_attribute(target["attribute"]), F.array_join(answer, "")
    short = question_text(said)
    plain = (short != "") & (F.length(short) <= 16) & ~uncertain(said)
    yes_no = question_text(question).rlike("|".join(YES_NO_CUES)) & ~is_compound(question)
    explicit = plain & yes_no & (short.isin(YES_ANSWERS + NO_ANSWERS) | short.rlike(DEGREE_FORM))
    fits_form = F.lit(False)
    for slot, form in SHORT_ANSWER_FORMS.items():
        fits_form = fits_form | ((attribute == slot) & short.rlike(form))
    of_slot = plain & F.coalesce(question_slots(question) == F.array(attribute), F.lit(False)) & fits_form
    return F.when(attribute.isNull() & explicit, "explicit_short_answer").when(attribute.isNotNull() & of_slot, "short_attribute_answer")


def answer_method(target: Column, before: Column, after: Column, answer: Column, question: Column) -> Column:
    """The first rule that shows that the next block answered a target; null if none does or it was known before.

    ``before`` and ``after``: :func:`seen_items` of the states; ``answer``: messages of the next block, maybe null.
    """
    wanted, kind, attribute = question_text(target["name"]), target["type"], canonical_attribute(target["attribute"])
    entity, said = attribute.isNull(), F.coalesce(F.array_join(answer, ""), F.lit(""))
    fresh = F.filter(new_items(before, after), lambda i: i["type"] == kind)
    grown = F.filter(new_attributes(before, after), lambda c: F.array_contains(c["keys"], attribute) & (c["item"]["type"] == kind))
    rivals = F.filter(before, lambda i: i["type"] == kind)
    return (
        F.when(target_is_known(target, before), F.lit(None))
        .when(target_is_known(target, after), "exact_state_match")
        .when(~entity & F.exists(grown, lambda c: F.array_contains(c["item"]["names"], wanted)), "canonical_attribute_match")
        .when(~entity & (F.size(grown) == 1) & (F.size(rivals) == 1), "unique_attribute_delta")
        .when(entity & F.trim(target["name"]).isin(GENERIC_TARGETS) & (F.size(fresh) > 0), "generic_type_delta")
        .when(entity & F.exists(fresh, lambda i: F.exists(i["names"], lambda n: lexically_related(target["name"], n))), "lexical_state_delta")
        .when(entity & ~uncertain(said) & lexically_related(target["name"], said), "lexical_answer_match")
        .otherwise(short_answer_method(target, answer, question))
    )


def resolved_target(target: Column, items: Column, question: Column) -> Column:
    """The name of the one item that a question for an attribute binds: the only one of its name, else, if the question
    leaves the entity out, the only one of its type; null if there is none."""
    fits = F.filter(items, lambda i: i["type"] == target["type"])
    exact = F.filter(fits, lambda i: F.array_contains(i["names"], question_text(target["name"])))
    elided = question_text(question).rlike("|".join(ELIDED_CUES))
    name = F.when(F.size(exact) == 1, F.get(exact, F.lit(0))["name"]).when(elided & (F.size(fits) == 1), F.get(fits, F.lit(0))["name"])
    return F.when(canonical_attribute(target["attribute"]).isNotNull() & target["type"].isin(FACT_TYPES), name)


def answerable(before: Column, after: Column) -> Column:
    """Targets that the change of the states answers, as distinct ``type, name, attribute`` in comparable form.

    An item whose entity the state before hasn't in this status is one; of others, each attribute that is new.
    """

    def targets(i: Column) -> Column:
        old = F.get(F.filter(before, lambda b: _alike(i, b, "names", "type", "status", "subject")), F.lit(0))
        keys = F.when(old.isNull(), F.array(F.lit(None).cast("string"))).otherwise(F.array_except(i["known"], old["known"]))
        return F.transform(keys, lambda k: F.struct(question_text(i["type"]).alias("type"), question_text(i["name"]).alias("name"), F.coalesce(k, F.lit("")).alias("attribute")))

    usable = F.filter(after, lambda i: (i["name"] != "") & i["type"].isin(FACT_TYPES))
    return F.array_distinct(F.filter(F.flatten(F.transform(usable, targets)), lambda t: t["name"] != ""))


def asked_states(rows: DataFrame, turn_rows: DataFrame, *keep: str) -> DataFrame:
    """Questions (once per block) with ``before`` and ``after``: the states after their own and after the next block.

    Of a question's other columns only those in ``keep`` come along, and ``answer``, the next block, if ``patient_block``
    is one. The state of a block is that of its last turn in the source dialogue. Two shuffles of the states, as text:
    by dialogue and turn, then by session; sessions are short. The join is never a broadcast: Spark takes the
    states for less than its threshold when they have hundreds of MB, and the driver would have to hold them.
    """
    states = turn_rows.select("dialogue_id", "turn_id", written_items(F.col("patient_state_after_turn")).alias("state"), "processed_at")
    states = latest_turns(states).select(F.col("dialogue_id").alias("source_dialogue_id"), F.col("turn_id").alias("last_turn"), "state")
    blocks = rows.select("dialogue_id", "block_id", "source_dialogue_id", F.array_max("patient_turn_ids").alias("last_turn"), *dict.fromkeys(["utterance", *keep]))
    along = Window.partitionBy("dialogue_id").orderBy("block_id")
    blocks = questions(blocks).join(states.hint("merge"), ["source_dialogue_id", "last_turn"], "left").withColumn("next_state", F.lead("state").over(along))
    if "patient_block" in keep:
        blocks = blocks.withColumn("answer", F.lead("patient_block").over(along))
    return blocks.select("*", read_items(F.col("state")).alias("before"), read_items(F.col("next_state")).alias("after"))


#: Cases that every rule must show once, beside those of the tables: target, items before and after (name, type,
#: attributes), answer, question.
PLANTED_ANSWERS = [
    ("exact_state_match", ("发热", "symptom", None), [], [("发热", "symptom", {})], "有", "有没有发热？"),
    ("exact_state_match", ("腹痛", "symptom", "程度"), [("腹痛", "symptom", {"time": "夜间"})], [("腹痛", "symptom", {"time": "夜间", "severity": "重"})], "很重", "腹痛严重吗？"),
    ("unique_attribute_delta", ("肚子不舒服", "symptom", "severity"), [("腹痛", "symptom", {})], [("腹痛", "symptom", {"程度": "重"})], "说不好", "严重吗？"),
    ("generic_type_delta", ("伴随症状", "symptom", None), [("腹痛", "symptom", {})], [("腹痛", "symptom", {}), ("恶心", "symptom", {})], "还恶心", "还有别的吗？"),
    ("lexical_state_delta", ("上腹疼痛", "symptom", None), [], [("上腹刺痛", "symptom", {})], "是这样", "有没有上腹疼痛？"),
    ("lexical_answer_match", ("腹泻", "symptom", None), [], [], "没有腹泻", "有没有腹泻？"),
    ("explicit_short_answer", ("呕吐", "symptom", None), [], [], "没有", "有没有呕吐？"),
    ("short_attribute_answer", ("腹痛", "symptom", "duration"), [], [], "三天了", "腹痛多久了？"),
    ("known before", ("腹痛", "symptom", None), [("腹痛", "symptom", {})], [("腹痛", "symptom", {})], "有", "有没有腹痛？"),
    ("unsure", ("头晕", "symptom", None), [], [], "不清楚", "有没有头晕？"),
]


def _planted(spark: SparkSession) -> DataFrame:
    raw = "array<struct<name:string,type:string,attributes:map<string,string>>>"
    rows = [(f"planted {n}", 0, t, b, a, [said], q) for n, (_, t, b, a, said, q) in enumerate(PLANTED_ANSWERS)]
    df = spark.createDataFrame(rows, f"dialogue_id string, block_id int, next_question_target struct<name:string,type:string,attribute:string>, b {raw}, a {raw}, answer array<string>, utterance string")

    def items(column: str) -> Column:
        full = F.transform(column, lambda i: F.struct(i["name"].alias("name"), F.lit(None).cast("string").alias("normalized_name"), F.array().cast("array<string>").alias("aliases"), i["type"].alias("type"), F.lit("present").alias("status"), F.lit("patient").alias("subject"), i["attributes"].alias("attributes")))
        return F.transform(full, seen_item)

    return df.select("dialogue_id", "block_id", "next_question_target", items("b").alias("before"), items("a").alias("after"), "answer", "utterance")


def _asked(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return asked_states(table(spark, sf_dir, "interviewer_rows"), table(spark, sf_dir, "turn_rows"), *keep)


def _given(value: Column) -> Column:
    """A value where it isn't null, else no row; as a filter would work it out a second time."""
    return F.explode(F.array_compact(F.array(value)))


def answerability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions, of the table and planted ones, that the next block answered, and by which rule that shows."""
    rows = _asked(spark, sf_dir, "action", "next_question_target", "patient_block").where("action = 'ask' and answer is not null and next_question_target.name is not null")
    rows = rows.select("dialogue_id", "block_id", "next_question_target", "before", "after", "answer", F.coalesce("utterance", F.lit("")).alias("utterance")).unionByName(_planted(spark))
    method = with_items(lambda before, after: answer_method(F.col("next_question_target"), before, after, F.col("answer"), F.col("utterance")), "before", "after")
    return rows.select("dialogue_id", "block_id", _given(method).alias("method"))


def known_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions by whether their target is known before and after the answer, and names exactly one entity."""
    target = F.col("next_question_target")
    rows = _asked(spark, sf_dir, "action", "next_question_target").where("action = 'ask' and next_question_target.name is not null")
    asked_for = F.when(canonical_attribute(target["attribute"]).isNull(), "entity").otherwise("attribute")

    def flags(before: Column, after: Column) -> Column:
        return F.struct(target_is_known(target, before).alias("known_before"), target_is_known(target, after).alias("known_after"), target_entity_exists(target, before).alias("one_entity"))

    rows = rows.select(asked_for.alias("asked_for"), with_items(flags, "before", "after").alias("flags")).select("asked_for", "flags.*")
    return rows.groupBy("asked_for", "known_before", "known_after", "one_entity").agg(F.count("*").alias("n"))


def resolved_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions for an attribute with the entity of the state that they bind."""
    rows = _asked(spark, sf_dir, "action", "next_question_target").where("action = 'ask'")
    name = with_items(lambda before: resolved_target(F.col("next_question_target"), before, F.coalesce("utterance", F.lit(""))), "before")
    return rows.select("dialogue_id", "block_id", canonical_attribute(F.col("next_question_target.attribute")).alias("attribute"), _given(name).alias("bound_to"))


def answerable_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a question could have asked for: targets, entities and attributes, that the next block answered."""
    rows = _asked(spark, sf_dir)
    return rows.select("dialogue_id", "block_id", F.inline(with_items(answerable, "before", "after")))


def decision_gates(target: Column, before: Column, after: Column, answer: Column, question: Column) -> Column:
    """What stands against asking for a target: it is known, binds no entity, or the next block doesn't answer it.

    The last one needs the next block; without one (null) nothing tells it.
    """
    attribute = canonical_attribute(target["attribute"]).isNotNull()
    known = target_is_known(target, before)
    checks = [
        (known, "TARGET_ALREADY_KNOWN"),
        (attribute & resolved_target(target, before, question).isNull(), "TARGET_NOT_RESOLVED"),
        (answer.isNotNull() & ~known & answer_method(target, before, after, answer, question).isNull(), "ANSWER_NOT_OBSERVED"),
    ]
    return F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for c, m in checks)), lambda m: m.isNotNull())


def gated_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions of the table by what stands against them over whole states."""
    rows = _asked(spark, sf_dir, "action", "next_question_target", "patient_block").where("action = 'ask' and next_question_target.name is not null")
    gates = with_items(lambda before, after: decision_gates(F.col("next_question_target"), before, after, F.col("answer"), F.coalesce("utterance", F.lit(""))), "before", "after")
    return rows.select(F.array_join(gates, ",").alias("gates")).groupBy("gates").agg(F.count("*").alias("n"))


#: What an attribute is called as a fact of its own.
DISPLAY_NAMES = {
    "time": "发生时间", "body_part": "部位", "duration": "持续时间", "episode_duration": "单次持续时间", "frequency": "频率", "character": "性质", "severity": "程度", "trigger": "诱因", "aggravating_factor": "加重因素",
    "relieving_factor": "缓解因素", "color": "颜色", "amount": "数量", "effect": "效果", "dose": "剂量", "result": "结果", "route": "给药途径", "side_effect": "不良反应",
}
SEVERAL_ATTRIBUTES = "症状属性"


def active_problem(state: Column, question: Column) -> Column:
    """The only problem of the latest turn of a state, if the question asks for an attribute; else null."""
    problems = F.coalesce(state["problems"], F.array().cast(f"array<{ITEM_DDL}>"))
    latest = F.array_max(F.transform(problems, lambda p: F.coalesce(p["last_turn_id"], F.lit(-1))))
    near = F.filter(problems, lambda p: F.coalesce(p["last_turn_id"], F.lit(-1)) == latest)
    asks = F.coalesce(question, F.lit("")).rlike("|".join(ATTRIBUTE_CUES))
    return F.when(asks & (F.size(near) == 1), F.get(near, F.lit(0)))


def continues(fact: Column, active: Column) -> Column:
    """Whether a present symptom only describes the active problem further: by its name, or as a short word for a pain."""
    mine = F.filter(F.array(F.trim(fact["name"]), F.trim(fact["normalized_name"])), lambda n: F.coalesce(n != "", F.lit(False)))

    def pair(old: Column, new: Column) -> Column:
        return F.contains(new, old) | F.contains(old, new) | (F.endswith(old, F.lit("痛")) & F.endswith(new, F.lit("痛")) & (F.length(new) <= 3))

    related = F.exists(names_of(active), lambda o: F.exists(mine, lambda n: pair(o, n)))
    return active.isNotNull() & (fact["type"] == "symptom") & (fact["status"] == "present") & fact["subject"].eqNullSafe(active["subject"]) & (F.coalesce(F.size(fact["attribute"]), F.lit(0)) > 0) & related


def continuation_rewrites(facts: DataFrame, turns: DataFrame) -> DataFrame:
    """``facts`` with ``rewritten``: a continuation becomes an attribute fact that targets the active problem.

    ``turns``: ``dialogue_id, turn_id, state`` (before the turn) and ``question``. The active problem must be the only
    one of its name. Of several attributes the fact is named after none of them. Joined by dialogue and turn.
    """
    active = active_problem(F.col("state"), F.col("question"))
    named = F.coalesce(F.nullif(F.trim(active["normalized_name"]), F.lit("")), F.nullif(F.trim(active["name"]), F.lit("")))
    same = F.filter(F.coalesce(F.col("state.problems"), F.array().cast(f"array<{ITEM_DDL}>")), lambda p: F.array_contains(names_of(p), F.col("target")))
    turns = turns.withColumn("target", named).withColumn("active", F.when(F.size(same) == 1, F.get(same, F.lit(0))))
    rows = facts.join(turns.where("active is not null").select("dialogue_id", "turn_id", "target", "active"), ["dialogue_id", "turn_id"], "left")
    rewritten = F.coalesce(continues(F.struct("name", "normalized_name", "type", "status", "subject", "attribute"), F.col("active")), F.lit(False))
    keys = F.array_remove(F.map_keys("attribute"), "target")
    labels = F.create_map(*(F.lit(x) for pair in DISPLAY_NAMES.items() for x in pair))
    first = F.get(keys, F.lit(0))
    label = F.when(F.size(keys) == 1, F.coalesce(F.try_element_at(labels, first), first)).otherwise(SEVERAL_ATTRIBUTES)
    given = F.map_from_entries(F.concat(F.filter(F.map_entries("attribute"), lambda e: e["key"] != "target"), F.array(F.struct(F.lit("target").alias("key"), F.col("target").alias("value")))))
    rows = rows.withColumns({"rewritten": rewritten, "label": label, "given": given})
    new = {"name": F.col("label"), "normalized_name": F.col("label"), "type": F.lit("attribute"), "attribute": F.col("given")}
    return rows.withColumns({c: F.when(F.col("rewritten"), v).otherwise(F.col(c)) for c, v in new.items()}).drop("label", "given", "target", "active")


def states_before(turn_rows: DataFrame) -> DataFrame:
    """``dialogue_id, turn_id, question, state``: of every turn the question and the state of the turn before it."""
    rows = latest_turns(turn_rows.select("dialogue_id", "turn_id", "previous_doctor_question", "patient_state_after_turn", "processed_at"))
    along = Window.partitionBy("dialogue_id").orderBy("turn_id")
    return rows.select("dialogue_id", "turn_id", F.col("previous_doctor_question").alias("question"), F.lag("patient_state_after_turn").over(along).alias("state"))


def rewritten_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that only continue the active problem, as the attribute facts that they become."""
    rows = continuation_rewrites(distinct_facts(table(spark, sf_dir, "facts")), states_before(table(spark, sf_dir, "turn_rows")))
    return rows.where("rewritten").select("dialogue_id", "turn_id", "fact_pos", "name", "type", F.col("attribute")["target"].alias("target"), F.size("attribute").alias("attributes"))


QUERIES = {"answerability": answerability, "known_targets": known_targets, "resolved_targets": resolved_targets, "answerable_targets": answerable_targets, "gated_decisions": gated_decisions, "rewritten_facts": rewritten_facts}


def _list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _seen_sql(i: str) -> str:
    return f"""{{'name': trim(coalesce(nullif({i}.name, ''), {i}.normalized_name, ''), ' '),
    'names': list_sort(list_distinct(list_filter(list_transform(list_concat([{i}.name, {i}.normalized_name], coalesce({i}.aliases, [])), lambda n: {flat_sql("n")}), lambda n: n <> ''))),
    'type': {i}.type, 'status': {i}.status, 'subject': {i}.subject,
    'known': list_sort(list_distinct(list_filter(list_transform(coalesce(map_entries({i}.attributes), []), lambda e: CASE WHEN coalesce(e.value, '') <> '' THEN {canonical_sql("e.key")} END), lambda k: k IS NOT NULL)))}}"""


def _literal(items: list[tuple]) -> str:
    def one(name: str, kind: str, attributes: dict[str, str]) -> str:
        pairs = f"MAP {{{', '.join(f'{k!r}: {v!r}' for k, v in attributes.items())}}}" if attributes else "CAST(MAP {} AS MAP(VARCHAR, VARCHAR))"
        return f"{{'name': {name!r}, 'normalized_name': NULL, 'aliases': CAST([] AS VARCHAR[]), 'type': {kind!r}, 'status': 'present', 'subject': 'patient', 'attributes': {pairs}}}"

    listed = f"[{', '.join(one(*i) for i in items)}]"
    return f"list_transform({listed}, lambda i: {_seen_sql('i')})" if items else "[]"


_SEEN = "STRUCT(name VARCHAR, names VARCHAR[], type VARCHAR, status VARCHAR, subject VARCHAR, known VARCHAR[])[]"
_BEFORE_SQL = f"""WITH {ONCE_SQL}, states AS (
  SELECT dialogue_id AS source_dialogue_id, turn_id AS last_turn, list_transform(flatten([{", ".join(f"coalesce(s.{b}, [])" for b in BUCKETS)}]), lambda i: {_seen_sql("i")}) AS state
  FROM (SELECT dialogue_id, turn_id, arg_max({{'s': patient_state_after_turn}}, processed_at).s AS s FROM turn_rows GROUP BY ALL)
), placed AS (SELECT *, list_max(patient_turn_ids) AS last_turn FROM asked), around AS (
  SELECT dialogue_id, block_id, action, t, tn, canon, u, fu, coalesce(state, CAST([] AS {_SEEN})) AS b, coalesce(lead(state) OVER w, CAST([] AS {_SEEN})) AS a, lead(patient_block) OVER w AS answer
  FROM placed LEFT JOIN states USING (source_dialogue_id, last_turn) WINDOW w AS (PARTITION BY dialogue_id ORDER BY block_id))"""
_PLANTED_SQL = " UNION ALL ".join(
    f"""SELECT 'planted {n}', 0, {{'name': '{t[0]}', 'type': '{t[1]}', 'attribute': {"NULL" if t[2] is None else f"'{t[2]}'"}}}, CAST({_literal(b)} AS {_SEEN}), CAST({_literal(a)} AS {_SEEN}), ['{said}'], '{q}'""" for n, (_, t, b, a, said, q) in enumerate(PLANTED_ANSWERS)
)


def _knows(items: str) -> str:
    return f"len(list_filter({items}, lambda i: list_contains(i.names, tn) AND i.type = t.type AND (canon IS NULL OR list_contains(i.known, canon)))) > 0"


_SAME = "x.names = i.names AND x.type IS NOT DISTINCT FROM i.type AND x.status IS NOT DISTINCT FROM i.status AND x.subject IS NOT DISTINCT FROM i.subject"
_KIN = "x.type IS NOT DISTINCT FROM i.type AND x.status IS NOT DISTINCT FROM i.status AND x.subject IS NOT DISTINCT FROM i.subject AND list_has_any(x.names, i.names)"
_METHODS_SQL = f"""{_BEFORE_SQL}, cases AS (
  SELECT dialogue_id, block_id, t, b, a, answer, u FROM around WHERE action = 'ask' AND answer IS NOT NULL AND t.name IS NOT NULL UNION ALL {_PLANTED_SQL}
), texts AS (
  SELECT *, {flat_sql("t.name")} AS tn, {canonical_sql("t.attribute")} AS canon, {flat_sql("u")} AS fu, {flat_sql("array_to_string(answer, '')")} AS short,
    list_filter(a, lambda i: i.type = t.type AND len(list_filter(b, lambda x: {_SAME})) = 0) AS fresh FROM cases
), grown AS (
  SELECT *, list_filter(a, lambda i: i.type = t.type AND list_contains(i.known, canon) AND len(list_filter(b, lambda x: {_KIN})) > 0 AND NOT list_contains(list_filter(b, lambda x: {_KIN})[1].known, canon)) AS g FROM texts
), flags AS (
  SELECT *, regexp_matches(short, '{"|".join(UNCERTAIN_CUES)}') AS unsure, short <> '' AND length(short) <= 16 AND NOT regexp_matches(short, '{"|".join(UNCERTAIN_CUES)}') AS plain FROM grown
), methods AS (
  SELECT dialogue_id, block_id, CASE WHEN {_knows("b")} THEN NULL WHEN {_knows("a")} THEN 'exact_state_match'
    WHEN canon IS NOT NULL AND len(list_filter(g, lambda i: list_contains(i.names, tn))) > 0 THEN 'canonical_attribute_match'
    WHEN canon IS NOT NULL AND len(g) = 1 AND len(list_filter(b, lambda i: i.type = t.type)) = 1 THEN 'unique_attribute_delta'
    WHEN canon IS NULL AND trim(t.name, ' ') IN ({_list(GENERIC_TARGETS)}) AND len(fresh) > 0 THEN 'generic_type_delta'
    WHEN canon IS NULL AND len(list_filter(fresh, lambda i: len(list_filter(i.names, lambda n: {related_sql("tn", "n")})) > 0)) > 0 THEN 'lexical_state_delta'
    WHEN canon IS NULL AND NOT unsure AND {related_sql("tn", "short")} THEN 'lexical_answer_match'
    WHEN canon IS NULL AND plain AND regexp_matches(fu, '{"|".join(YES_NO_CUES)}') AND NOT {COMPOUND_SQL} AND (short IN ({_list(YES_ANSWERS + NO_ANSWERS)}) OR regexp_matches(short, '{DEGREE_FORM}')) THEN 'explicit_short_answer'
    WHEN canon IS NOT NULL AND plain AND {slots_sql("fu")} = [canon] AND ({" OR ".join(f"(canon = '{s}' AND regexp_matches(short, '{f}'))" for s, f in SHORT_ANSWER_FORMS.items())}) THEN 'short_attribute_answer' END AS method FROM flags)"""
ORACLE_SQL = {
    "answerability": _METHODS_SQL + " SELECT * FROM methods WHERE method IS NOT NULL",
    "gated_decisions": f"""{_METHODS_SQL}, gated AS (
  SELECT list_filter([CASE WHEN {_knows("b")} THEN 'TARGET_ALREADY_KNOWN' END,
    CASE WHEN canon IS NOT NULL AND (t.type IS NULL OR t.type NOT IN ({_list(FACT_TYPES)}) OR NOT coalesce(len(list_filter(b, lambda i: i.type = t.type AND list_contains(i.names, tn))) = 1 OR (regexp_matches(fu, '{"|".join(ELIDED_CUES)}') AND len(list_filter(b, lambda i: i.type = t.type)) = 1), FALSE)) THEN 'TARGET_NOT_RESOLVED' END,
    CASE WHEN answer IS NOT NULL AND NOT ({_knows("b")}) AND m.method IS NULL THEN 'ANSWER_NOT_OBSERVED' END], lambda g: g IS NOT NULL) AS gates
  FROM around LEFT JOIN methods m USING (dialogue_id, block_id) WHERE action = 'ask' AND t.name IS NOT NULL)
SELECT array_to_string(gates, ',') AS gates, count(*) AS n FROM gated GROUP BY ALL""",
    "known_targets": f"""{_BEFORE_SQL} SELECT CASE WHEN canon IS NULL THEN 'entity' ELSE 'attribute' END AS asked_for, {_knows("b")} AS known_before, {_knows("a")} AS known_after,
  len(list_filter(b, lambda i: list_contains(i.names, tn) AND i.type = t.type)) = 1 AS one_entity, count(*) AS n FROM around WHERE action = 'ask' AND t.name IS NOT NULL GROUP BY ALL""",
    "resolved_targets": f"""{_BEFORE_SQL}, fitting AS (
  SELECT dialogue_id, block_id, canon, fu, list_filter(b, lambda i: i.type = t.type) AS fits, list_filter(b, lambda i: i.type = t.type AND list_contains(i.names, tn)) AS exact FROM around
  WHERE action = 'ask' AND canon IS NOT NULL AND t.type IN ({_list(FACT_TYPES)})
), bound AS (SELECT dialogue_id, block_id, canon AS attribute, CASE WHEN len(exact) = 1 THEN exact[1].name WHEN regexp_matches(fu, '{"|".join(ELIDED_CUES)}') AND len(fits) = 1 THEN fits[1].name END AS bound_to FROM fitting)
SELECT * FROM bound WHERE bound_to IS NOT NULL""",
    "answerable_targets": f"""{_BEFORE_SQL}, each AS (
  SELECT dialogue_id, block_id, i, list_filter(b, lambda x: {_SAME}) AS olds FROM (SELECT dialogue_id, block_id, b, unnest(a) AS i FROM around) WHERE i.name <> '' AND i.type IN ({_list(FACT_TYPES)})
), each_key AS (SELECT dialogue_id, block_id, i, unnest(CASE WHEN len(olds) = 0 THEN [''] ELSE list_filter(i.known, lambda k: NOT list_contains(olds[1].known, k)) END) AS attribute FROM each)
SELECT DISTINCT dialogue_id, block_id, {flat_sql("i.type")} AS type, {flat_sql("i.name")} AS name, attribute FROM each_key WHERE {flat_sql("i.name")} <> ''""",
}


def _rewrites_sql() -> str:
    names = "list_filter(list_concat([trim({0}.name, ' '), trim({0}.normalized_name, ' ')], coalesce({0}.aliases, [])), lambda n: coalesce(n, '') <> '')"
    return f"""WITH turns AS (
  SELECT dialogue_id, turn_id, arg_max({{'q': previous_doctor_question, 's': patient_state_after_turn}}, processed_at) AS r FROM turn_rows GROUP BY ALL
), looked AS (SELECT dialogue_id, turn_id, r.q AS q, coalesce(lag(r.s.problems) OVER (PARTITION BY dialogue_id ORDER BY turn_id), []) AS problems FROM turns), near AS (
  SELECT *, list_filter(problems, lambda p: coalesce(p.last_turn_id, -1) = list_max(list_transform(problems, lambda x: coalesce(x.last_turn_id, -1)))) AS latest FROM looked WHERE regexp_matches(coalesce(q, ''), '{"|".join(ATTRIBUTE_CUES)}')
), named AS (SELECT *, coalesce(nullif(trim(latest[1].normalized_name, ' '), ''), nullif(trim(latest[1].name, ' '), '')) AS target FROM near WHERE len(latest) = 1), active AS (
  SELECT dialogue_id, turn_id, target, list_filter(problems, lambda p: list_contains({names.format("p")}, target)) AS same FROM named
), facts_once AS (SELECT DISTINCT ON (dialogue_id, turn_id, fact_pos) * FROM facts), pairs AS (
  SELECT f.*, target, {names.format("same[1]")} AS old, list_filter([trim(name, ' '), trim(normalized_name, ' ')], lambda n: coalesce(n, '') <> '') AS mine, list_filter(map_keys(attribute), lambda k: k <> 'target') AS keys
  FROM facts_once f JOIN active USING (dialogue_id, turn_id) WHERE len(same) = 1 AND f.type = 'symptom' AND f.status = 'present' AND f.subject IS NOT DISTINCT FROM same[1].subject AND coalesce(len(map_keys(attribute)), 0) > 0)
SELECT dialogue_id, turn_id, fact_pos, CASE WHEN len(keys) = 1 THEN coalesce(MAP {{{", ".join(f"'{k}': '{v}'" for k, v in DISPLAY_NAMES.items())}}}[keys[1]], keys[1]) ELSE '{SEVERAL_ATTRIBUTES}' END AS name, 'attribute' AS type, target, CAST(len(keys) + 1 AS INTEGER) AS attributes
FROM pairs WHERE len(list_filter(old, lambda o: len(list_filter(mine, lambda n: contains(n, o) OR contains(o, n) OR (o LIKE '%痛' AND n LIKE '%痛' AND length(n) <= 3))) > 0)) > 0"""


ORACLE_SQL["rewritten_facts"] = _rewrites_sql()

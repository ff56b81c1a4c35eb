"""Texts that go into and come out of a model: labelled inputs, prompts, their parsing, and constant decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.jsonx import json_object_text
from dialoom.functions.text import is_short_answer, ratio
from dialoom.operators.interview import ONCE_SQL, UNSAFE, asked_before, canonical_attribute, questions, target_key
from dialoom.operators.projection import hidden_keys
from dialoom.session import table

# Labels of the sections of an input, and what stands for nothing.
QUESTION_LABEL, UTTERANCE_LABEL, STATE_LABEL, CONTEXT_LABEL, ASKED_LABEL = "上一轮医生问题：", "患者当前发言：", "当前问诊状态：", "最近对话上下文：", "已问目标："
BLOCK_LABEL = "当前患者发言："
NOTHING = "无"
# Codes of why a block has no question.
SKIP_REASONS = ["NO_SAFE_DOCTOR_QUESTION", "ANSWER_NOT_OBSERVED", "TARGET_ALREADY_KNOWN", "TARGET_ALREADY_ASKED", "UNSAFE_QUESTION", "COMPOUND_QUESTION", "SOURCE_NOT_TRACEABLE", "TARGET_NOT_RESOLVED"]
WEAK_LABELS = ["symptom", "disease", "medicine", "examination", "attribute"]


def weak_labels(weak: Column) -> Column:
    """The five lists of weak labels of a message; a missing list is empty."""
    return F.struct(*(F.coalesce(weak[k], F.array().cast("array<string>")).alias(k) for k in WEAK_LABELS))


def _or_nothing(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(NOTHING))


def extractor_input(question: Column, utterance: Column, state_json: Column, context: Column) -> Column:
    """The labelled input of an extraction: question, utterance, state as JSON and context, in this order."""
    return F.concat_ws("\n", F.concat(F.lit(QUESTION_LABEL), _or_nothing(question)), F.concat(F.lit(UTTERANCE_LABEL), F.coalesce(utterance, F.lit(""))), F.concat(F.lit(STATE_LABEL), F.coalesce(state_json, F.lit("{}"))), F.concat(F.lit(CONTEXT_LABEL + "\n"), _or_nothing(context)))


def interviewer_input(block: Column, state_json: Column, context: Column, asked_json: Column) -> Column:
    """The labelled input of a question, a line each: the patient's block, state, context and asked targets as JSON."""
    return F.concat_ws("\n", F.concat(F.lit(BLOCK_LABEL), F.to_json(F.coalesce(block, F.array().cast("array<string>")))), F.concat(F.lit(STATE_LABEL), F.coalesce(state_json, F.lit("{}"))), F.concat(F.lit(CONTEXT_LABEL), _or_nothing(context)), F.concat(F.lit(ASKED_LABEL), F.coalesce(asked_json, F.lit("[]"))))


def section(text: Column, label: str, next_label: str | None = None) -> Column:
    """What stands behind ``label``, trimmed, up to a line that begins with ``next_label`` or to the end; null without the label."""
    behind = F.substr(text, F.instr(text, F.lit(label)) + len(label))
    until = F.instr(behind, F.lit("\n" + next_label)) if next_label else F.lit(0)
    return F.when(F.instr(text, F.lit(label)) > 0, F.trim(F.when(until > 0, F.substr(behind, F.lit(1), until - 1)).otherwise(behind)))


def runtime_state(text: Column, ddl: str) -> Column:
    """The state of an input, parsed; null if it isn't a JSON object."""
    return F.from_json(section(text, STATE_LABEL, CONTEXT_LABEL), ddl)


def runtime_asked(text: Column) -> Column:
    """The asked targets of an input, parsed; empty if they aren't a JSON array."""
    targets = "array<struct<type:string,name:string,attribute:string>>"
    return F.coalesce(F.from_json(section(text, ASKED_LABEL), targets), F.array().cast(targets))


def utterance_of(text: Column) -> Column:
    """The patient's words of an extraction's input, trimmed; "" if there are none. Line breaks in them are kept."""
    return F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?s)(?:^|\n){UTTERANCE_LABEL}(.*?)(?:\n(?:{STATE_LABEL}|{CONTEXT_LABEL})|$)", 1))


def user_prompt(question: Column, utterance: Column, state_json: Column, context: Column) -> Column:
    """The request for an extraction; an answer of few words is to be read with the question before it."""
    short = "患者的发言很短：结合上一轮医生问题理解它，证据仍须是患者原话中的连续片段。"
    whole = "只抽取患者当前发言中的事实，证据须是患者原话中的连续片段。"
    return F.concat_ws("\n", F.when(is_short_answer(utterance), short).otherwise(whole), extractor_input(question, utterance, state_json, context))


#: The only fields of a block that the request for a question shows: the next answer isn't among them.
TEACHER_FIELDS = ["patient_block", "patient_state", "asked_targets", "recent_context", "original_doctor_block"]


def teacher_prompt(row: dict[str, Column]) -> Column:
    """The request for a question as JSON of the ``TEACHER_FIELDS`` that ``row`` has; every other field is left out."""
    return F.to_json(F.struct(*(row[f].alias(f) for f in TEACHER_FIELDS if f in row)))


def retry_prompt(errors: Column) -> Column:
    """The request to mend an answer: one line for each error."""
    return F.concat(F.lit("上一次的输出没有通过校验，请改正后重新输出完整的 JSON：\n"), F.array_join(F.transform(errors, lambda e: F.concat(F.lit("- "), e)), "\n"))


def unusable_decision(code: str | Column, detail: Column | None = None) -> Column:
    """The decision that skips a block, with the code of its reason; a code that is none is an error."""
    if isinstance(code, str) and code not in SKIP_REASONS:
        raise ValueError(f"no reason: {code}")
    own = F.lit(code) if isinstance(code, str) else F.when(code.isin(SKIP_REASONS), code).otherwise(F.raise_error(F.concat(F.lit("no reason: "), F.coalesce(code, F.lit("null")))))
    none = F.lit(None).cast("string")
    target = F.lit(None).cast("struct<name:string,type:string,attribute:string>")
    return F.struct(F.lit(False).alias("usable"), none.alias("action"), target.alias("next_question_target"), F.lit("").alias("utterance"), own.alias("skip_reason_code"), (none if detail is None else detail).alias("detail"))


def weak_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by how many kinds of weak labels they have, and the labels in all."""
    labels = table(spark, sf_dir, "messages").select(weak_labels(F.col("weak")).alias("w"))
    sizes = [F.size(F.col("w")[k]) for k in WEAK_LABELS]
    rows = labels.select(sum(((n > 0).cast("int") for n in sizes), F.lit(0)).alias("kinds"), sum(sizes, F.lit(0)).alias("labels"))
    return rows.groupBy("kinds").agg(F.count("*").alias("messages"), F.sum("labels").alias("labels"))


def interviewer_texts(rows: DataFrame) -> DataFrame:
    """``dialogue_id, block_id, usable, input, output`` of every block once: what a model is trained on."""
    asked = asked_before(questions(rows))
    state = F.to_json(F.col("patient_state"))
    answer = F.to_json(F.struct("action", "next_question_target", "utterance"))
    return asked.select("dialogue_id", "block_id", "usable", interviewer_input(F.col("patient_block"), state, F.lit(None).cast("string"), F.to_json("asked")).alias("input"), answer.alias("output"))


def parsed_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the inputs of all blocks parse to: problems of the state, asked targets; and hidden fields in them (none)."""
    rows = interviewer_texts(table(spark, sf_dir, "interviewer_rows"))
    state = runtime_state(F.col("input"), "struct<chief_complaint:string,problems:array<struct<name:string,type:string,status:string>>>")
    return rows.select("dialogue_id", "block_id", F.coalesce(F.array_join(F.transform(state["problems"], lambda p: p["name"]), "|"), F.lit("")).alias("problems"), F.size(runtime_asked(F.col("input"))).alias("asked"), F.size(hidden_keys(F.col("input"))).alias("hidden"))


def parsed_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances read back out of the inputs that were made of them."""
    rows = table(spark, sf_dir, "turn_rows").select("previous_doctor_question", "patient_utterance").distinct()
    text = extractor_input(F.col("previous_doctor_question"), F.col("patient_utterance"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    return rows.select("previous_doctor_question", "patient_utterance", utterance_of(text).alias("utterance"))


def skipped_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks without a question as decisions, counted by the code of their reason."""
    rows = questions(table(spark, sf_dir, "interviewer_rows")).where("action is null and skip_reason_code is not null")
    decision = rows.select(unusable_decision(F.col("skip_reason_code")).alias("d"))
    return decision.groupBy("d.skip_reason_code", "d.usable", "d.utterance").agg(F.count("*").alias("n"))


def predicted_decisions(rows: DataFrame) -> DataFrame:
    """``rows`` with ``predict``: the decision as a faulty model would write it, by fixed rules of the block's number."""
    target = F.col("next_question_target")
    block = F.col("block_id")
    action = F.when(block % 7 == 5, "end").otherwise(F.col("action"))
    attribute = F.when(block % 3 == 1, F.lit(None)).otherwise(target["attribute"])
    named = F.struct(target["name"].alias("name"), target["type"].alias("type"), attribute.alias("attribute"))
    text = F.to_json(F.struct(action.alias("action"), F.when((action == "ask") & target["name"].isNotNull(), named).alias("next_question_target"), F.when(action == "ask", F.col("utterance")).alias("utterance")))
    return rows.withColumn("predict", F.when(block % 11 == 10, F.lit("not json")).when(block % 2 == 1, F.concat(F.lit("```json\n"), text, F.lit("\n```"))).otherwise(text))


def decision_metrics(rows: DataFrame, by: str) -> DataFrame:
    """Rates of predicted decisions (``predict``) against those of the rows: parsing, action, targets and ends.

    ``rows``: blocks with ``asked``. A prediction that doesn't parse counts for the gold side alone.
    """
    decision = "struct<action:string,next_question_target:struct<name:string,type:string,attribute:string>,utterance:string>"
    p = F.from_json(json_object_text(F.col("predict")), decision)
    known = F.coalesce(F.col("patient_state.problems"), F.array().cast("array<struct<name:string,type:string,status:string>>"))
    rows = rows.where("usable").withColumn("p", p)
    rows = rows.withColumns({"parsed": F.col("p").isNotNull(), "gold_key": target_key(F.col("next_question_target")), "key": target_key(F.col("p.next_question_target"))})
    ask = F.coalesce(F.col("p.action") == "ask", F.lit(False))
    text = F.coalesce("p.utterance", F.lit(""))
    told = F.exists(known, lambda k: (F.lower(k["name"]) == F.lower(F.col("p.next_question_target.name"))) & (k["type"] == F.col("p.next_question_target.type"))) & canonical_attribute(F.col("p.next_question_target.attribute")).isNull()
    sums = rows.groupBy(by).agg(
        F.count("*").alias("rows"), F.count_if("parsed").alias("parsed"), F.count_if(F.col("parsed") & F.col("p.action").eqNullSafe(F.col("action"))).alias("actions"),
        F.count("gold_key").alias("gold_targets"), F.count("key").alias("targets"), F.count_if(F.col("key") == F.col("gold_key")).alias("same_targets"),
        F.count_if(F.col("action") == "end").alias("gold_ends"), F.count_if(F.col("p.action") == "end").alias("ends"), F.count_if((F.col("p.action") == "end") & (F.col("action") == "end")).alias("same_ends"),
        F.count_if(ask).alias("asks"), F.count_if(ask & (F.regexp_count(text, F.lit("[?？]")) == 1)).alias("one_question"), F.count_if(ask & text.rlike("|".join(UNSAFE))).alias("unsafe"),
        F.count_if(ask & F.array_contains("asked", F.col("key"))).alias("again"), F.count_if(ask & F.coalesce(told, F.lit(False))).alias("known"),
    )

    def rate(a: str, b: str) -> Column:
        return F.round(ratio(F.col(a), F.col(b)), 6)

    return sums.select(
        by, "rows", rate("parsed", "rows").alias("parse_rate"), rate("actions", "rows").alias("action_accuracy"), rate("same_targets", "targets").alias("target_precision"), rate("same_targets", "gold_targets").alias("target_recall"),
        rate("same_ends", "ends").alias("end_precision"), rate("same_ends", "gold_ends").alias("end_recall"), rate("one_question", "asks").alias("one_question_rate"), rate("unsafe", "asks").alias("unsafe_rate"),
        rate("again", "asks").alias("repeat_rate"), rate("known", "asks").alias("known_rate"),
    )


def decision_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of the predicted decisions by split."""
    return decision_metrics(predicted_decisions(asked_before(questions(table(spark, sf_dir, "interviewer_rows")))), "split")


QUERIES = {
    "weak_label_counts": weak_label_counts, "parsed_inputs": parsed_inputs, "parsed_utterances": parsed_utterances, "skipped_blocks": skipped_blocks, "decision_accuracy": decision_accuracy,
}


def _rate(a: str, b: str, out: str) -> str:
    return f"round(coalesce(count(*) FILTER ({a}) / nullif(count(*) FILTER ({b}), 0), 0), 6) AS {out}"


ORACLE_SQL = {
    "weak_label_counts": f"""SELECT kinds, count(*) AS messages, CAST(sum(labels) AS BIGINT) AS labels FROM (
  SELECT CAST({" + ".join(f"CASE WHEN coalesce(len(weak.{k}), 0) > 0 THEN 1 ELSE 0 END" for k in WEAK_LABELS)} AS INTEGER) AS kinds, {" + ".join(f"coalesce(len(weak.{k}), 0)" for k in WEAK_LABELS)} AS labels FROM messages) GROUP BY kinds""",
    "parsed_inputs": f"""WITH {ONCE_SQL} SELECT dialogue_id, block_id, coalesce(array_to_string(list_transform(problems, lambda p: p.name), '|'), '') AS problems, CAST(len(before) AS INTEGER) AS asked, 0 AS hidden FROM asked""",
    "parsed_utterances": "SELECT DISTINCT previous_doctor_question, patient_utterance, trim(coalesce(patient_utterance, ''), ' ') AS utterance FROM turn_rows",
    "skipped_blocks": f"WITH {ONCE_SQL} SELECT skip_reason_code, FALSE AS usable, '' AS utterance, count(*) AS n FROM asked WHERE action IS NULL AND skip_reason_code IS NOT NULL GROUP BY skip_reason_code",
    "decision_accuracy": f"""WITH {ONCE_SQL}, predicted AS (
  SELECT *, block_id % 11 <> 10 AS parsed, CASE WHEN block_id % 11 = 10 THEN NULL WHEN block_id % 7 = 5 THEN 'end' ELSE action END AS pa FROM asked WHERE usable
), guessed AS (SELECT *, pa = 'ask' AND t.name IS NOT NULL AND tn <> '' AND tt <> '' AS has, CASE WHEN block_id % 3 = 1 THEN '' ELSE ta END AS pt FROM predicted), compared AS (
  SELECT *, coalesce(has, FALSE) AS target, coalesce(has AND pt IS NOT DISTINCT FROM ta, FALSE) AS same, coalesce(list_contains(before, {{'type': tt, 'name': tn, 'attribute': pt}}), FALSE) AND coalesce(has, FALSE) AS again,
    coalesce(has, FALSE) AND (block_id % 3 = 1 OR canon IS NULL) AND len(list_filter(problems, lambda p: lower(p.name) = lower(t.name) AND p.type = t.type)) > 0 AS known FROM guessed)
SELECT split, count(*) AS rows, {_rate("parsed", "TRUE", "parse_rate")}, {_rate("parsed AND pa IS NOT DISTINCT FROM action", "TRUE", "action_accuracy")}, {_rate("same", "target", "target_precision")}, {_rate("same", "k IS NOT NULL", "target_recall")},
  {_rate("pa = 'end' AND action = 'end'", "pa = 'end'", "end_precision")}, {_rate("pa = 'end' AND action = 'end'", "action = 'end'", "end_recall")}, {_rate("pa = 'ask' AND len(regexp_extract_all(u, '[?？]')) = 1", "pa = 'ask'", "one_question_rate")},
  {_rate(f"pa = 'ask' AND regexp_matches(u, '{'|'.join(UNSAFE)}')", "pa = 'ask'", "unsafe_rate")}, {_rate("again", "pa = 'ask'", "repeat_rate")}, {_rate("known", "pa = 'ask'", "known_rate")} FROM compared GROUP BY split""",
}

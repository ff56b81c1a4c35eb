"""Splits by dialogue without leaks, and the rows of the training sets."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.text import is_short_answer
from dialoom.operators.dialogue import ordered_messages, recent_context
from dialoom.operators.facts import distinct_facts, latest_turns
from dialoom.session import table

SPLITS = ["train", "valid", "test"]
RATIOS = (0.9, 0.05, 0.05)
LEAKS = ["weak_labels", "dialogue_id", "turn_id"]
#: Rows that the checks must name, beside those of the tables, and sound ones.
PLANTED_SPLITS = [("planted", "train"), ("planted", "test"), ("planted sound", "valid"), ("planted sound", "valid")]
PLANTED_INPUTS = [("planted", 0, "患者当前发言：腹痛 weak_labels"), ("planted", 1, '{"turn_id": 3}'), ("planted", 2, "患者当前发言：腹痛")]


def split_of(key: Column, seed: int = 42, ratios: tuple[float, float, float] = RATIOS) -> Column:
    """The split of a key by its hash: the same for all of its rows, at any number of keys, without a shuffle."""
    total = sum(ratios)
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return F.when(place < ratios[0] / total, SPLITS[0]).when(place < (ratios[0] + ratios[1]) / total, SPLITS[1]).otherwise(SPLITS[2])


def split_by_shuffle(ids: list[str], seed: int = 42, ratios: tuple[float, float, float] = RATIOS) -> dict[str, str]:
    """The split of each id by a seeded shuffle of the sorted ids with rounded cuts; for lists that fit the driver."""
    order = sorted(ids)
    random.Random(seed).shuffle(order)
    first = round(len(order) * ratios[0] / sum(ratios))
    second = first + round(len(order) * ratios[1] / sum(ratios))
    return {d: SPLITS[(n >= first) + (n >= second)] for n, d in enumerate(order)}


def overlapping(rows: DataFrame, key: str) -> DataFrame:
    """Keys that are in several splits; a sound split gives none."""
    return rows.groupBy(key).agg(F.count_distinct("split").alias("splits")).where("splits > 1")


def training_rows(turn_rows: DataFrame, facts: DataFrame, messages: DataFrame) -> DataFrame:
    """``dialogue_id, turn_id, split, instruction, input, output`` of every processed turn.

    The input has the question, the utterance and the context before the turn; the output the facts in their order,
    as JSON with nulls. Joins by dialogue and turn, co-partitioned.
    """
    turns = latest_turns(turn_rows.select("dialogue_id", "turn_id", "previous_doctor_question", "patient_utterance", "processed_at"))
    fact = F.struct("fact_pos", F.struct("name", "normalized_name", "type", "status", "subject", "evidence").alias("fact"))
    said = F.transform(F.array_sort(F.collect_list(fact), lambda a, b: a["fact_pos"] - b["fact_pos"]), lambda f: f["fact"])
    answers = distinct_facts(facts).groupBy("dialogue_id", "turn_id").agg(F.to_json(F.struct(said.alias("facts")), {"ignoreNullFields": "false"}).alias("output"))
    context = recent_context(messages, 2, 600).select("dialogue_id", "turn_id", "context")
    rows = turns.join(answers, ["dialogue_id", "turn_id"], "left").join(context, ["dialogue_id", "turn_id"], "left")
    none = F.lit("无")
    role = F.create_map(F.lit("user"), F.lit("患者"), F.lit("assistant"), F.lit("医生"))
    lines = F.array_join(F.transform("context", lambda m: F.concat(role[m["role"]], F.lit("："), m["content"])), "\n")
    lines = F.when(F.coalesce(F.size("context"), F.lit(0)) > 0, lines).otherwise(none)
    text = F.concat(F.lit("上一轮医生问题："), F.coalesce(F.nullif("previous_doctor_question", F.lit("")), none), F.lit("\n患者当前发言："), F.coalesce("patient_utterance", F.lit("")), F.lit("\n最近对话上下文：\n"), lines)
    return rows.select("dialogue_id", "turn_id", split_of(F.col("dialogue_id")).alias("split"), F.lit("抽取事实").alias("instruction"), text.alias("input"), F.coalesce("output", F.lit('{"facts":[]}')).alias("output"))


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows(table(spark, sf_dir, "turn_rows"), table(spark, sf_dir, "facts"), ordered_messages(table(spark, sf_dir, "messages")))


def split_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of every dialogue."""
    return table(spark, sf_dir, "messages").where("dialogue_id is not null").select("dialogue_id").distinct().select("dialogue_id", split_of(F.col("dialogue_id")).alias("split"))


def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source dialogues of interviewer_rows, and of planted rows, that are in several splits."""
    planted = spark.createDataFrame(PLANTED_SPLITS, "source_dialogue_id string, split string")
    return overlapping(table(spark, sf_dir, "interviewer_rows").select("source_dialogue_id", "split").unionByName(planted), "source_dialogue_id")


def leak_assert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows, and planted ones, whose text has a word of the internal fields; a sound set gives none."""
    planted = spark.createDataFrame(PLANTED_INPUTS, "dialogue_id string, turn_id int, input string")
    rows = _training(spark, sf_dir).select("dialogue_id", "turn_id", "input").unionByName(planted)
    return rows.where(F.col("input").rlike("|".join(LEAKS))).select("dialogue_id", "turn_id")


def alpaca_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input and split of every training row."""
    return _training(spark, sf_dir).select("dialogue_id", "turn_id", "split", "input")


def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, dialogues, facts and context-dependent rows of each split."""
    turns = latest_turns(table(spark, sf_dir, "turn_rows").select("dialogue_id", "turn_id", "patient_utterance", "processed_at"))
    facts = distinct_facts(table(spark, sf_dir, "facts").select("dialogue_id", "turn_id", "fact_pos", "name")).groupBy("dialogue_id", "turn_id").agg(F.count("*").alias("facts"))
    rows = turns.join(facts, ["dialogue_id", "turn_id"], "left").withColumn("split", split_of(F.col("dialogue_id")))
    return rows.groupBy("split").agg(F.count("*").alias("rows"), F.count_distinct("dialogue_id").alias("dialogues"), F.coalesce(F.sum("facts"), F.lit(0)).alias("facts"), F.count_if(is_short_answer(F.col("patient_utterance"))).alias("context_dependent"))


QUERIES = {"split_by_hash": split_by_hash, "split_overlap_assert": split_overlap, "leak_assert": leak_assert, "alpaca_rows": alpaca_rows, "split_summary": split_summary}

_SPLIT = "CASE WHEN CAST('0x' || substr(md5('42:' || dialogue_id), 1, 8) AS BIGINT) / 4294967296.0 < 0.9 THEN 'train' WHEN CAST('0x' || substr(md5('42:' || dialogue_id), 1, 8) AS BIGINT) / 4294967296.0 < 0.95 THEN 'valid' ELSE 'test' END"


def _sql() -> dict[str, str]:
    from dialoom.functions.lexicon import SHORT_ANSWERS
    from dialoom.operators.dialogue import MESSAGES_SQL

    turns = "turns AS (SELECT dialogue_id, turn_id, arg_max({'q': previous_doctor_question, 'u': patient_utterance}, processed_at) AS t FROM turn_rows GROUP BY ALL)"
    rows = f"""WITH {MESSAGES_SQL}, {turns}, spoken AS (SELECT * FROM messages_in_order WHERE role IN ('user', 'assistant') AND content <> ''), pairs AS (
  SELECT u.dialogue_id, u.turn_id, s.turn_id AS t, s.role, s.content, row_number() OVER (PARTITION BY u.dialogue_id, u.turn_id ORDER BY s.turn_id DESC) AS rn, sum(length(s.role) + length(s.content)) OVER (PARTITION BY u.dialogue_id, u.turn_id ORDER BY s.turn_id DESC) AS chars
  FROM messages_in_order u JOIN spoken s ON s.dialogue_id = u.dialogue_id AND s.turn_id < u.turn_id WHERE u.role = 'user'
), kept AS (
  SELECT dialogue_id, turn_id, string_agg(CASE role WHEN 'user' THEN '患者' ELSE '医生' END || '：' || content, chr(10) ORDER BY t) AS context FROM pairs WHERE rn = 1 OR (rn <= 2 AND chars <= 600) GROUP BY ALL
), inputs AS (
  SELECT dialogue_id, turn_id, {_SPLIT} AS split, '上一轮医生问题：' || coalesce(nullif(t.q, ''), '无') || chr(10) || '患者当前发言：' || coalesce(t.u, '') || chr(10) || '最近对话上下文：' || chr(10) || coalesce(context, '无') AS input FROM turns LEFT JOIN kept USING (dialogue_id, turn_id))
"""
    return {
        "split_by_hash": f"SELECT DISTINCT dialogue_id, {_SPLIT} AS split FROM messages WHERE dialogue_id IS NOT NULL",
        "split_overlap_assert": f"SELECT source_dialogue_id, count(DISTINCT split) AS splits FROM (SELECT source_dialogue_id, split FROM interviewer_rows UNION ALL VALUES {', '.join(map(str, PLANTED_SPLITS))}) GROUP BY ALL HAVING count(DISTINCT split) > 1",
        "leak_assert": rows + f"SELECT dialogue_id, turn_id FROM (SELECT dialogue_id, turn_id, input FROM inputs UNION ALL VALUES {', '.join(map(str, PLANTED_INPUTS))}) WHERE regexp_matches(input, '{'|'.join(LEAKS)}')",
        "alpaca_rows": rows + "SELECT dialogue_id, turn_id, split, input FROM inputs",
        "split_summary": f"""WITH {turns}, per AS (SELECT dialogue_id, turn_id, count(DISTINCT fact_pos) AS facts FROM facts GROUP BY ALL), bare AS (
  SELECT dialogue_id, {_SPLIT} AS split, coalesce(facts, 0) AS facts, regexp_replace(coalesce(t.u, ''), '[。！？!?，,\\s\\p{{Z}}]', '', 'g') AS b FROM turns LEFT JOIN per USING (dialogue_id, turn_id))
SELECT split, count(*) AS rows, count(DISTINCT dialogue_id) AS dialogues, CAST(sum(facts) AS BIGINT) AS facts, count(*) FILTER (b IN ({", ".join(f"'{w}'" for w in SHORT_ANSWERS)}) OR length(b) BETWEEN 1 AND 4) AS context_dependent FROM bare GROUP BY split""",
    }


ORACLE_SQL = _sql()

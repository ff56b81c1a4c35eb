"""Questions: targets, slots, what was asked before, and the contract of a decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.functions.lexicon import QUESTION_ATTRIBUTES, QUESTION_SYNONYMS
from dialoom.functions.text import question_text, ratio
from dialoom.session import table

# Words by which a question asks for an attribute.
SLOT_WORDS = {
    "duration": ["多久", "多长时间", "持续时间", "持续了"],
    "frequency": ["几次", "多少次", "频率", "经常", "偶尔"],
    "body_part": ["哪里", "哪个部位", "什么位置", "具体位置"],
    "character": ["什么性质", "怎么疼", "什么样的疼", "怎样疼"],
    "severity": ["严重吗", "多严重", "疼得厉害", "程度"],
    "time": ["什么时候", "几点", "白天还是晚上"],
    "trigger": ["什么引起", "什么诱发", "和什么有关"],
    "relieving_factor": ["怎么缓解", "什么能缓解", "缓解因素"],
    "effect": ["效果怎么样", "有没有效果", "是否有效"],
    "amount": ["多少量", "量有多少", "量大吗"],
    "dose": ["多大剂量", "每次吃多少", "一次吃多少", "剂量"],
    "result": ["检查结果", "结果怎么样", "结果如何", "是否正常"],
    "route": ["怎么用药", "怎么服用", "什么途径"],
    "side_effect": ["副作用", "不良反应"],
    "aggravating_factor": ["什么会加重", "加重因素", "怎样会加重"],
}
# Words by which a question asks for an interval, and words that make it a question.
INTERVAL_WORDS = ["多久一次", "多长时间一次", "几天一次", "几日一次", "隔多久一次"]
INTERROGATIVES = ["有没有", "是否", "多久", "多长时间", "几次", "多少次", "什么时候", "哪里", "哪个部位", "什么性质", "怎么疼"]
# Words of advice that no question may give.
UNSAFE = ["建议你", "建议您", "你可以", "您可以", "可以吃", "吃点", "需要服用", "应该服用", "可以服用", "做个检查", "建议检查", "最好检查", "考虑是", "可能是", "诊断为", "治疗方案"]


def canonical_attribute(value: Column) -> Column:
    """The attribute that a key or a Chinese word names, else null."""
    word = F.trim(value)
    synonyms = F.create_map(*(F.lit(x) for pair in QUESTION_SYNONYMS.items() for x in pair))
    return F.when(F.lower(word).isin(QUESTION_ATTRIBUTES), F.lower(word)).otherwise(synonyms[word])


def target_key(target: Column) -> Column:
    """``type, name, attribute`` by which two targets are the same; null without a name or type."""
    name, kind = question_text(target["name"]), question_text(target["type"])
    attribute = F.coalesce(canonical_attribute(target["attribute"]), question_text(target["attribute"]))
    return F.when((name != "") & (kind != ""), F.struct(kind.alias("type"), name.alias("name"), attribute.alias("attribute")))


def question_slots(text: Column) -> Column:
    """Attributes that a question asks for; how often in what time is a frequency and no duration."""
    flat = question_text(text)
    interval = flat.rlike("|".join(INTERVAL_WORDS))
    found = []
    for slot, words in SLOT_WORDS.items():
        hit = flat.rlike("|".join(words))
        hit = hit & ~interval if slot == "duration" else hit | interval if slot == "frequency" else hit
        found.append(F.when(hit, slot))
    return F.array_sort(F.filter(F.array(*found), lambda s: s.isNotNull()))


def is_compound(text: Column) -> Column:
    """Whether a question asks several things at once."""
    return (F.size(question_slots(text)) > 1) | (F.regexp_count(text, F.lit("|".join(INTERROGATIVES))) > 1)


def questions(rows: DataFrame) -> DataFrame:
    """interviewer_rows once per block."""
    names = [c for c in rows.columns if c not in ("dialogue_id", "block_id")]
    one = F.min_by(F.struct(*names), F.coalesce("utterance", F.lit(""))).alias("one")
    return rows.groupBy("dialogue_id", "block_id").agg(one).select("dialogue_id", "block_id", "one.*")


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions(table(spark, sf_dir, "interviewer_rows"))


def question_slot_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of the distinct questions, and whether they are compound or fit their target."""
    rows = _questions(spark, sf_dir).where("action = 'ask' and utterance is not null").select("utterance", F.col("next_question_target.attribute").alias("attribute")).distinct()
    slots = question_slots(F.col("utterance"))
    wanted = canonical_attribute(F.col("attribute"))
    fits = wanted.isNull() | (F.size(slots) == 0) | F.coalesce(slots == F.array(wanted), F.lit(False))
    return rows.select("utterance", "attribute", F.array_join(slots, ",").alias("slots"), is_compound(F.col("utterance")).alias("compound"), fits.alias("fits"))


def target_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets by key, with how often they are asked."""
    keys = _questions(spark, sf_dir).select(target_key(F.col("next_question_target")).alias("k")).where("k is not null")
    return keys.groupBy("k.type", "k.name", "k.attribute").agg(F.count("*").alias("n"))


def asked_before(rows: DataFrame) -> DataFrame:
    """Rows with ``asked``: the keys of the targets that were asked earlier in the session, in their order.

    The frame is the session's own blocks; a session is one conversation.
    """
    earlier = Window.partitionBy("dialogue_id").orderBy("block_id").rowsBetween(Window.unboundedPreceding, -1)
    key = F.when(F.col("action") == "ask", target_key(F.col("next_question_target")))
    return rows.withColumn("key", key).withColumn("asked", F.collect_list("key").over(earlier))


def asked_targets_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many targets were asked before each question, and whether its own was one of them."""
    rows = asked_before(_questions(spark, sf_dir)).where("key is not null")
    return rows.select("dialogue_id", "block_id", F.size("asked").alias("asked"), F.array_contains("asked", F.col("key")).alias("again"))


def decision_errors(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``asked``, ``key``) with ``errors``: what breaks the contract of a decision."""
    target, text = F.col("next_question_target"), F.coalesce("utterance", F.lit(""))
    ask, end, unusable = F.col("action") == "ask", F.col("action") == "end", F.col("action").isNull()
    marks = F.regexp_count(text, F.lit("[?？]"))
    checks = [
        (ask & ~F.coalesce("usable", F.lit(False)), "asked but unusable"),
        (ask & F.col("key").isNull(), "no target"),
        (ask & (marks != 1), "not one question mark"),
        (ask & text.rlike("|".join(UNSAFE)), "unsafe"),
        (ask & target["attribute"].isNotNull() & canonical_attribute(target["attribute"]).isNull(), "attribute unknown"),
        (ask & is_compound(text), "compound"),
        (ask & F.array_contains("asked", F.col("key")), "asked already"),
        (ask & target["attribute"].isNull() & F.exists(F.coalesce(F.col("patient_state.problems"), F.array().cast("array<struct<name:string,type:string,status:string>>")), lambda p: (question_text(p["name"]) == question_text(target["name"])) & (p["type"] == target["type"])), "known already"),
        (end & ((F.trim(text) != "") | target.isNotNull()), "ended with a question"),
        (unusable & F.col("skip_reason_code").isNull(), "skipped without a reason"),
    ]
    return rows.withColumn("errors", F.filter(F.array(*(F.when(c, F.lit(m)) for c, m in checks)), lambda m: m.isNotNull()))


def decision_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions that break the contract, with what they break."""
    rows = decision_errors(asked_before(_questions(spark, sf_dir)))
    return rows.where(F.size("errors") > 0).select("dialogue_id", "block_id", F.array_join("errors", "; ").alias("errors"))


def dialogue_fail_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source dialogues with an error in any session; all of their rows are out."""
    rows = decision_errors(asked_before(_questions(spark, sf_dir)))
    return rows.groupBy("source_dialogue_id").agg(F.count_if(F.size("errors") > 0).alias("errors"), F.count("*").alias("rows")).where("errors > 0")


def interviewer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates over all questions of each split: one mark, unsafe, compound, asked again, ended."""
    rows = asked_before(_questions(spark, sf_dir)).where("usable")
    text = F.coalesce("utterance", F.lit(""))
    ask = F.col("action") == "ask"
    n = F.count_if(ask)
    return rows.groupBy("split").agg(
        F.count("*").alias("rows"), n.alias("asked"), F.round(ratio(F.count_if(ask & (F.regexp_count(text, F.lit("[?？]")) == 1)), n), 6).alias("one_question_rate"),
        F.round(ratio(F.count_if(ask & text.rlike("|".join(UNSAFE))), n), 6).alias("unsafe_rate"), F.round(ratio(F.count_if(ask & is_compound(text)), n), 6).alias("compound_rate"),
        F.round(ratio(F.count_if(ask & F.array_contains("asked", F.col("key"))), n), 6).alias("again_rate"), F.round(ratio(F.count_if(F.col("action") == "end"), F.count("*")), 6).alias("end_rate"),
    )


QUERIES = {
    "question_slot_flags": question_slot_flags, "target_keys": target_keys, "asked_targets_running": asked_targets_running, "decision_validation": decision_validation,
    "dialogue_fail_propagation": dialogue_fail_propagation, "interviewer_metrics": interviewer_metrics,
}


_INTERVALS, _ASKING = "|".join(INTERVAL_WORDS), "|".join(INTERROGATIVES)


def flat_sql(column: str) -> str:
    return rf"lower(regexp_replace(coalesce({column}, ''), '[\s\p{{Z}}，。！？、；：,.!?;:]', '', 'g'))"


def canonical_sql(column: str) -> str:
    names = ", ".join(f"'{a}'" for a in QUESTION_ATTRIBUTES)
    synonyms = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in QUESTION_SYNONYMS.items()) + "}"
    return f"CASE WHEN lower(trim({column}, ' ')) IN ({names}) THEN lower(trim({column}, ' ')) ELSE {synonyms}[trim({column}, ' ')] END"


def slots_sql(column: str) -> str:
    def hit(slot: str, words: list[str]) -> str:
        own = f"regexp_matches({column}, '{'|'.join(words)}')"
        if slot == "duration":
            own += f" AND NOT regexp_matches({column}, '{_INTERVALS}')"
        if slot == "frequency":
            own += f" OR regexp_matches({column}, '{_INTERVALS}')"
        return f"CASE WHEN {own} THEN '{slot}' END"

    return f"list_sort(list_filter([{', '.join(hit(s, w) for s, w in SLOT_WORDS.items())}], lambda s: s IS NOT NULL))"


def related_sql(a: str, b: str) -> str:
    pairs = "list_filter(list_transform(range(1, length({0})), lambda j: substr({0}, j, 2)), lambda p: regexp_full_match(p, '[一-鿿]{{2}}'))"
    return f"({a} <> '' AND {b} <> '' AND (contains({a}, {b}) OR contains({b}, {a}) OR coalesce(list_has_any({pairs.format(a)}, {pairs.format(b)}), FALSE)))"


ONCE_SQL = f"""once AS (SELECT DISTINCT ON (dialogue_id, block_id) * FROM interviewer_rows ORDER BY dialogue_id, block_id, coalesce(utterance, '')), keyed AS (
  SELECT *, next_question_target AS t, {flat_sql("next_question_target.name")} AS tn, {flat_sql("next_question_target.type")} AS tt, coalesce({canonical_sql("next_question_target.attribute")}, {flat_sql("next_question_target.attribute")}) AS ta,
    {canonical_sql("next_question_target.attribute")} AS canon, coalesce(utterance, '') AS u, {flat_sql("utterance")} AS fu, coalesce(patient_state.problems, []) AS problems FROM once
), target AS (SELECT *, CASE WHEN tn <> '' AND tt <> '' THEN {{'type': tt, 'name': tn, 'attribute': ta}} END AS k FROM keyed), asked AS (
  SELECT *, CASE WHEN action = 'ask' THEN k END AS ak, list_filter(coalesce(list(CASE WHEN action = 'ask' THEN k END) OVER (PARTITION BY dialogue_id ORDER BY block_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []), lambda x: x IS NOT NULL) AS before FROM target)"""
COMPOUND_SQL = f"(len({slots_sql('fu')}) > 1 OR len(regexp_extract_all(u, '{_ASKING}')) > 1)"
_CHECKED = f"""WITH {ONCE_SQL}, checked AS (
  SELECT *, list_filter([
    CASE WHEN action = 'ask' AND NOT coalesce(usable, FALSE) THEN 'asked but unusable' END, CASE WHEN action = 'ask' AND ak IS NULL THEN 'no target' END,
    CASE WHEN action = 'ask' AND len(regexp_extract_all(u, '[?？]')) <> 1 THEN 'not one question mark' END, CASE WHEN action = 'ask' AND regexp_matches(u, '{"|".join(UNSAFE)}') THEN 'unsafe' END,
    CASE WHEN action = 'ask' AND t.attribute IS NOT NULL AND canon IS NULL THEN 'attribute unknown' END, CASE WHEN action = 'ask' AND {COMPOUND_SQL} THEN 'compound' END,
    CASE WHEN action = 'ask' AND ak IS NOT NULL AND list_contains(before, ak) THEN 'asked already' END,
    CASE WHEN action = 'ask' AND t.attribute IS NULL AND len(list_filter(problems, lambda p: {flat_sql("p.name")} = tn AND p.type = t.type)) > 0 THEN 'known already' END,
    CASE WHEN action = 'end' AND (trim(u, ' ') <> '' OR t IS NOT NULL) THEN 'ended with a question' END, CASE WHEN action IS NULL AND skip_reason_code IS NULL THEN 'skipped without a reason' END
  ], lambda m: m IS NOT NULL) AS errors FROM asked)
"""
ORACLE_SQL = {
    "question_slot_flags": f"""WITH {ONCE_SQL} SELECT DISTINCT utterance, t.attribute AS attribute, array_to_string({slots_sql("fu")}, ',') AS slots, {COMPOUND_SQL} AS compound, canon IS NULL OR len({slots_sql("fu")}) = 0 OR {slots_sql("fu")} = [canon] AS fits FROM asked WHERE action = 'ask' AND utterance IS NOT NULL""",
    "target_keys": f"WITH {ONCE_SQL} SELECT k.type AS type, k.name AS name, k.attribute AS attribute, count(*) AS n FROM asked WHERE k IS NOT NULL GROUP BY ALL",
    "asked_targets_running": f"WITH {ONCE_SQL} SELECT dialogue_id, block_id, CAST(len(before) AS INTEGER) AS asked, list_contains(before, ak) AS again FROM asked WHERE ak IS NOT NULL",
    "decision_validation": _CHECKED + "SELECT dialogue_id, block_id, array_to_string(errors, '; ') AS errors FROM checked WHERE len(errors) > 0",
    "dialogue_fail_propagation": _CHECKED + "SELECT source_dialogue_id, count(*) FILTER (len(errors) > 0) AS errors, count(*) AS rows FROM checked GROUP BY ALL HAVING count(*) FILTER (len(errors) > 0) > 0",
    "interviewer_metrics": f"""WITH {ONCE_SQL}
SELECT split, count(*) AS rows, count(*) FILTER (action = 'ask') AS asked, round(coalesce(count(*) FILTER (action = 'ask' AND len(regexp_extract_all(u, '[?？]')) = 1) / nullif(count(*) FILTER (action = 'ask'), 0), 0), 6) AS one_question_rate,
  round(coalesce(count(*) FILTER (action = 'ask' AND regexp_matches(u, '{"|".join(UNSAFE)}')) / nullif(count(*) FILTER (action = 'ask'), 0), 0), 6) AS unsafe_rate,
  round(coalesce(count(*) FILTER (action = 'ask' AND {COMPOUND_SQL}) / nullif(count(*) FILTER (action = 'ask'), 0), 0), 6) AS compound_rate,
  round(coalesce(count(*) FILTER (action = 'ask' AND list_contains(before, ak)) / nullif(count(*) FILTER (action = 'ask'), 0), 0), 6) AS again_rate, round(count(*) FILTER (action = 'end') / count(*), 6) AS end_rate
FROM asked WHERE usable GROUP BY split""",
}

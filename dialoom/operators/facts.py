"""Validation, cleaning and projection of extracted facts. Validators give arrays of messages, not booleans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.jsonx import canonical_fact, json_object_text
from dialoom.functions.lexicon import CORE_FIELDS, FACT_TYPES, FORBIDDEN_KEYS, GENERIC_NEGATIVES, KEY_SYNONYMS, STATUSES, SUBJECTS, UNKNOWN_TARGETS, VALUE_KEYS
from dialoom.functions.text import has_hedge, is_hedged_evidence, without_format
from dialoom.session import table

_NO_MAP = "map<string,string>"


def distinct_facts(facts: DataFrame) -> DataFrame:
    """One row per dialogue, turn and position; copies collapse before the shuffle."""
    names = [c for c in facts.columns if c not in ("dialogue_id", "turn_id", "fact_pos")]
    one = F.max_by(F.struct(*names), F.coalesce("name", F.lit(""))).alias("fact")
    return facts.groupBy("dialogue_id", "turn_id", "fact_pos").agg(one).select("dialogue_id", "turn_id", "fact_pos", "fact.*")


def latest_turns(turn_rows: DataFrame) -> DataFrame:
    """One row per dialogue and turn: the one processed last."""
    names = [c for c in turn_rows.columns if c not in ("dialogue_id", "turn_id")]
    last = F.max_by(F.struct(*names), "processed_at").alias("row")
    return turn_rows.groupBy("dialogue_id", "turn_id").agg(last).select("dialogue_id", "turn_id", "row.*")


def _filled(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


def fact_errors(strict_codes: bool = False) -> Column:
    """Messages about one fact row (``name … attribute``, with ``patient_utterance``); codes must be null if ``strict_codes``."""
    kind, target = F.col("type"), F.col("attribute")["target"]
    concrete = F.size(F.map_filter(F.coalesce("attribute", F.create_map().cast(_NO_MAP)), lambda k, v: (k != "target") & F.coalesce(v != "", F.lit(False)))) > 0
    known = F.coalesce(~F.trim(target).isin(UNKNOWN_TARGETS), F.lit(False))
    is_attribute = F.coalesce(kind == "attribute", F.lit(False))
    checks = [
        (~F.coalesce(kind.isin(FACT_TYPES), F.lit(False)), "type invalid"),
        (~F.coalesce(F.col("status").isin(STATUSES), F.lit(False)), "status invalid"),
        (~F.coalesce(F.col("subject").isin(SUBJECTS), F.lit(False)), "subject invalid"),
        (F.coalesce(F.arrays_overlap(F.map_keys("attribute"), F.array(*map(F.lit, FORBIDDEN_KEYS))), F.lit(False)), "attribute repeats core fields"),
        (is_attribute & ~known, "attribute target unknown"),
        (is_attribute & ~concrete, "attribute has no value"),
        (~_filled(F.col("name")), "name empty"),
        (~_filled(F.col("normalized_name")), "normalized name empty"),
        (~_filled(F.col("evidence")), "evidence empty"),
        (_filled(F.col("evidence")) & ~F.coalesce(F.contains(F.col("patient_utterance"), F.col("evidence")), F.lit(False)), "evidence not in utterance"),
        (F.coalesce((F.col("status") == "absent") & kind.isin("medicine", "examination") & (F.col("name").isin(GENERIC_NEGATIVES) | F.col("normalized_name").isin(GENERIC_NEGATIVES)), F.lit(False)), "generic negative"),
        (F.col("standard_code").isNull() != F.col("terminology").isNull(), "code and terminology not paired"),
    ]
    if strict_codes:
        checks.append((F.col("standard_code").isNotNull() | F.col("terminology").isNotNull(), "code not null"))
    return F.filter(F.array(*(F.when(c, F.lit(m)) for c, m in checks)), lambda m: m.isNotNull())


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    turns = latest_turns(table(spark, sf_dir, "turn_rows").select("dialogue_id", "turn_id", "patient_utterance", "processed_at"))
    return facts.join(turns.drop("processed_at"), ["dialogue_id", "turn_id"], "left")


def field_set_errors(fact_json: Column) -> Column:
    """``missing, extra``: fields that a fact, as JSON text, lacks or has beyond the model's, sorted; null if it is no object."""
    keys, core = F.json_object_keys(fact_json), F.array(*map(F.lit, CORE_FIELDS))
    return F.when(keys.isNotNull(), F.struct(F.array_sort(F.array_except(core, keys)).alias("missing"), F.array_sort(F.array_except(keys, core)).alias("extra")))


def field_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts as a faulty extractor would write them (some without evidence, some with a field more), by what is wrong with their fields."""
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    whole, bare = (F.to_json(F.struct(*(F.col(c) for c in CORE_FIELDS if c != drop)), {"ignoreNullFields": "false"}) for drop in ("", "evidence"))
    written = F.when(F.col("fact_pos") % 6 == 5, bare).otherwise(whole)
    written = F.when(F.col("fact_pos") % 9 == 8, F.regexp_replace(written, r"\}$", ',"confidence":1}')).otherwise(written)
    errors = facts.select(field_set_errors(written).alias("e"))
    return errors.groupBy(F.array_join("e.missing", ",").alias("missing"), F.array_join("e.extra", ",").alias("extra")).agg(F.count("*").alias("n"))


def fact_error_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with errors, and the errors."""
    rows = _validated(spark, sf_dir).withColumn("errors", fact_errors())
    return rows.where(F.size("errors") > 0).select("dialogue_id", "turn_id", "fact_pos", F.array_join("errors", "; ").alias("errors"))


def evidence_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts by type, and how many have an evidence that is a piece of the utterance."""
    held = F.coalesce(F.contains(F.col("patient_utterance"), F.col("evidence")), F.lit(False))
    return _validated(spark, sf_dir).groupBy("type").agg(F.count("*").alias("facts"), F.count_if(held).alias("held"))


#: Attribute facts that a check of bindings must name, beside those of the table, and one turn that is sound.
PLANTED_BINDINGS = [
    ("planted", 0, 0, "attribute", "三天了", "腹痛", "duration", "三天"), ("planted", 0, 1, "attribute", "三天了", "腹泻", "duration", "三天"), ("planted", 1, 0, "attribute", "三天了", "腹痛", "duration", "三天"),
    ("planted", 1, 1, "attribute", "三天了", "腹痛", "severity", "轻"), ("planted", 2, 0, "attribute", "很重", "腹痛", "severity", "重"), ("planted", 2, 1, "attribute", "很重", "未知", "severity", "重"),
]


def conflicting_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns, of the facts and of planted ones, in which one evidence binds one attribute key to several targets."""
    planted = spark.createDataFrame(PLANTED_BINDINGS, "dialogue_id string, turn_id int, fact_pos int, type string, evidence string, target string, key string, value string")
    planted = planted.select("dialogue_id", "turn_id", "fact_pos", "type", "evidence", F.create_map(F.lit("target"), "target", "key", "value").alias("attribute"))
    facts = distinct_facts(table(spark, sf_dir, "facts")).unionByName(planted, allowMissingColumns=True).where("type = 'attribute'")
    target = F.trim(F.col("attribute")["target"])
    rows = facts.select("dialogue_id", "turn_id", F.trim(F.coalesce("evidence", F.lit(""))).alias("evidence"), target.alias("target"), F.explode("attribute").alias("key", "value"))
    rows = rows.where((F.col("key") != "target") & (F.coalesce("value", F.lit("")) != "") & F.coalesce(~F.col("target").isin(UNKNOWN_TARGETS), F.lit(False)))
    return rows.groupBy("dialogue_id", "turn_id", "evidence", "key").agg(F.count_distinct("target").alias("targets")).where("targets > 1")


def merged_values(a: Column, b: Column) -> Column:
    """Two values that are sets of parts joined by ``；`` as one, parts in the order in which they first occur."""
    parts = F.split(F.concat_ws("；", a, b), "；")
    return F.array_join(F.array_distinct(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")), "；")


def merged_maps(a: Column, b: Column) -> Column:
    """Two attribute maps with merged values."""
    return F.map_zip_with(a, b, lambda _, x, y: merged_values(x, y))


def clean_attributes(attribute: Column, kind: Column) -> Column:
    """Attributes with synonyms of keys replaced, blank values and core fields left out; values of one key are merged.

    Entries are folded one by one in the order of their keys, so that synonyms meet in a defined order.
    """
    synonyms = F.create_map(*(F.lit(x) for pair in KEY_SYNONYMS.items() for x in pair))
    empty = F.create_map().cast(_NO_MAP)
    entries = F.array_sort(F.map_entries(F.coalesce(attribute, empty)))

    def renamed(key: Column) -> Column:
        key = F.trim(key)
        return F.when((key == "value") & (kind == "examination"), "result").otherwise(F.coalesce(synonyms[key], key))

    pairs = F.transform(entries, lambda e: F.struct(renamed(e["key"]).alias("key"), e["value"].alias("value")))
    pairs = F.filter(pairs, lambda e: F.coalesce(F.trim(e["value"]) != "", F.lit(False)) & (e["key"] != "") & ~e["key"].isin(FORBIDDEN_KEYS))
    return F.aggregate(pairs, empty, lambda acc, e: merged_maps(acc, F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))).cast(_NO_MAP))


def _map_text(m: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")


def attribute_alias_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned attributes of the facts that have any, as text."""
    facts = distinct_facts(table(spark, sf_dir, "facts")).where(F.size("attribute") > 0)
    return facts.select("dialogue_id", "turn_id", "fact_pos", _map_text(clean_attributes(F.col("attribute"), F.col("type"))).alias("attributes"))


def cleaning_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each cleaning action was needed."""
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    synonyms = F.create_map(*(F.lit(x) for pair in KEY_SYNONYMS.items() for x in pair))
    rows = facts.select("type", "evidence", F.explode_outer("attribute").alias("key", "value"))
    keys = rows.where("key is not null").select(
        F.explode(F.filter(F.array(
            F.when((F.col("key") == "value") & (F.col("type") == "examination"), "alias:value->result").when(synonyms[F.trim("key")].isNotNull(), F.concat(F.lit("alias:"), F.trim("key"), F.lit("->"), synonyms[F.trim("key")])),
            F.when(F.trim(F.coalesce("value", F.lit(""))) == "", "empty removed"),
        ), lambda a: a.isNotNull())).alias("action"))
    hedged = facts.where(is_hedged_evidence(F.col("evidence"))).select(F.lit("hedged removed").alias("action"))
    return keys.unionByName(hedged).groupBy("action").agg(F.count("*").alias("n"))


def value_key(text: Column) -> Column:
    """The key for a legacy attribute ``value``, by the words around it."""
    out = F.lit("description")
    for key, words in reversed(VALUE_KEYS):
        out = F.when(text.rlike("|".join(words)), key).otherwise(out)
    return out


def legacy_value_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that the values of attribute facts would get, by type and count."""
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    text = F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in ("name", "normalized_name", "type", "evidence")), F.coalesce(F.col("attribute")["target"], F.lit("")))
    return facts.select("type", value_key(text).alias("key")).groupBy("type", "key").agg(F.count("*").alias("n"))


def training_projection(facts: DataFrame) -> DataFrame:
    """Facts as they are trained on: codes null, texts without format characters, hedges dropped, attributes clean."""
    kept = facts.where(~F.coalesce(is_hedged_evidence(F.col("evidence")), F.lit(False)))
    texts = {c: without_format(F.col(c)) for c in ("name", "normalized_name", "evidence")}
    return kept.withColumns(texts | {"standard_code": F.lit(None).cast("string"), "terminology": F.lit(None).cast("string"), "attribute": clean_attributes(F.col("attribute"), F.col("type"))})


def training_projection_null_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts as they are trained on."""
    rows = training_projection(distinct_facts(table(spark, sf_dir, "facts")))
    return rows.select("dialogue_id", "turn_id", "fact_pos", "name", "normalized_name", "type", "status", "subject", "evidence", "standard_code", "terminology")


def canonical_json_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts as canonical JSON, counted."""
    rows = table(spark, sf_dir, "facts").select(canonical_fact(["name", "type", "status", "subject"]).alias("fact"))
    return rows.groupBy("fact").agg(F.count("*").alias("n"))


def json_tolerant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON objects out of answers in four shapes (bare, fenced, with words around, broken), with two of their fields."""
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    body = F.concat(F.lit('{"name":"'), F.regexp_replace(F.coalesce("name", F.lit("")), r'["\\\p{C}]', ""), F.lit('","type":"'), F.col("type"), F.lit('"}'))
    shape = F.col("fact_pos") % 4
    answer = F.when(shape == 0, body).when(shape == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(shape == 2, F.concat(F.lit("Answer: "), body, F.lit(" done"))).otherwise(F.concat(body, F.lit("}")))
    parsed = json_object_text(answer)
    return facts.select("dialogue_id", "turn_id", "fact_pos", F.get_json_object(parsed, "$.name").alias("name"), F.get_json_object(parsed, "$.type").alias("type"))


def hedge_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with a hedge in their evidence or values."""
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    values = F.array_join(F.map_values("attribute"), " ")
    rows = facts.select("dialogue_id", "turn_id", "fact_pos", has_hedge(F.coalesce("evidence", F.lit(""))).alias("evidence_hedged"), has_hedge(F.coalesce(values, F.lit(""))).alias("values_hedged"))
    return rows.where("evidence_hedged or values_hedged")


def normalization_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and coded facts of every turn."""
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    return facts.groupBy("dialogue_id", "turn_id").agg(F.count("*").alias("facts"), F.count("standard_code").alias("coded_facts"))


def fact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid facts by type, status and subject."""
    rows = _validated(spark, sf_dir).where(F.size(fact_errors()) == 0)
    return rows.groupBy("type", "status", "subject").agg(F.count("*").alias("n"))


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns, valid turns, their share and the facts per valid turn."""
    turns = _validated(spark, sf_dir).groupBy("dialogue_id", "turn_id").agg(F.max(F.when(F.size(fact_errors()) > 0, 1).otherwise(0)).alias("bad"), F.count("*").alias("facts"))
    good = F.count_if(F.col("bad") == 0)
    facts = F.coalesce(F.sum(F.when(F.col("bad") == 0, F.col("facts"))), F.lit(0))
    return turns.agg(F.count("*").alias("turns"), good.alias("valid_turns"), F.round(F.coalesce(F.try_divide(good.cast("double"), F.count("*")), F.lit(0.0)), 6).alias("valid_rate"), F.round(F.coalesce(F.try_divide(facts.cast("double"), good), F.lit(0.0)), 6).alias("facts_per_valid_turn"))


QUERIES = {
    "field_sets": field_sets,
    "fact_error_array": fact_error_array, "evidence_substring_validation": evidence_validation, "conflicting_bindings": conflicting_bindings, "attribute_alias_merge": attribute_alias_merge,
    "cleaning_actions": cleaning_actions, "legacy_value_keys": legacy_value_keys, "training_projection_null_codes": training_projection_null_codes, "canonical_json_facts": canonical_json_facts,
    "json_tolerant_parse": json_tolerant_parse, "hedge_flags": hedge_flags, "normalization_stats": normalization_stats, "fact_counts": fact_counts, "validation_report": validation_report,
}


def _list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


DISTINCT_SQL = "facts_once AS (SELECT DISTINCT ON (dialogue_id, turn_id, fact_pos) * FROM facts)"
UTTERANCES_SQL = "utterances AS (SELECT dialogue_id, turn_id, arg_max(patient_utterance, processed_at) AS patient_utterance FROM turn_rows GROUP BY ALL)"
_SYNONYMS_SQL = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in KEY_SYNONYMS.items()) + "}"
_HEDGED_SQL = r"""(regexp_matches(regexp_replace(coalesce(evidence, ''), '[\s\p{Z}，。！？!?、；;：:（）()]+', '', 'g'), '^(?:好像|可能|也许|似乎|应该)(?:没有|没|有|有点|有些|是|不是).{0,12}$')
  OR regexp_matches(regexp_replace(coalesce(evidence, ''), '[\s\p{Z}，。！？!?、；;：:（）()]+', '', 'g'), '^(?:好像|可能|也许|似乎|应该).{0,24}(?:不适|异常|问题)$'))"""
_ERRORS_SQL = f"""
WITH {DISTINCT_SQL}, {UTTERANCES_SQL}, checked AS (
  SELECT f.*, list_filter([
    CASE WHEN coalesce(type NOT IN ({_list(FACT_TYPES)}), TRUE) THEN 'type invalid' END,
    CASE WHEN coalesce(status NOT IN ({_list(STATUSES)}), TRUE) THEN 'status invalid' END,
    CASE WHEN coalesce(subject NOT IN ({_list(SUBJECTS)}), TRUE) THEN 'subject invalid' END,
    CASE WHEN coalesce(list_has_any(map_keys(attribute), [{_list(FORBIDDEN_KEYS)}]), FALSE) THEN 'attribute repeats core fields' END,
    CASE WHEN type = 'attribute' AND coalesce(trim(attribute['target'], ' ') IN ({_list(UNKNOWN_TARGETS)}), TRUE) THEN 'attribute target unknown' END,
    CASE WHEN type = 'attribute' AND len(list_filter(map_entries(coalesce(attribute, MAP {{}})), lambda e: e.key <> 'target' AND coalesce(e.value, '') <> '')) = 0 THEN 'attribute has no value' END,
    CASE WHEN coalesce(trim(name, ' '), '') = '' THEN 'name empty' END,
    CASE WHEN coalesce(trim(normalized_name, ' '), '') = '' THEN 'normalized name empty' END,
    CASE WHEN coalesce(trim(evidence, ' '), '') = '' THEN 'evidence empty' END,
    CASE WHEN coalesce(trim(evidence, ' '), '') <> '' AND NOT coalesce(contains(patient_utterance, evidence), FALSE) THEN 'evidence not in utterance' END,
    CASE WHEN status = 'absent' AND type IN ('medicine', 'examination') AND (coalesce(name IN ({_list(GENERIC_NEGATIVES)}), FALSE) OR coalesce(normalized_name IN ({_list(GENERIC_NEGATIVES)}), FALSE)) THEN 'generic negative' END,
    CASE WHEN (standard_code IS NULL) <> (terminology IS NULL) THEN 'code and terminology not paired' END
  ], lambda m: m IS NOT NULL) AS errors
  FROM facts_once f LEFT JOIN utterances USING (dialogue_id, turn_id))
"""
ORACLE_SQL = {
    "field_sets": """SELECT CASE WHEN fact_pos % 6 = 5 THEN 'evidence' ELSE '' END AS missing, CASE WHEN fact_pos % 9 = 8 THEN 'confidence' ELSE '' END AS extra, count(*) AS n
FROM (SELECT DISTINCT dialogue_id, turn_id, fact_pos FROM facts) GROUP BY ALL""",
    "fact_error_array": _ERRORS_SQL + "SELECT dialogue_id, turn_id, fact_pos, array_to_string(errors, '; ') AS errors FROM checked WHERE len(errors) > 0",
    "fact_counts": _ERRORS_SQL + "SELECT type, status, subject, count(*) AS n FROM checked WHERE len(errors) = 0 GROUP BY ALL",
    "validation_report": _ERRORS_SQL + """, turns AS (SELECT dialogue_id, turn_id, max(CASE WHEN len(errors) > 0 THEN 1 ELSE 0 END) AS bad, count(*) AS facts FROM checked GROUP BY ALL)
SELECT count(*) AS turns, count(*) FILTER (bad = 0) AS valid_turns, round(coalesce(count(*) FILTER (bad = 0) / nullif(count(*), 0), 0), 6) AS valid_rate,
  round(coalesce(sum(facts) FILTER (bad = 0) / nullif(count(*) FILTER (bad = 0), 0), 0), 6) AS facts_per_valid_turn FROM turns""",
    "evidence_substring_validation": f"""WITH {DISTINCT_SQL}, {UTTERANCES_SQL}
SELECT type, count(*) AS facts, count(*) FILTER (coalesce(contains(patient_utterance, evidence), FALSE)) AS held FROM facts_once LEFT JOIN utterances USING (dialogue_id, turn_id) GROUP BY type""",
    "conflicting_bindings": f"""WITH {DISTINCT_SQL}, keys AS (
  SELECT dialogue_id, turn_id, trim(coalesce(evidence, ''), ' ') AS evidence, trim(attribute['target'], ' ') AS target, unnest(map_entries(attribute)) AS e FROM (
    SELECT dialogue_id, turn_id, evidence, attribute, type FROM facts_once UNION ALL SELECT d, t, e, MAP {{'target': target, k: v}}, kind FROM (VALUES {", ".join(map(str, PLANTED_BINDINGS))}) AS p(d, t, pos, kind, e, target, k, v)) WHERE type = 'attribute')
SELECT dialogue_id, turn_id, evidence, e.key AS key, count(DISTINCT target) AS targets FROM keys
WHERE e.key <> 'target' AND coalesce(e.value, '') <> '' AND target NOT IN ({_list(UNKNOWN_TARGETS)}) GROUP BY ALL HAVING count(DISTINCT target) > 1""",
    "attribute_alias_merge": f"""WITH {DISTINCT_SQL}, keys AS (
  SELECT dialogue_id, turn_id, fact_pos, type, unnest(map_entries(attribute)) AS e FROM facts_once WHERE len(map_keys(attribute)) > 0
), renamed AS (
  SELECT dialogue_id, turn_id, fact_pos, e.key AS old, CASE WHEN trim(e.key, ' ') = 'value' AND type = 'examination' THEN 'result' ELSE coalesce({_SYNONYMS_SQL}[trim(e.key, ' ')], trim(e.key, ' ')) END AS key, e.value AS value FROM keys
), parts AS (
  SELECT dialogue_id, turn_id, fact_pos, key, old, unnest(string_split(value, '；')) AS part, generate_subscripts(string_split(value, '；'), 1) AS pos
  FROM renamed WHERE coalesce(trim(value, ' '), '') <> '' AND key <> '' AND key NOT IN ({_list(FORBIDDEN_KEYS)})
), firsts AS (
  SELECT dialogue_id, turn_id, fact_pos, key, trim(part, ' ') AS part, min((old, pos)) AS first FROM parts WHERE trim(part, ' ') <> '' GROUP BY ALL
), merged AS (
  SELECT dialogue_id, turn_id, fact_pos, key, string_agg(part, '；' ORDER BY first) AS value FROM firsts GROUP BY ALL
), texts AS (SELECT dialogue_id, turn_id, fact_pos, string_agg(key || '=' || value, '|' ORDER BY key) AS attributes FROM merged GROUP BY ALL)
SELECT f.dialogue_id, f.turn_id, f.fact_pos, coalesce(attributes, '') AS attributes FROM facts_once f LEFT JOIN texts USING (dialogue_id, turn_id, fact_pos) WHERE len(map_keys(attribute)) > 0""",
    "cleaning_actions": f"""WITH {DISTINCT_SQL}, keys AS (SELECT type, unnest(map_entries(attribute)) AS e FROM facts_once), actions AS (
  SELECT CASE WHEN e.key = 'value' AND type = 'examination' THEN 'alias:value->result' WHEN {_SYNONYMS_SQL}[trim(e.key, ' ')] IS NOT NULL THEN 'alias:' || trim(e.key, ' ') || '->' || {_SYNONYMS_SQL}[trim(e.key, ' ')] END AS action FROM keys
  UNION ALL SELECT CASE WHEN trim(coalesce(e.value, ''), ' ') = '' THEN 'empty removed' END FROM keys
  UNION ALL SELECT 'hedged removed' FROM facts_once WHERE {_HEDGED_SQL})
SELECT action, count(*) AS n FROM actions WHERE action IS NOT NULL GROUP BY action""",
    "legacy_value_keys": f"""WITH {DISTINCT_SQL}, texts AS (
  SELECT type, concat_ws(' ', coalesce(name, ''), coalesce(normalized_name, ''), coalesce(type, ''), coalesce(evidence, ''), coalesce(attribute['target'], '')) AS t FROM facts_once)
SELECT type, CASE {" ".join(f"WHEN regexp_matches(t, '{'|'.join(w)}') THEN '{k}'" for k, w in VALUE_KEYS)} ELSE 'description' END AS key, count(*) AS n FROM texts GROUP BY ALL""",
    "training_projection_null_codes": rf"""WITH {DISTINCT_SQL}
SELECT dialogue_id, turn_id, fact_pos, regexp_replace(name, '\p{{Cf}}', '', 'g') AS name, regexp_replace(normalized_name, '\p{{Cf}}', '', 'g') AS normalized_name, type, status, subject,
  regexp_replace(evidence, '\p{{Cf}}', '', 'g') AS evidence, CAST(NULL AS VARCHAR) AS standard_code, CAST(NULL AS VARCHAR) AS terminology FROM facts_once WHERE NOT {_HEDGED_SQL}""",
    "canonical_json_facts": r"""
SELECT '{"attribute":{' || array_to_string(list_transform(list_sort(map_entries(coalesce(attribute, MAP {}))), lambda e: '"' || replace(replace(e.key, '\', '\\'), '"', '\"') || '":' || coalesce('"' || replace(replace(e.value, '\', '\\'), '"', '\"') || '"', 'null')), ',')
  || '},"name":' || coalesce('"' || name || '"', 'null') || ',"status":' || coalesce('"' || status || '"', 'null') || ',"subject":' || coalesce('"' || subject || '"', 'null') || ',"type":' || coalesce('"' || type || '"', 'null') || '}' AS fact, count(*) AS n FROM facts GROUP BY fact""",
    "json_tolerant_parse": rf"""WITH {DISTINCT_SQL}
SELECT dialogue_id, turn_id, fact_pos, CASE WHEN fact_pos % 4 < 3 THEN regexp_replace(coalesce(name, ''), '["\\\p{{C}}]', '', 'g') END AS name, CASE WHEN fact_pos % 4 < 3 THEN type END AS type FROM facts_once""",
    "hedge_flags": f"""WITH {DISTINCT_SQL}, flags AS (
  SELECT dialogue_id, turn_id, fact_pos, regexp_matches(coalesce(evidence, ''), '好像|可能|也许|似乎|应该|大概|估计|不确定') AS evidence_hedged,
    regexp_matches(coalesce(array_to_string(map_values(attribute), ' '), ''), '好像|可能|也许|似乎|应该|大概|估计|不确定') AS values_hedged FROM facts_once)
SELECT * FROM flags WHERE evidence_hedged OR values_hedged""",
    "normalization_stats": f"WITH {DISTINCT_SQL} SELECT dialogue_id, turn_id, count(*) AS facts, count(standard_code) AS coded_facts FROM facts_once GROUP BY ALL",
}

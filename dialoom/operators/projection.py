"""Views of states and facts for prompts, before-and-after checks, positional joins, candidates of questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.functions.lexicon import BUCKETS, QUESTION_ATTRIBUTES
from dialoom.functions.text import question_text
from dialoom.operators.dialogue import running_total
from dialoom.operators.facts import distinct_facts, latest_turns
from dialoom.operators.interview import COMPOUND_SQL, ONCE_SQL, asked_before, canonical_attribute, canonical_sql, flat_sql, is_compound, question_slots, questions, slots_sql
from dialoom.operators.state import ITEM_DDL
from dialoom.operators.terms import MATCH_SQL, standardized
from dialoom.session import table

# Fields that no prompt or training text may show.
HIDDEN = ["dialogue_id", "turn_id", "standard_code", "terminology", "aliases", "first_turn_id", "last_turn_id", "evidence"]
FULL, BRIEF = ["problems", "medications", "examinations", "histories", "lifestyle"], ["negative_findings", "other_facts"]
_NONE = f"array<{ITEM_DDL}>"


def prompt_item(item: Column, brief: bool = False) -> Column:
    """An item without ids, codes, aliases and evidence; the brief form has no body part either."""
    fields = ["name", "normalized_name", "type", "status", "subject", "time", *([] if brief else ["body_part"])]
    attributes = F.when(F.size(F.coalesce(item["attributes"], F.create_map().cast("map<string,string>"))) > 0, item["attributes"])
    return F.struct(*(item[f].alias(f) for f in fields), attributes.alias("attributes"))


def prompt_state(state: Column) -> Column:
    """A state as a prompt shows it: empty parts are null, so that JSON leaves them out."""

    def items(bucket: str) -> Column:
        kept = F.transform(F.coalesce(state[bucket], F.array().cast(_NONE)), lambda i: prompt_item(i, bucket in BRIEF))
        return F.when(F.size(kept) > 0, kept).alias(bucket)

    return F.struct(state["chief_complaint"].alias("chief_complaint"), *map(items, [*FULL[:1], *BRIEF[:1], *FULL[1:], *BRIEF[1:]]))


def model_visible_state(state: Column) -> Column:
    """A state without its dialogue, turn and uncertain findings; empty parts are null, so that JSON leaves them out."""
    parts = []
    for bucket in [*FULL[:1], *BRIEF[:1], *FULL[1:], *BRIEF[1:]]:
        parts.append(F.when(F.size(F.coalesce(state[bucket], F.array().cast(_NONE))) > 0, state[bucket]).alias(bucket))
    return F.struct(F.nullif(state["chief_complaint"], F.lit("")).alias("chief_complaint"), *parts)


def projection_errors(runtime: Column, training: Column) -> Column:
    """Where a projection for training isn't the facts it was made of with their codes taken off, place by place."""
    kept = ["name", "normalized_name", "type", "status", "subject", "evidence"]
    coded = F.transform(F.filter(F.transform(training, lambda f, i: F.struct(i.alias("i"), f["standard_code"].isNotNull().alias("coded"))), lambda x: x["coded"]), lambda x: F.concat(F.lit("facts["), x["i"].cast("string"), F.lit("].standard_code")))
    return F.when(F.size(runtime) != F.size(training), F.array(F.lit("number of facts"))).otherwise(F.concat(changes(runtime, training, kept), coded))


def question_state(state: Column) -> Column:
    """A state as the next question sees it: seven parts, items by their normalised name, nameless ones left out."""

    def items(bucket: str) -> Column:
        def shown(i: Column) -> Column:
            name = F.coalesce(F.nullif(i["normalized_name"], F.lit("")), F.nullif(i["name"], F.lit("")))
            return F.struct(name.alias("name"), i["type"].alias("type"), i["status"].alias("status"), i["subject"].alias("subject"), i["attributes"].alias("attributes"))

        kept = F.filter(F.transform(F.coalesce(state[bucket], F.array().cast(_NONE)), shown), lambda i: i["name"].isNotNull())
        return F.when(F.size(kept) > 0, kept).alias(bucket)

    return F.struct(F.nullif(state["chief_complaint"], F.lit("")).alias("chief_complaint"), *map(items, BUCKETS))


def hidden_keys(json_text: Column) -> Column:
    """The hidden fields that a JSON text has as a key at any depth."""
    return F.filter(F.array(*(F.when(json_text.rlike(f'"{k}"\\s*:'), k) for k in HIDDEN)), lambda k: k.isNotNull())


def changes(before: Column, after: Column, fields: list[str]) -> Column:
    """Fields, with the place of the fact, in which two arrays of facts differ; a differing number is one too."""
    both = F.zip_with(F.transform(before, lambda f, i: F.struct(i.alias("i"), f.alias("f"))), after, lambda b, a: F.filter(F.array(*(F.when(~b["f"][x].eqNullSafe(a[x]), F.concat(F.lit("facts["), b["i"].cast("string"), F.lit(f"].{x}"))) for x in fields)), lambda m: m.isNotNull()))
    return F.when(F.size(before) != F.size(after), F.array(F.lit("number of facts"))).otherwise(F.flatten(both))


def with_position(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``position``, 0-based in ``order``: counts of range partitions are added up, no single task sorts all."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id()).withColumn("own", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    from dialoom.session import cut

    parts = cut(parts)
    ends = parts.groupBy("pid").agg((F.max("own") + 1).alias("n"))
    ends = running_total(ends.withColumn("p", F.col("pid").cast("long")), "p", "n").select("pid", F.col("before").alias("ahead"))
    return parts.join(ends, "pid").withColumn("position", F.col("own") + F.col("ahead")).drop("pid", "own", "ahead")


def positional_join(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Rows of equal place joined as ``left`` and ``right``; another number of rows on one side is an error."""
    n, m = left.count(), right.count()
    if n != m:
        raise ValueError(f"{n} rows against {m}")
    a = with_position(left, left_order).select("position", F.struct(*left.columns).alias("left"))
    b = with_position(right, right_order).select("position", F.struct(*right.columns).alias("right"))
    return a.join(b, "position")


def question_candidates(rows: DataFrame) -> DataFrame:
    """``rows`` with ``candidates``: the questions of the doctor's block, each with the entity and attribute it asks for.

    The entity is the problem of the state that the question names (the longest name), the attribute its only slot.
    """
    sentences = F.filter(F.flatten(F.transform(F.coalesce("original_doctor_block", F.array().cast("array<string>")), lambda t: F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(r"[^。！!?？]+[?？]"), F.lit(0)))), lambda s: F.trim(s) != "")

    def candidate(s: Column) -> Column:
        named = F.filter(F.coalesce(F.col("patient_state.problems"), F.array().cast("array<struct<name:string,type:string,status:string>>")), lambda p: F.coalesce(F.contains(question_text(s), question_text(p["name"])) & (question_text(p["name"]) != ""), F.lit(False)))
        longest = F.array_sort(named, lambda a, b: F.length(b["name"]) - F.length(a["name"]))
        slots = question_slots(s)
        return F.struct(F.trim(s).alias("source_text"), F.get(longest, F.lit(0))["name"].alias("name"), F.get(longest, F.lit(0))["type"].alias("type"), F.when(F.size(slots) == 1, slots[0]).alias("attribute"), is_compound(s).alias("compound"))

    return rows.withColumn("candidates", F.transform(sentences, candidate))


def candidate_errors(candidate: Column, doctor_block: Column) -> Column:
    """What is wrong with a candidate that claims to be a question of the doctor's block."""
    source, attribute = F.coalesce(candidate["source_text"], F.lit("")), canonical_attribute(candidate["attribute"])
    slots, name = question_slots(source), question_text(candidate["name"])
    said = F.exists(F.coalesce(doctor_block, F.array().cast("array<string>")), lambda m: F.coalesce(F.contains(m, source), F.lit(False)))
    checks = [
        ((source == "") | ~said, "source not in the doctor's words"),
        (F.size(slots) > 1, "several slots"),
        (attribute.isNotNull() & (F.size(slots) > 0) & ~F.coalesce(slots == F.array(attribute), F.lit(False)), "another slot"),
        (candidate["attribute"].isNotNull() & attribute.isNull(), "attribute unknown"),
        ((name != "") & ~F.contains(question_text(source), name), "name not in the question"),
    ]
    return F.filter(F.array(*(F.when(c, F.lit(m)) for c, m in checks)), lambda m: m.isNotNull())


def checked_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates as a faulty model would give them (by the block's number), by what is wrong with them."""
    rows = question_candidates(questions(table(spark, sf_dir, "interviewer_rows"))).select("block_id", "original_doctor_block", F.explode("candidates").alias("c"))
    block, c = F.col("block_id") % 5, F.col("c")
    given = F.struct(
        F.when(block == 1, F.concat(c["source_text"], F.lit("x"))).otherwise(c["source_text"]).alias("source_text"), F.when(block == 2, F.concat(c["name"], F.lit("症"))).otherwise(c["name"]).alias("name"),
        c["type"].alias("type"), F.when(block == 3, "severity").when(block == 4, "nonsense").otherwise(c["attribute"]).alias("attribute"),
    )
    errors = rows.select(F.array_join(candidate_errors(given, F.col("original_doctor_block")), "; ").alias("errors"))
    return errors.groupBy("errors").agg(F.count("*").alias("n"))


def selected_question(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``candidates``, ``asked``, ``patient_state``) with ``selected``, the first candidate that passes all
    gates, else ``reason``: asked already > known already > not resolved > compound > no question."""
    known = F.transform(F.coalesce("patient_state.problems", F.array().cast("array<struct<name:string,type:string,status:string>>")), lambda p: F.concat(question_text(p["name"]), F.lit("/"), F.coalesce(p["type"], F.lit(""))))
    asked = F.transform("asked", lambda k: F.concat(k["name"], F.lit("/"), k["type"], F.lit("/"), k["attribute"]))

    def gate(c: Column) -> Column:
        entity = F.concat(question_text(c["name"]), F.lit("/"), F.coalesce(c["type"], F.lit("")))
        again = F.array_contains(asked, F.concat(entity, F.lit("/"), F.coalesce(c["attribute"], F.lit(""))))
        return F.when(c["compound"], "COMPOUND_QUESTION").when(c["name"].isNull(), "TARGET_NOT_RESOLVED").when(again, "TARGET_ALREADY_ASKED").when(c["attribute"].isNull() & F.array_contains(known, entity), "TARGET_ALREADY_KNOWN").otherwise("")

    judged = rows.withColumn("gates", F.transform("candidates", gate))
    first = F.array_position("gates", "")
    reasons = ["TARGET_ALREADY_ASKED", "TARGET_ALREADY_KNOWN", "TARGET_NOT_RESOLVED", "COMPOUND_QUESTION"]
    reason = F.coalesce(*(F.when(F.array_contains("gates", r), r) for r in reasons), F.lit("NO_SAFE_DOCTOR_QUESTION"))
    return judged.withColumn("selected", F.when(first > 0, F.get(F.col("candidates"), (first - 1).cast("int")))).withColumn("reason", F.when(first == 0, reason))


def candidate_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The question of each doctor's block that passes the gates, or why none does."""
    rows = selected_question(question_candidates(asked_before(questions(table(spark, sf_dir, "interviewer_rows")))))
    return rows.select("dialogue_id", "block_id", F.size("candidates").alias("candidates"), "selected.source_text", "selected.name", "selected.attribute", "reason")


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_turns(table(spark, sf_dir, "turn_rows").select("dialogue_id", "turn_id", "patient_state_after_turn", "processed_at"))
    return rows.select("dialogue_id", "turn_id", F.col("patient_state_after_turn").alias("state")).where("state is not null")


def prompt_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States as prompts show them: the items of two parts, one whole and one brief, how many there are, and hidden fields that shine through (none)."""
    rows = _states(spark, sf_dir).select("dialogue_id", "turn_id", prompt_state(F.col("state")).alias("p"))
    items = sum((F.coalesce(F.size(f"p.{b}"), F.lit(0)) for b in FULL + BRIEF), F.lit(0))

    def shown(bucket: str, fields: list[str]) -> Column:
        texts = F.transform(f"p.{bucket}", lambda i: F.concat_ws("/", *(i[f] for f in fields), F.coalesce(F.size(i["attributes"]), F.lit(0)).cast("string")))
        return F.coalesce(F.array_join(texts, "|"), F.lit(""))

    brief = ["name", "normalized_name", "type", "status", "subject", "time"]
    return rows.select("dialogue_id", "turn_id", "p.chief_complaint", shown("problems", [*brief, "body_part"]).alias("problems"), shown("negative_findings", brief).alias("negative"), items.alias("items"), F.size(hidden_keys(F.to_json("p"))).alias("hidden"))


def question_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States as the next question sees them: names of the problems."""
    rows = _states(spark, sf_dir).select("dialogue_id", "turn_id", question_state(F.col("state")).alias("q"))
    return rows.select("dialogue_id", "turn_id", F.coalesce(F.array_join("q.problems.name", "|"), F.lit("")).alias("problems"), F.coalesce(F.size("q.negative_findings"), F.lit(0)).alias("negative"))


def standardization_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose facts standardisation changed in a field that it must not (none), or may, by field."""
    raw = distinct_facts(table(spark, sf_dir, "facts"))
    kept = ["name", "type", "status", "subject", "evidence", "normalized_name", "standard_code"]

    def by_turn(df: DataFrame, name: str) -> DataFrame:
        fact = F.struct("fact_pos", *kept)
        return df.groupBy("dialogue_id", "turn_id").agg(F.array_sort(F.collect_list(fact)).alias(name))

    both = by_turn(raw, "b").join(by_turn(standardized(raw, table(spark, sf_dir, "terms")), "a"), ["dialogue_id", "turn_id"])
    field = F.explode(changes(F.col("b"), F.col("a"), kept)).alias("change")
    return both.select(field).select(F.regexp_extract("change", r"\.(\w+)$", 1).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


def positional_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions joined by place with the actions that a faulty model gives line by line (each seventh block ends)."""
    rows = questions(table(spark, sf_dir, "interviewer_rows"))
    gold = rows.select("dialogue_id", "block_id", "action")
    lines = rows.select(F.concat_ws("#", "dialogue_id", F.lpad(F.col("block_id").cast("string"), 12, "0")).alias("line"), F.when(F.col("block_id") % 7 == 5, "end").otherwise(F.col("action")).alias("predict"))
    both = positional_join(gold, lines, ["dialogue_id", "block_id"], ["line"])
    return both.groupBy(F.col("left.action").alias("action"), F.col("right.predict").alias("predicted")).agg(F.count("*").alias("n"), F.sum("position").alias("places"))


def state_after_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with the state of the next block of their session: how many problems it has."""
    along = Window.partitionBy("dialogue_id").orderBy("block_id")
    rows = questions(table(spark, sf_dir, "interviewer_rows"))
    return rows.select("dialogue_id", "block_id", F.coalesce(F.size(F.lead("patient_state.problems").over(along)), F.lit(0)).alias("next_problems"))


def canonical_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of facts by the attribute of a question that they answer, if any."""
    keys = table(spark, sf_dir, "facts").select(F.explode(F.map_keys("attribute")).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n")).withColumn("attribute", canonical_attribute(F.col("key")))


QUERIES = {
    "candidate_selection": candidate_selection, "checked_candidates": checked_candidates, "prompt_states": prompt_states, "question_states": question_states, "standardization_changes": standardization_changes,
    "positional_join": positional_pairs, "block_next_state": state_after_next, "canonical_targets": canonical_targets,
}


def _sql() -> dict[str, str]:
    from dialoom.operators.dialogue import MESSAGES_SQL

    states = "states AS (SELECT dialogue_id, turn_id, s FROM (SELECT dialogue_id, turn_id, arg_max({'s': patient_state_after_turn}, processed_at).s AS s FROM turn_rows GROUP BY ALL) WHERE s IS NOT NULL)"
    items = " + ".join(f"coalesce(len(s.{b}), 0)" for b in FULL + BRIEF)
    shown = "concat_ws('/', i.name, i.normalized_name, i.type, i.status, i.subject, i.time, {0}CAST(coalesce(len(map_keys(i.attributes)), 0) AS VARCHAR))"
    name = "coalesce(nullif(i.normalized_name, ''), nullif(i.name, ''))"
    candidates = f"""WITH {ONCE_SQL}, spoken AS (
  SELECT dialogue_id, block_id, problems, before, list_filter(flatten(list_transform(coalesce(original_doctor_block, []), lambda x: regexp_extract_all(coalesce(x, ''), '[^。！!?？]+[?？]'))), lambda z: trim(z, ' ') <> '') AS sentences FROM asked
), each AS (
  SELECT dialogue_id, block_id, problems, before, unnest(sentences) AS u, generate_subscripts(sentences, 1) AS pos FROM spoken
), flat AS (
  SELECT *, {flat_sql("u")} AS fu, list_filter(problems, lambda p: coalesce(contains({flat_sql("u")}, {flat_sql("p.name")}) AND {flat_sql("p.name")} <> '', FALSE)) AS named FROM each
), targets AS (
  SELECT *, list_filter(named, lambda p: length(p.name) = list_max(list_transform(named, lambda x: length(x.name))))[1] AS best, CASE WHEN len({slots_sql("fu")}) = 1 THEN {slots_sql("fu")}[1] END AS attribute FROM flat
"""
    wrong = {
        "source not in the doctor's words": "source = '' OR len(list_filter(coalesce(doctor, []), lambda m: coalesce(contains(m, source), FALSE))) = 0",
        "several slots": f"len({slots_sql('fs')}) > 1",
        "another slot": f"canon IS NOT NULL AND len({slots_sql('fs')}) > 0 AND {slots_sql('fs')} <> [canon]",
        "attribute unknown": "attr IS NOT NULL AND canon IS NULL",
        "name not in the question": f"{flat_sql('named')} <> '' AND NOT contains(fs, {flat_sql('named')})",
    }
    checks = ", ".join("CASE WHEN {} THEN '{}' END".format(c, m.replace("'", "''")) for m, c in wrong.items())
    return {
        "checked_candidates": f"""{candidates}), given AS (
  SELECT o.original_doctor_block AS doctor, CASE WHEN g.block_id % 5 = 1 THEN trim(u, ' ') || 'x' ELSE trim(u, ' ') END AS source, CASE WHEN g.block_id % 5 = 2 THEN best.name || '症' ELSE best.name END AS named,
    CASE WHEN g.block_id % 5 = 3 THEN 'severity' WHEN g.block_id % 5 = 4 THEN 'nonsense' ELSE attribute END AS attr FROM targets g JOIN once o USING (dialogue_id, block_id)
), read AS (SELECT *, {flat_sql("source")} AS fs, {canonical_sql("attr")} AS canon FROM given)
SELECT array_to_string(list_filter([{checks}], lambda e: e IS NOT NULL), '; ') AS errors, count(*) AS n FROM read GROUP BY ALL""",
        "standardization_changes": MATCH_SQL + """, changed AS (
  SELECT CASE WHEN coalesce(m.n, nullif(normalized_name, ''), name) IS DISTINCT FROM normalized_name THEN 1 END AS names, CASE WHEN m IS NOT NULL AND m.c IS DISTINCT FROM standard_code THEN 1 END AS codes FROM probed)
SELECT 'normalized_name' AS field, count(names) AS n FROM changed HAVING count(names) > 0 UNION ALL SELECT 'standard_code', count(codes) FROM changed HAVING count(codes) > 0""",
        "prompt_states": f"""WITH {states} SELECT dialogue_id, turn_id, s.chief_complaint AS chief_complaint, coalesce(array_to_string(list_transform(s.problems, lambda i: {shown.format("i.body_part, ")}), '|'), '') AS problems,
  coalesce(array_to_string(list_transform(s.negative_findings, lambda i: {shown.format("")}), '|'), '') AS negative, CAST({items} AS INTEGER) AS items, 0 AS hidden FROM states""",
        "question_states": f"WITH {states} SELECT dialogue_id, turn_id, coalesce(array_to_string(list_filter(list_transform(s.problems, lambda i: {name}), lambda n: n IS NOT NULL), '|'), '') AS problems, CAST(coalesce(len(list_filter(s.negative_findings, lambda i: {name} IS NOT NULL)), 0) AS INTEGER) AS negative FROM states",
        "positional_join": """WITH once AS (SELECT DISTINCT ON (dialogue_id, block_id) * FROM interviewer_rows ORDER BY dialogue_id, block_id, coalesce(utterance, ''))
SELECT action, CASE WHEN block_id % 7 = 5 THEN 'end' ELSE action END AS predicted, count(*) AS n, CAST(sum(place) AS BIGINT) AS places FROM (SELECT *, row_number() OVER (ORDER BY dialogue_id, block_id) - 1 AS place FROM once) GROUP BY ALL""",
        "block_next_state": "WITH once AS (SELECT DISTINCT ON (dialogue_id, block_id) * FROM interviewer_rows ORDER BY dialogue_id, block_id, coalesce(utterance, '')) SELECT dialogue_id, block_id, CAST(coalesce(len(lead(patient_state.problems) OVER (PARTITION BY dialogue_id ORDER BY block_id)), 0) AS INTEGER) AS next_problems FROM once",
        "candidate_selection": f"""{candidates}), gates AS (
  SELECT *, CASE WHEN {COMPOUND_SQL} THEN 'COMPOUND_QUESTION' WHEN best.name IS NULL THEN 'TARGET_NOT_RESOLVED'
    WHEN list_contains(list_transform(before, lambda k: k.name || '/' || k.type || '/' || k.attribute), {flat_sql("best.name")} || '/' || coalesce(best.type, '') || '/' || coalesce(attribute, '')) THEN 'TARGET_ALREADY_ASKED'
    WHEN attribute IS NULL AND list_contains(list_transform(problems, lambda p: {flat_sql("p.name")} || '/' || coalesce(p.type, '')), {flat_sql("best.name")} || '/' || coalesce(best.type, '')) THEN 'TARGET_ALREADY_KNOWN' ELSE '' END AS gate FROM targets
), judged AS (
  SELECT dialogue_id, block_id, count(*) AS candidates, arg_min({{'s': trim(u, ' '), 'n': best.name, 'a': attribute}}, pos) FILTER (gate = '') AS selected, list(gate) AS gates FROM gates GROUP BY ALL)
SELECT dialogue_id, block_id, CAST(coalesce(candidates, 0) AS INTEGER) AS candidates, selected.s AS source_text, selected.n AS name, selected.a AS attribute, CASE WHEN selected IS NOT NULL THEN NULL
  {" ".join(f"WHEN list_contains(coalesce(gates, []), '{r}') THEN '{r}'" for r in ("TARGET_ALREADY_ASKED", "TARGET_ALREADY_KNOWN", "TARGET_NOT_RESOLVED", "COMPOUND_QUESTION"))} ELSE 'NO_SAFE_DOCTOR_QUESTION' END AS reason
FROM asked LEFT JOIN judged USING (dialogue_id, block_id)""",
        "canonical_targets": f"SELECT key, count(*) AS n, CASE WHEN lower(trim(key, ' ')) IN ({', '.join(repr(a) for a in QUESTION_ATTRIBUTES)}) THEN lower(trim(key, ' ')) END AS attribute FROM (SELECT unnest(map_keys(attribute)) AS key FROM facts) GROUP BY key",
    }


ORACLE_SQL = _sql()

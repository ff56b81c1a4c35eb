"""Ordered operators over the messages of dialogues: context windows, as-of lookups, blocks, sessions, prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.functions.lexicon import CHATTER, COMPLAINT_CUES, DOCTOR_CLOSINGS, MEDICAL_SIGNALS, PATIENT_CLOSINGS, SHORT_ANSWERS, TOPIC_CUES
from dialoom.functions.text import block_text, is_chatter, is_short_answer
from dialoom.session import table

# How the roles are written in message rows.
ROLES = {"user": ["user", "patient", "患者", "病人"], "assistant": ["assistant", "doctor", "医生"], "system": ["system", "系统"]}


def in_dialogue():
    """The messages of a dialogue in their order."""
    return Window.partitionBy("dialogue_id").orderBy("turn_id")


def role_name(role: Column) -> Column:
    """user, assistant, system, or the role as it is written."""
    word = F.lower(F.trim(role))
    out = word
    for name, words in ROLES.items():
        out = F.when(word.isin(words), name).otherwise(out)
    return out


def ordered_messages(messages: DataFrame) -> DataFrame:
    """``source_pos, dialogue_id, turn_id, role, content``: one message per turn, the one received first.

    One shuffle by dialogue and turn with map-side combination; contents are trimmed of blanks, null becomes "".
    """
    content = F.coalesce(F.trim("content"), F.lit(""))
    first = F.min(F.struct("received_at", role_name(F.col("role")).alias("role"), content.alias("content"), "source_pos")).alias("first")
    rows = messages.where("dialogue_id is not null and turn_id is not null").groupBy("dialogue_id", "turn_id").agg(first)
    return rows.select("first.source_pos", "dialogue_id", "turn_id", "first.role", "first.content")


MESSAGES_SQL = """
messages_in_order AS (
  SELECT source_pos, dialogue_id, turn_id, role, content FROM (
    SELECT *, row_number() OVER (PARTITION BY dialogue_id, turn_id ORDER BY received_at NULLS FIRST, role NULLS FIRST, content, source_pos) AS rn FROM (
      SELECT source_pos, dialogue_id, turn_id, received_at, coalesce(trim(content, ' '), '') AS content,
        CASE WHEN lower(trim(role, ' ')) IN ('user', 'patient', '患者', '病人') THEN 'user' WHEN lower(trim(role, ' ')) IN ('assistant', 'doctor', '医生') THEN 'assistant'
             WHEN lower(trim(role, ' ')) IN ('system', '系统') THEN 'system' ELSE lower(trim(role, ' ')) END AS role
      FROM messages WHERE dialogue_id IS NOT NULL AND turn_id IS NOT NULL)) WHERE rn = 1)
"""


def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_messages(table(spark, sf_dir, "messages"))


def scan_messages_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by role as it is written."""
    return table(spark, sf_dir, "messages").groupBy("role").agg(F.count("*").alias("n"))


def user_turn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User messages of each dialogue."""
    return _ordered(spark, sf_dir).groupBy("dialogue_id").agg(F.count_if(F.col("role") == "user").alias("user_turns"), F.count("*").alias("turns"))


def running_total(df: DataFrame, order: str, value: str, share: int = 10_000) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over all rows before it in ``order`` (a non-negative integer).

    A window over all rows would be one task. Sums of ranges of ``order`` are accumulated first, and windows run inside
    the ranges. The sums are accumulated in the same way over ranges of ranges, so that the one window over all has a
    row for ``share`` squared places: ten thousand rows for 10^12.
    """
    parts = df.withColumn("part", F.floor(F.col(order) / share))
    sums = parts.groupBy("part").agg(F.sum(value).alias("n")).withColumn("whole", F.floor(F.col("part") / share))
    tops = sums.groupBy("whole").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("whole").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("whole", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("top"))
    among = Window.partitionBy("whole").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("own", F.coalesce(F.sum("n").over(among), F.lit(0))).join(tops, "whole").select("part", (F.col("own") + F.col("top")).alias("ahead"))
    inside = Window.partitionBy("part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("own", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(sums, "part").withColumn("before", F.col("own") + F.col("ahead")).drop("part", "own", "ahead")


def select_prefix(dialogues: DataFrame, max_dialogues: int, max_user_turns: int) -> DataFrame:
    """The dialogues (``source_pos, dialogue_id, user_turns``) before both budgets are used up; the last is kept whole."""
    ranked = running_total(dialogues.withColumn("one", F.lit(1)), "source_pos", "user_turns").withColumnRenamed("before", "turns_before")
    ranked = running_total(ranked, "source_pos", "one").withColumnRenamed("before", "dialogues_before")
    return ranked.where((F.col("dialogues_before") < max_dialogues) & (F.col("turns_before") < max_user_turns)).drop("one")


def prefix_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first dialogues of the source within 800 dialogues and 3,000 user turns."""
    per = _ordered(spark, sf_dir).groupBy("dialogue_id").agg(F.min("source_pos").alias("source_pos"), F.count_if(F.col("role") == "user").alias("user_turns"))
    return select_prefix(per, 800, 3000).select("dialogue_id", "source_pos", "user_turns", "turns_before")


def previous_assistant(messages: DataFrame) -> DataFrame:
    """User messages with the last assistant message before each; a blank one gives null and is not looked past."""
    earlier = in_dialogue().rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("role") == "assistant", F.col("content")), ignorenulls=True).over(earlier)
    return messages.withColumn("previous", F.nullif(last, F.lit(""))).where("role = 'user'")


def previous_assistant_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user message with the doctor's question before it."""
    return previous_assistant(_ordered(spark, sf_dir)).select("dialogue_id", "turn_id", "previous")


def recent_context(messages: DataFrame, max_messages: int, max_chars: int) -> DataFrame:
    """User messages with ``context``: what was said before, as far as the budget of messages and characters goes.

    Blank and system messages don't count; the nearest message is kept in any case. The frame is bounded by the
    number of messages, so that no dialogue is collected.
    """
    said = messages.withColumn("said", F.when(F.col("role").isin("user", "assistant") & (F.col("content") != ""), F.struct("role", "content")))
    # only spoken messages count towards the frame: number them, and look back over the numbers
    numbered = said.withColumn("number", F.count("said").over(in_dialogue().rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spoken = Window.partitionBy("dialogue_id").orderBy("number").rangeBetween(-max_messages, 0)
    near = F.collect_list(F.when(F.col("said").isNotNull(), F.struct("turn_id", "role", "content"))).over(spoken)
    rows = numbered.withColumn("near", F.reverse(F.array_sort(F.filter(near, lambda m: m["turn_id"] < F.col("turn_id"))))).where("role = 'user'")
    start = F.struct(F.lit(0).alias("chars"), F.lit(True).alias("on"), F.array().cast("array<struct<role:string,content:string>>").alias("kept"))

    def step(acc: Column, m: Column) -> Column:
        total = acc["chars"] + F.length(m["role"]) + F.length(m["content"])
        take = acc["on"] & ((F.size(acc["kept"]) == 0) | ((F.size(acc["kept"]) < max_messages) & (total <= max_chars)))
        kept = F.when(take, F.concat(F.array(F.struct(m["role"].alias("role"), m["content"].alias("content"))), acc["kept"])).otherwise(acc["kept"])
        return F.struct(F.when(take, total).otherwise(acc["chars"]).alias("chars"), (take & (total < max_chars)).alias("on"), kept.alias("kept"))

    return rows.withColumn("context", F.aggregate("near", start, step, lambda acc: acc["kept"])).drop("near", "number", "said")


def recent_context_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context of two messages and 600 characters of every user message, as one text."""
    rows = recent_context(_ordered(spark, sf_dir), 2, 600)
    text = F.array_join(F.transform("context", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return rows.select("dialogue_id", "turn_id", F.size("context").cast("int").alias("messages"), text.alias("context"))


def truncated_context(messages: DataFrame, max_messages: int, max_chars: int) -> DataFrame:
    """User messages with the ends of the messages before them: any role, each cut to the characters that are left."""
    numbered = messages.withColumn("number", F.count(F.when(F.col("content") != "", 1)).over(in_dialogue().rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spoken = Window.partitionBy("dialogue_id").orderBy("number").rangeBetween(-max_messages, 0)
    near = F.collect_list(F.when(F.col("content") != "", F.struct("turn_id", "role", "content"))).over(spoken)
    near = F.slice(F.reverse(F.array_sort(F.filter(near, lambda m: m["turn_id"] < F.col("turn_id")))), 1, max_messages)
    start = F.struct(F.lit(max_chars).alias("room"), F.array().cast("array<struct<role:string,content:string>>").alias("kept"))

    def step(acc: Column, m: Column) -> Column:
        take = F.least(acc["room"], F.length(m["content"]))
        cut = F.struct(m["role"].alias("role"), F.substr(m["content"], F.length(m["content"]) - take + 1).alias("content"))
        return F.struct((acc["room"] - take).alias("room"), F.when(take > 0, F.concat(F.array(cut), acc["kept"])).otherwise(acc["kept"]).alias("kept"))

    rows = numbered.withColumn("near", near).where("role = 'user'")
    return rows.withColumn("context", F.aggregate("near", start, step, lambda acc: acc["kept"])).drop("near", "number")


def recent_context_truncating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context of four messages and 1,000 characters of every user message, as one text."""
    rows = truncated_context(_ordered(spark, sf_dir), 4, 1000)
    text = F.array_join(F.transform("context", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return rows.select("dialogue_id", "turn_id", text.alias("context"))


def dialogue_blocks_of(messages: DataFrame) -> DataFrame:
    """``dialogue_id, block_id, patient_block, patient_turn_ids, doctor_block, doctor_turn_ids, next_patient_block, is_terminal``.

    A block is a run of user messages and the run of assistant messages after it; what comes before the first user
    message, and assistant messages after another role, belong to none. A run's own numbers are put in order after
    a grouping by block, one shuffle by dialogue in all.
    """
    before = F.lag("role").over(in_dialogue())
    starts = F.when((F.col("role") == "user") & (before.isNull() | (before != "user")), 1).otherwise(0)
    rows = messages.withColumn("starts", starts)
    runs = in_dialogue().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("block", F.sum("starts").over(runs) - 1)
    # in a block, assistant messages count until another role speaks
    in_block = Window.partitionBy("dialogue_id", "block").orderBy("turn_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.where("block >= 0").withColumn("other", F.max(F.when(F.col("role").isin("user", "assistant"), 0).otherwise(1)).over(in_block))
    part = F.struct("turn_id", "content")
    users = F.array_sort(F.collect_list(F.when(F.col("role") == "user", part)))
    doctors = F.array_sort(F.collect_list(F.when((F.col("role") == "assistant") & (F.col("other") == 0), part)))
    blocks = rows.groupBy("dialogue_id", "block").agg(users.alias("u"), doctors.alias("d"))
    along = Window.partitionBy("dialogue_id").orderBy("block")
    ahead = F.lead("u").over(along)
    return blocks.select(
        "dialogue_id", F.col("block").cast("int").alias("block_id"), F.col("u.content").alias("patient_block"), F.col("u.turn_id").alias("patient_turn_ids"),
        F.col("d.content").alias("doctor_block"), F.col("d.turn_id").alias("doctor_turn_ids"), F.coalesce(ahead["content"], F.array().cast("array<string>")).alias("next_patient_block"), ahead.isNull().alias("is_terminal"),
    )


def _joined(columns: list[str]) -> list[Column]:
    return [F.array_join(F.col(c).cast("array<string>"), "|").alias(c) for c in columns]


def dialogue_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of all dialogues, lists as texts."""
    blocks = dialogue_blocks_of(_ordered(spark, sf_dir))
    return blocks.select("dialogue_id", "block_id", *_joined(["patient_block", "patient_turn_ids", "doctor_block", "doctor_turn_ids"]))


def block_next_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next patient block of every block."""
    return dialogue_blocks_of(_ordered(spark, sf_dir)).select("dialogue_id", "block_id", *_joined(["next_patient_block"]), "is_terminal")


def is_closing(block: Column, words: list[str], most: int) -> Column:
    """Whether a block of messages closes an exchange."""
    text = block_text(F.array_join(block, ""))
    return (text != "") & (F.length(text) <= most) & (F.contains(text, F.lit("谢谢")) | text.rlike("^(?:" + "|".join(words) + ")"))


def split_sessions(blocks: DataFrame, facts: DataFrame) -> DataFrame:
    """``blocks`` with ``session_index, session_block_id, reason``: a new session begins after a closed exchange, if the
    next block has facts and either names a new topic or an independent new complaint; else ``reason`` is ambiguous.

    ``facts``: ``dialogue_id, turn_id, name, normalized_name, type, status``. Facts are joined by turn; the names of
    all earlier blocks are a running set of the dialogue.
    """
    turns = blocks.select("dialogue_id", "block_id", F.explode("patient_turn_ids").alias("turn_id"))
    names = F.array_remove(F.array_distinct(F.array(block_text(F.col("name")), block_text(F.col("normalized_name")), block_text(F.col("target")))), "")
    found = turns.join(facts.select("dialogue_id", "turn_id", names.alias("names"), (F.col("type").isin("symptom", "disease") & ~F.col("status").eqNullSafe("absent")).alias("complaint")), ["dialogue_id", "turn_id"])
    per = found.groupBy("dialogue_id", "block_id").agg(F.flatten(F.collect_set("names")).alias("all_names"), F.flatten(F.collect_set(F.when(F.col("complaint"), F.col("names")))).alias("complaints"), F.count("*").alias("facts"))
    none = F.array().cast("array<string>")
    rows = blocks.join(per, ["dialogue_id", "block_id"], "left").withColumns({"all_names": F.coalesce("all_names", none), "complaints": F.coalesce("complaints", none), "facts": F.coalesce("facts", F.lit(0))})
    along = Window.partitionBy("dialogue_id").orderBy("block_id")
    earlier = F.array_distinct(F.flatten(F.collect_list("all_names").over(along.rowsBetween(Window.unboundedPreceding, -1))))
    closed = is_closing(F.col("patient_block"), PATIENT_CLOSINGS, 24) & is_closing(F.col("doctor_block"), DOCTOR_CLOSINGS, 50)
    rows = rows.withColumn("after_closed", F.coalesce(F.lag(closed).over(along), F.lit(False))).withColumn("earlier", earlier)
    text = block_text(F.array_join("patient_block", ""))
    topic = text.rlike("|".join(TOPIC_CUES))
    overlap = F.exists("complaints", lambda a: F.exists("earlier", lambda b: F.contains(a, b) | F.contains(b, a)))
    independent = (F.size("complaints") > 0) & F.array_join("patient_block", "").rlike("|".join(COMPLAINT_CUES)) & ~overlap
    reason = F.when(~F.col("after_closed") | (F.col("facts") == 0), F.lit(None)).when(topic, "explicit_new_topic").when(independent, "independent_new_complaint").otherwise("ambiguous")
    rows = rows.withColumn("reason", reason)
    boundary = F.when(F.col("reason").isin("explicit_new_topic", "independent_new_complaint"), 1).otherwise(0)
    rows = rows.withColumn("session_index", F.sum(boundary).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"))
    inside = Window.partitionBy("dialogue_id", "session_index").orderBy("block_id")
    return rows.withColumn("session_block_id", F.row_number().over(inside) - 1).drop("all_names", "complaints", "earlier", "after_closed")


def session_split_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of all dialogues, counted by dialogue, with the reasons of their boundaries."""
    facts = table(spark, sf_dir, "facts").select("dialogue_id", "turn_id", "name", "normalized_name", "type", "status", F.col("attribute")["target"].alias("target"))
    rows = split_sessions(dialogue_blocks_of(_ordered(spark, sf_dir)), facts)
    return rows.groupBy("dialogue_id").agg((F.max("session_index") + 1).alias("sessions"), F.count_if(F.col("reason") == "ambiguous").alias("ambiguous"), F.count("*").alias("blocks"))


def block_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of every block: how many, and the distinct types."""
    turns = dialogue_blocks_of(_ordered(spark, sf_dir)).select("dialogue_id", "block_id", F.explode("patient_turn_ids").alias("turn_id"))
    facts = table(spark, sf_dir, "facts").select("dialogue_id", "turn_id", "fact_pos", "type").distinct()
    return turns.join(facts, ["dialogue_id", "turn_id"]).groupBy("dialogue_id", "block_id").agg(F.count("*").alias("facts"), F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"))


def message_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User messages that are short answers or courtesy."""
    rows = _ordered(spark, sf_dir).where("role = 'user'").select("dialogue_id", "turn_id", is_short_answer(F.col("content")).alias("short"), is_chatter(F.col("content")).alias("chatter"))
    return rows.where("short or chatter")


def block_order_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of interviewer_rows, and of planted sessions with gaps, whose number isn't the one after the number before."""
    planted = spark.createDataFrame(PLANTED_BLOCKS, "dialogue_id string, block_id int")
    rows = table(spark, sf_dir, "interviewer_rows").select("dialogue_id", "block_id").unionByName(planted).distinct()
    before = F.lag("block_id").over(Window.partitionBy("dialogue_id").orderBy("block_id"))
    return rows.withColumn("before", before).where("block_id <> coalesce(before, -1) + 1")


#: Sessions that a check of the order must name, beside those of the table: a gap, a late begin, and a sound one.
PLANTED_BLOCKS = [("planted gap", 0), ("planted gap", 1), ("planted gap", 3), ("planted late", 2), ("planted sound", 0), ("planted sound", 1)]


QUERIES = {
    "scan_messages_roles": scan_messages_roles, "user_turn_counts": user_turn_counts, "prefix_select_by_user_turns": prefix_select, "previous_assistant_asof": previous_assistant_asof,
    "recent_context_budget": recent_context_budget, "recent_context_truncating": recent_context_truncating, "dialogue_blocks": dialogue_blocks, "block_next_lead": block_next_lead,
    "session_split_flags": session_split_flags, "block_facts": block_facts, "message_flags": message_flags, "block_order_check": block_order_check,
}

_BLOCKS_SQL = f"""
{MESSAGES_SQL}, runs AS (
  SELECT *, CASE WHEN role = 'user' AND coalesce(lag(role) OVER w, '') <> 'user' THEN 1 ELSE 0 END AS starts FROM messages_in_order WINDOW w AS (PARTITION BY dialogue_id ORDER BY turn_id)
), numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY dialogue_id ORDER BY turn_id) - 1 AS block FROM runs
), within AS (
  SELECT *, max(CASE WHEN role IN ('user', 'assistant') THEN 0 ELSE 1 END) OVER (PARTITION BY dialogue_id, block ORDER BY turn_id) AS other FROM numbered WHERE block >= 0
), blocks AS (
  SELECT dialogue_id, CAST(block AS INTEGER) AS block_id,
    coalesce(list(content ORDER BY turn_id) FILTER (role = 'user'), []) AS patient_block, coalesce(list(turn_id ORDER BY turn_id) FILTER (role = 'user'), []) AS patient_turn_ids,
    coalesce(list(content ORDER BY turn_id) FILTER (role = 'assistant' AND other = 0), []) AS doctor_block, coalesce(list(turn_id ORDER BY turn_id) FILTER (role = 'assistant' AND other = 0), []) AS doctor_turn_ids
  FROM within GROUP BY ALL
)"""


def _list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _rest(column: str) -> str:
    for phrase in sorted(CHATTER, key=lambda p: (-len(p), p)):
        column = f"replace({column}, '{phrase}', '')"
    return column


_BLANKS_OUT = r"[\s，。！？、；：,.!?;:~～]+"
ORACLE_SQL = {
    "scan_messages_roles": "SELECT role, count(*) AS n FROM messages GROUP BY role",
    "user_turn_counts": f"WITH {MESSAGES_SQL} SELECT dialogue_id, count(*) FILTER (role = 'user') AS user_turns, count(*) AS turns FROM messages_in_order GROUP BY dialogue_id",
    "prefix_select_by_user_turns": f"""WITH {MESSAGES_SQL}, per AS (
  SELECT dialogue_id, min(source_pos) AS source_pos, count(*) FILTER (role = 'user') AS user_turns FROM messages_in_order GROUP BY dialogue_id
), ranked AS (
  SELECT *, CAST(coalesce(sum(user_turns) OVER (ORDER BY source_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS turns_before, row_number() OVER (ORDER BY source_pos) AS rn FROM per)
SELECT dialogue_id, source_pos, user_turns, turns_before FROM ranked WHERE rn <= 800 AND turns_before < 3000""",
    "previous_assistant_asof": f"""WITH {MESSAGES_SQL}, looked AS (
  SELECT *, last_value(CASE WHEN role = 'assistant' THEN content END IGNORE NULLS) OVER (PARTITION BY dialogue_id ORDER BY turn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM messages_in_order)
SELECT dialogue_id, turn_id, nullif(p, '') AS previous FROM looked WHERE role = 'user'""",
    "recent_context_budget": f"""WITH {MESSAGES_SQL}, spoken AS (
  SELECT * FROM messages_in_order WHERE role IN ('user', 'assistant') AND content <> ''
), pairs AS (
  SELECT u.dialogue_id, u.turn_id, s.turn_id AS t, s.role, s.content, row_number() OVER (PARTITION BY u.dialogue_id, u.turn_id ORDER BY s.turn_id DESC) AS rn,
    sum(length(s.role) + length(s.content)) OVER (PARTITION BY u.dialogue_id, u.turn_id ORDER BY s.turn_id DESC) AS chars
  FROM messages_in_order u JOIN spoken s ON s.dialogue_id = u.dialogue_id AND s.turn_id < u.turn_id WHERE u.role = 'user'
), kept AS (
  SELECT dialogue_id, turn_id, count(*) AS messages, string_agg(role || ':' || content, chr(10) ORDER BY t) AS context FROM pairs WHERE rn = 1 OR (rn <= 2 AND chars <= 600) GROUP BY ALL)
SELECT u.dialogue_id, u.turn_id, CAST(coalesce(messages, 0) AS INTEGER) AS messages, coalesce(context, '') AS context FROM messages_in_order u LEFT JOIN kept k USING (dialogue_id, turn_id) WHERE u.role = 'user'""",
    "recent_context_truncating": f"""WITH {MESSAGES_SQL}, pairs AS (
  SELECT u.dialogue_id, u.turn_id, s.turn_id AS t, s.role, s.content, row_number() OVER w AS rn, sum(length(s.content)) OVER w - length(s.content) AS used
  FROM messages_in_order u JOIN messages_in_order s ON s.dialogue_id = u.dialogue_id AND s.turn_id < u.turn_id AND s.content <> '' WHERE u.role = 'user'
  WINDOW w AS (PARTITION BY u.dialogue_id, u.turn_id ORDER BY s.turn_id DESC)
), kept AS (
  SELECT dialogue_id, turn_id, string_agg(coalesce(role, '') || ':' || right(content, CAST(least(1000 - used, length(content)) AS BIGINT)), chr(10) ORDER BY t) AS context FROM pairs WHERE rn <= 4 AND used < 1000 GROUP BY ALL)
SELECT u.dialogue_id, u.turn_id, coalesce(context, '') AS context FROM messages_in_order u LEFT JOIN kept k USING (dialogue_id, turn_id) WHERE u.role = 'user'""",
    "dialogue_blocks": f"""WITH {_BLOCKS_SQL}
SELECT dialogue_id, block_id, array_to_string(patient_block, '|') AS patient_block, array_to_string(patient_turn_ids, '|') AS patient_turn_ids, array_to_string(doctor_block, '|') AS doctor_block, array_to_string(doctor_turn_ids, '|') AS doctor_turn_ids FROM blocks""",
    "block_next_lead": f"""WITH {_BLOCKS_SQL}
SELECT dialogue_id, block_id, coalesce(array_to_string(lead(patient_block) OVER w, '|'), '') AS next_patient_block, lead(block_id) OVER w IS NULL AS is_terminal FROM blocks WINDOW w AS (PARTITION BY dialogue_id ORDER BY block_id)""",
    "block_facts": f"""WITH {_BLOCKS_SQL}
SELECT b.dialogue_id, b.block_id, count(*) AS facts, array_to_string(list_sort(list(DISTINCT f.type)), ',') AS types
FROM (SELECT dialogue_id, block_id, unnest(patient_turn_ids) AS turn_id FROM blocks) b JOIN (SELECT DISTINCT dialogue_id, turn_id, fact_pos, type FROM facts) f USING (dialogue_id, turn_id) GROUP BY ALL""",
    "session_split_flags": f"""WITH {_BLOCKS_SQL}, fact_rows AS (
  SELECT dialogue_id, turn_id, type, status, list_filter([lower(regexp_replace(coalesce(x, ''), '{_BLANKS_OUT}', '', 'g')) FOR x IN [name, normalized_name, attribute['target']]], lambda n: n <> '') AS names FROM facts
), per AS (
  SELECT b.dialogue_id, b.block_id, flatten(list(names)) AS all_names, coalesce(flatten(list(names) FILTER (type IN ('symptom', 'disease') AND coalesce(status, '') <> 'absent')), []) AS complaints, count(*) AS facts
  FROM (SELECT dialogue_id, block_id, unnest(patient_turn_ids) AS turn_id FROM blocks) b JOIN fact_rows USING (dialogue_id, turn_id) GROUP BY ALL
), texts AS (
  SELECT b.dialogue_id, b.block_id, array_to_string(patient_block, '') AS raw, lower(regexp_replace(array_to_string(patient_block, ''), '{_BLANKS_OUT}', '', 'g')) AS p, lower(regexp_replace(array_to_string(doctor_block, ''), '{_BLANKS_OUT}', '', 'g')) AS d,
    coalesce(all_names, []) AS all_names, coalesce(complaints, []) AS complaints, coalesce(facts, 0) AS facts FROM blocks b LEFT JOIN per USING (dialogue_id, block_id)
), closed AS (
  SELECT *, p <> '' AND length(p) <= 24 AND (contains(p, '谢谢') OR regexp_matches(p, '^(?:{"|".join(PATIENT_CLOSINGS)})')) AND d <> '' AND length(d) <= 50 AND (contains(d, '谢谢') OR regexp_matches(d, '^(?:{"|".join(DOCTOR_CLOSINGS)})')) AS closes FROM texts
), looked AS (
  SELECT *, coalesce(lag(closes) OVER w, FALSE) AS after_closed, flatten(coalesce(list(all_names) OVER (PARTITION BY dialogue_id ORDER BY block_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), [])) AS earlier FROM closed WINDOW w AS (PARTITION BY dialogue_id ORDER BY block_id)
), reasons AS (
  SELECT *, CASE WHEN NOT after_closed OR facts = 0 THEN NULL WHEN regexp_matches(p, '{"|".join(TOPIC_CUES)}') THEN 'topic'
    WHEN len(complaints) > 0 AND regexp_matches(raw, '{"|".join(COMPLAINT_CUES)}') AND NOT list_bool_or(list_transform(complaints, lambda a: len(list_filter(earlier, lambda b: contains(a, b) OR contains(b, a))) > 0)) THEN 'complaint' ELSE 'ambiguous' END AS reason FROM looked)
SELECT dialogue_id, CAST(1 + count(*) FILTER (reason IN ('topic', 'complaint')) AS INTEGER) AS sessions, count(*) FILTER (reason = 'ambiguous') AS ambiguous, count(*) AS blocks FROM reasons GROUP BY dialogue_id""",
    "message_flags": f"""WITH {MESSAGES_SQL}, bare AS (
  SELECT dialogue_id, turn_id, regexp_replace(content, '[。！？!?，,\\s\\p{{Z}}]', '', 'g') AS s, regexp_replace(content, '[。！？!?，,、~～.\\s\\p{{Z}}]', '', 'g') AS c FROM messages_in_order WHERE role = 'user'
), rest AS (
  SELECT *, {_rest("c")} AS left_over FROM bare
), flags AS (
  SELECT dialogue_id, turn_id, s IN ({_list(SHORT_ANSWERS)}) OR length(s) BETWEEN 1 AND 4 AS short,
    c <> '' AND (c IN ({_list(CHATTER)}) OR (NOT regexp_matches(c, '{"|".join(MEDICAL_SIGNALS)}') AND left_over = '')) AS chatter FROM rest)
SELECT * FROM flags WHERE short OR chatter""",
    "block_order_check": f"""SELECT dialogue_id, block_id, before FROM (SELECT dialogue_id, block_id, lag(block_id) OVER (PARTITION BY dialogue_id ORDER BY block_id) AS before
  FROM (SELECT DISTINCT dialogue_id, block_id FROM (SELECT dialogue_id, block_id FROM interviewer_rows UNION ALL VALUES {", ".join(map(str, PLANTED_BLOCKS))}))) WHERE block_id <> coalesce(before, -1) + 1""",
}

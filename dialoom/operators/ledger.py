"""Failures as an event log, resumable work lists and unions by precedence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.operators.dialogue import ordered_messages, select_prefix
from dialoom.session import table


def failure_ledger(events: DataFrame, key: str) -> DataFrame:
    """The keys whose last event is a failure: attempts, first and last stage, last error.

    ``events``: key, ``at, ok, stage, error``; a success clears what failed before it. One aggregation with map-side
    combination and one join on keys; no window, as a key may have any share of all events.
    """
    events = events.where(F.col(key).isNotNull()).distinct()
    success = events.where("ok").groupBy(key).agg(F.max("at").alias("cleared"))
    open_ = events.where("not ok").join(success, key, "left").where("cleared is null or at > cleared")
    order = F.struct("at", F.coalesce("stage", F.lit("")), F.coalesce("error", F.lit("")))
    return open_.groupBy(key).agg(
        F.count("*").alias("attempts"), F.min_by("stage", order).alias("first_stage"), F.max_by("stage", order).alias("last_stage"), F.max_by("error", order).alias("last_error"), F.max("at").alias("updated_at")
    )


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last in ``order``."""
    names = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), order).alias("row")).select(key, "row.*")


def precedence_union(sources: list[DataFrame], key: str) -> DataFrame:
    """Rows of all sources of equal columns; of one key only those of the first source that has it, with ``source``."""
    tagged = None
    for n, source in enumerate(sources):
        rows = source.withColumn("source", F.lit(n))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    best = tagged.groupBy(key).agg(F.min("source").alias("source"))
    return tagged.join(best, [key, "source"])


def pending(selected: DataFrame, *done: DataFrame, key: str = "dialogue_id") -> DataFrame:
    """What is selected and in none of the ``done`` lists."""
    for rows in done:
        selected = selected.join(rows.select(key).distinct(), key, "left_anti")
    return selected


def turn_events(turn_rows: DataFrame) -> DataFrame:
    """Attempts at turns as events of their dialogue: a missing state is a failure."""
    ok = F.col("patient_state_after_turn").isNotNull()
    return turn_rows.select("dialogue_id", F.col("processed_at").alias("at"), ok.alias("ok"), F.concat_ws("/", "model", "api_format").alias("stage"), F.concat(F.lit("turn "), F.col("turn_id").cast("string")).alias("error"))


def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogues whose last attempt failed."""
    return failure_ledger(turn_events(table(spark, sf_dir, "turn_rows")), "dialogue_id").drop("updated_at")


def ledger_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last attempt of every dialogue."""
    rows = turn_events(table(spark, sf_dir, "turn_rows")).groupBy("dialogue_id", "at").agg(F.max(F.struct("ok", "stage", "error")).alias("e")).select("dialogue_id", "at", "e.*")
    return last_wins(rows, "dialogue_id", "at").select("dialogue_id", "ok", "error")


def _dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_messages(table(spark, sf_dir, "messages")).groupBy("dialogue_id").agg(F.min("source_pos").alias("source_pos"), F.count_if(F.col("role") == "user").alias("user_turns"))


def pending_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogues, of all, that have neither questions nor a failure."""
    asked = table(spark, sf_dir, "interviewer_rows").select(F.col("source_dialogue_id").alias("dialogue_id"))
    failed = failure_ledger(turn_events(table(spark, sf_dir, "turn_rows")), "dialogue_id")
    return pending(_dialogues(spark, sf_dir).select("dialogue_id", "source_pos"), asked, failed)


def failed_prefix_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed dialogues of the prefix of 900 dialogues with their place in the source."""
    failed = failure_ledger(turn_events(table(spark, sf_dir, "turn_rows")), "dialogue_id")
    return select_prefix(_dialogues(spark, sf_dir), 900, 1_000_000).select("dialogue_id", "source_pos").join(failed.select("dialogue_id", "attempts"), "dialogue_id")


def precedence_union_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns by dialogue: of coded facts where a dialogue has any, else of uncoded facts, else of processed turns."""
    facts = table(spark, sf_dir, "facts")
    coded = facts.where("standard_code is not null").select("dialogue_id", "turn_id").distinct()
    uncoded = facts.where("standard_code is null").select("dialogue_id", "turn_id").distinct()
    turns = table(spark, sf_dir, "turn_rows").select("dialogue_id", "turn_id").distinct()
    return precedence_union([coded, uncoded, turns], "dialogue_id")


def attempts_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts and retries by model."""
    rows = table(spark, sf_dir, "turn_rows").groupBy("model", "dialogue_id", "turn_id").agg(F.count_distinct("processed_at").alias("attempts"))
    return rows.groupBy("model").agg(F.sum("attempts").alias("attempts"), F.sum(F.greatest(F.lit(0), F.col("attempts") - 1)).alias("retries"), F.count_distinct("dialogue_id").alias("dialogues"))


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogues of which a user message has no processed turn, and how many."""
    said = ordered_messages(table(spark, sf_dir, "messages")).where("role = 'user'").select("dialogue_id", "turn_id")
    turns = table(spark, sf_dir, "turn_rows").select("dialogue_id", "turn_id").distinct()
    return said.join(turns, ["dialogue_id", "turn_id"], "left_anti").groupBy("dialogue_id").agg(F.count("*").alias("missing"))


def consecutive_groups(rows: DataFrame, key: str, order: str) -> DataFrame:
    """``rows`` with ``group``: a change of the key between neighbours in ``order`` begins a new one (by ranges)."""
    from dialoom.operators.dialogue import running_total

    part = F.floor(F.col(order) / 10_000)
    along = Window.partitionBy(part).orderBy(order)
    # the row before a range's first is looked up from the range before
    ends = rows.groupBy(part.alias("p")).agg(F.max_by(key, order).alias("last_key"))
    tagged = rows.withColumn("p", part).withColumn("prev", F.lag(key).over(along)).withColumn("first", F.row_number().over(along) == 1)
    tagged = tagged.join(ends.select((F.col("p") + 1).alias("p"), "last_key"), "p", "left")
    before = F.when(F.col("first"), F.col("last_key")).otherwise(F.col("prev"))
    tagged = tagged.withColumn("starts", F.when(before.eqNullSafe(F.col(key)), 0).otherwise(1)).drop("p", "prev", "first", "last_key")
    return running_total(tagged, order, "starts").withColumn("group", F.col("before") + F.col("starts")).drop("before", "starts")


QUERIES = {
    "ledger_upsert": ledger_upsert, "ledger_last_wins": ledger_last_wins, "pending_antijoin": pending_antijoin, "failed_prefix_semi": failed_prefix_semi,
    "precedence_union": precedence_union_query, "attempts_report": attempts_report, "completeness": completeness,
}

_EVENTS = """events AS (SELECT DISTINCT dialogue_id, processed_at AS tm, patient_state_after_turn IS NOT NULL AS ok, concat_ws('/', model, api_format) AS stage, 'turn ' || turn_id AS error FROM turn_rows),
open_events AS (SELECT e.* FROM events e LEFT JOIN (SELECT dialogue_id, max(tm) AS cleared FROM events WHERE ok GROUP BY ALL) c USING (dialogue_id) WHERE NOT ok AND (cleared IS NULL OR tm > cleared)),
ledger AS (SELECT dialogue_id, count(*) AS attempts, arg_min(stage, (tm, stage, error)) AS first_stage, arg_max(stage, (tm, stage, error)) AS last_stage, arg_max(error, (tm, stage, error)) AS last_error FROM open_events GROUP BY dialogue_id)"""


def _sql() -> dict[str, str]:
    from dialoom.operators.dialogue import MESSAGES_SQL

    every = f"{MESSAGES_SQL}, selected AS (SELECT dialogue_id, min(source_pos) AS source_pos FROM messages_in_order GROUP BY dialogue_id)"
    selected = f"""{MESSAGES_SQL}, selected AS (SELECT dialogue_id, source_pos FROM (SELECT dialogue_id, min(source_pos) AS source_pos, row_number() OVER (ORDER BY min(source_pos)) AS rn FROM messages_in_order GROUP BY dialogue_id) WHERE rn <= 900)"""
    return {
        "ledger_upsert": f"WITH {_EVENTS} SELECT * FROM ledger",
        "ledger_last_wins": f"WITH {_EVENTS} SELECT DISTINCT ON (dialogue_id) dialogue_id, ok, error FROM events ORDER BY dialogue_id, tm DESC, ok DESC, stage DESC, error DESC",
        "pending_antijoin": f"WITH {_EVENTS}, {every} SELECT * FROM selected WHERE dialogue_id NOT IN (SELECT source_dialogue_id FROM interviewer_rows WHERE source_dialogue_id IS NOT NULL) AND dialogue_id NOT IN (SELECT dialogue_id FROM ledger)",
        "failed_prefix_semi": f"WITH {_EVENTS}, {selected} SELECT dialogue_id, source_pos, attempts FROM selected JOIN ledger USING (dialogue_id)",
        "precedence_union": """WITH tagged AS (SELECT DISTINCT dialogue_id, turn_id, 0 AS source FROM facts WHERE standard_code IS NOT NULL UNION ALL SELECT DISTINCT dialogue_id, turn_id, 1 FROM facts WHERE standard_code IS NULL UNION ALL SELECT DISTINCT dialogue_id, turn_id, 2 FROM turn_rows)
SELECT dialogue_id, source, turn_id FROM tagged QUALIFY source = min(source) OVER (PARTITION BY dialogue_id)""",
        "attempts_report": "SELECT model, CAST(sum(n) AS BIGINT) AS attempts, CAST(sum(greatest(0, n - 1)) AS BIGINT) AS retries, count(DISTINCT dialogue_id) AS dialogues FROM (SELECT model, dialogue_id, turn_id, count(DISTINCT processed_at) AS n FROM turn_rows GROUP BY ALL) GROUP BY model",
        "completeness": f"WITH {MESSAGES_SQL} SELECT dialogue_id, count(*) AS missing FROM messages_in_order WHERE role = 'user' AND (dialogue_id, turn_id) NOT IN (SELECT (dialogue_id, turn_id) FROM turn_rows) GROUP BY dialogue_id",
    }


ORACLE_SQL = _sql()

"""Keyed sessions over streams: the state fold per dialogue, and whole consultations with questions.

State is kept per key by Structured Streaming; each micro-batch's rows of a key are put in their order first. A request
is applied as a whole or not at all: state, history and counters are written together after every step has succeeded.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dialoom.functions.lexicon import CHATTER, MEDICAL_SIGNALS
from dialoom.operators.facts import latest_turns
from dialoom.operators.state import ALL_BUCKETS, StateFold
from dialoom.session import checkpoint_dir, table
from dialoom.streaming.clients import RuleModel, TextModel, asked_question, extracted_turn

HISTORY = 4

_FOLD_OUT = "dialogue_id string, last_turn_id int, chief_complaint string, " + ", ".join(f"{b} int" for b in ALL_BUCKETS)
_SESSION_OUT = "session_id string, seq long, ok boolean, error string, action string, utterance string, turn_count int, problems int"


def step_session(state: dict | None, request: dict, model: TextModel, history: int = HISTORY) -> tuple[dict | None, dict]:
    """The state after a request and the response. A reset clears first, even if the request is then refused."""
    key = request.get("session_id") or "default"
    if request.get("reset"):
        state = None
    session = state or {"medical_state": StateFold(key).as_dict(), "asked": [], "turn_count": 0, "ended": False, "history": [], "question": None}

    def refused(why: str) -> tuple[dict | None, dict]:
        return state, {"ok": False, "error": why, "action": None, "utterance": None, "turn_count": session["turn_count"], "problems": len(session["medical_state"]["problems"])}

    utterance = (request.get("patient_utterance") or "").strip()
    if not utterance:
        return refused("patient_utterance is empty")
    if session["ended"]:
        return refused("session has ended")
    try:
        fold = StateFold(key, session["medical_state"])
        fold.take_turn(model.extract(utterance, session["question"], session["medical_state"]), session["turn_count"], session["question"])
        medical = fold.as_dict()
        decision = model.ask(medical, session["asked"])
    except Exception as e:  # nothing of the request is kept
        return refused(str(e))
    asks = decision["action"] == "ask"
    said = [{"role": "user", "content": utterance}] + ([{"role": "assistant", "content": decision["utterance"]}] if asks else [])
    new = {
        "medical_state": medical, "asked": session["asked"] + ([decision["target"]] if asks else []), "turn_count": session["turn_count"] + 1, "ended": not asks,
        "history": (session["history"] + said)[-history:], "question": decision["utterance"] if asks else None,
    }
    return new, {"ok": True, "error": None, "action": decision["action"], "utterance": decision["utterance"], "turn_count": new["turn_count"], "problems": len(medical["problems"])}


def session_stream(requests: DataFrame, model: TextModel, history: int = HISTORY) -> DataFrame:
    """A response per request (``session_id, seq, patient_utterance, reset``) of a stream, in the order of ``seq`` per session."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = json.loads(state.get[0]) if state.exists else None
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for row in rows.to_dict("records"):
            now, response = step_session(now, row, model, history)
            out.append({"session_id": key[0], "seq": row["seq"]} | response)
        if now is None:
            state.remove()
        else:
            state.update((json.dumps(now, ensure_ascii=False),))
        yield pd.DataFrame(out)

    keyed = requests.withColumn("session_id", F.coalesce("session_id", F.lit("default")))
    return keyed.groupBy("session_id").applyInPandasWithState(run, _SESSION_OUT, "session string", "append", GroupStateTimeout.NoTimeout)


_QUESTION_OUT = "session_id string, seq long, ok boolean, error string, action string, utterance string, turn_count int"


def step_questions(control: dict | None, request: dict, model: TextModel) -> tuple[dict | None, dict]:
    """As :func:`step_session` where the request brings the state (JSON): only what was asked is kept. Ended ones go on."""
    if request.get("reset"):
        control = None
    now = control or {"asked": [], "turn_count": 0, "ended": False}
    try:
        state = json.loads(request.get("state") or "{}")
        if not isinstance(state, dict):
            raise ValueError("state is no object")
        decision, _ = asked_question(model, state, now["asked"])
    except Exception as e:  # nothing of the request is kept
        return control, {"ok": False, "error": str(e), "action": None, "utterance": None, "turn_count": now["turn_count"]}
    asks = decision["action"] == "ask"
    new = {"asked": now["asked"] + ([decision["target"]] if asks else []), "turn_count": now["turn_count"] + 1, "ended": not asks}
    return new, {"ok": True, "error": None, "action": decision["action"], "utterance": decision["utterance"], "turn_count": new["turn_count"]}


def question_stream(requests: DataFrame, model: TextModel) -> DataFrame:
    """A question per request (``session_id, seq, state, reset``) of a stream, in the order of ``seq`` per session."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = json.loads(state.get[0]) if state.exists else None
        out = []
        for row in pd.concat(list(batches)).sort_values("seq").to_dict("records"):
            now, response = step_questions(now, row, model)
            out.append({"session_id": key[0], "seq": row["seq"]} | response)
        if now is None:
            state.remove()
        else:
            state.update((json.dumps(now, ensure_ascii=False),))
        yield pd.DataFrame(out)

    keyed = requests.withColumn("session_id", F.coalesce("session_id", F.lit("default")))
    return keyed.groupBy("session_id").applyInPandasWithState(run, _QUESTION_OUT, "control string", "append", GroupStateTimeout.NoTimeout)


_TURN_OUT = "dialogue_id string, turn_id int, ok boolean, error string, calls int, facts int, problems int"


def synthesized_turns(turns: DataFrame, model: TextModel, attempts: int = 3) -> DataFrame:
    """``turns`` (``dialogue_id, turn_id, question, utterance``) read by a model, in their order: one row per turn.

    The state goes from turn to turn; after a turn that fails, the rest of its dialogue is left undone, as it would
    build on a gap. Rows stream through the tasks, which hold the state of the present dialogue alone.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fold, failed = StateFold(None), False
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                if fold.dialogue_id != row["dialogue_id"]:
                    fold, failed = StateFold(row["dialogue_id"]), False
                error, calls, facts = "a turn before failed", 0, []
                if not failed:
                    try:
                        facts, calls = extracted_turn(model, row["utterance"] or "", row["question"], fold.as_dict(), attempts)
                        fold.take_turn(facts, int(row["turn_id"]), row["question"])
                        error = None
                    except Exception as e:  # told in the row; the ledger takes it from there
                        failed, error, calls = True, str(e), attempts
                out.append({"dialogue_id": row["dialogue_id"], "turn_id": row["turn_id"], "ok": error is None, "error": error, "calls": calls, "facts": len(facts), "problems": len(fold.buckets["problems"])})
            if out:
                yield pd.DataFrame(out)

    rows = turns.select("dialogue_id", "turn_id", "question", "utterance").repartition("dialogue_id").sortWithinPartitions("dialogue_id", "turn_id")
    return rows.mapInPandas(run, _TURN_OUT)


def synthesized_sessions(blocks: DataFrame, model: TextModel, attempts: int = 3) -> DataFrame:
    """``blocks`` (``dialogue_id, block_id, state`` as JSON, ``is_terminal``) with the model's decision: one row per block.

    A terminal block ends without a call. The targets that were asked go from block to block of a session.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, asked = None, []
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                if now != row["dialogue_id"]:
                    now, asked = row["dialogue_id"], []
                error, calls, decision = None, 0, {"action": "end", "target": None, "utterance": ""}
                if not row["is_terminal"]:
                    try:
                        decision, calls = asked_question(model, json.loads(row["state"] or "{}"), asked, attempts)
                    except Exception as e:
                        error, calls, decision = str(e), attempts, {"action": None, "target": None, "utterance": None}
                if decision["action"] == "ask":
                    asked = [*asked, decision["target"]]
                out.append({"dialogue_id": row["dialogue_id"], "block_id": row["block_id"], "ok": error is None, "error": error, "calls": calls, "action": decision["action"], "utterance": decision["utterance"]})
            if out:
                yield pd.DataFrame(out)

    rows = blocks.select("dialogue_id", "block_id", "state", "is_terminal").repartition("dialogue_id").sortWithinPartitions("dialogue_id", "block_id")
    return rows.mapInPandas(run, "dialogue_id string, block_id int, ok boolean, error string, calls int, action string, utterance string")


def fact_stream(facts: DataFrame) -> DataFrame:
    """The state of each dialogue after each micro-batch of its ``facts``; facts of a batch in the order of turn and place.

    Of facts of one place that come twice in a batch one counts; a later copy merges into what is known.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        fold = StateFold(key[0], json.loads(state.get[0]) if state.exists else None)
        rows = pd.concat(list(batches)).drop_duplicates(["turn_id", "fact_pos"]).sort_values(["turn_id", "fact_pos"])
        last = None
        for row in rows.to_dict("records"):
            attribute = row["attribute"]
            row["attribute"] = dict(attribute) if attribute is not None else {}
            last = int(row["turn_id"])
            fold.take(row, last)
        now = fold.as_dict()
        state.update((json.dumps(now, ensure_ascii=False),))
        yield pd.DataFrame([{"dialogue_id": key[0], "last_turn_id": last, "chief_complaint": fold.chief_complaint} | {b: len(now[b]) for b in ALL_BUCKETS}])

    return facts.groupBy("dialogue_id").applyInPandasWithState(run, _FOLD_OUT, "state string", "append", GroupStateTimeout.NoTimeout)


def run_to_table(stream: DataFrame, path: str | None = None) -> DataFrame:
    """All that is available of a stream, run to its end into the shared folder, as a table."""
    spark = stream.sparkSession
    path = path or f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    query = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/progress").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream. The pattern in the path lets it be one file or a folder of files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def stream_keyed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state fold over facts read as a stream."""
    facts = stream_table(spark, sf_dir, "facts").where("dialogue_id is not null and turn_id is not null")
    return run_to_table(fact_stream(facts))


#: Names that the offline stand-in knows.
STAND_IN = {"腹痛": "symptom", "腹泻": "symptom", "恶心": "symptom", "发热": "symptom", "胃炎": "disease"}


def synthesized_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns read by the offline stand-in: turns, calls and facts by outcome."""
    turns = latest_turns(table(spark, sf_dir, "turn_rows").select("dialogue_id", "turn_id", "previous_doctor_question", "patient_utterance", "processed_at"))
    rows = turns.select("dialogue_id", "turn_id", F.col("previous_doctor_question").alias("question"), F.col("patient_utterance").alias("utterance"))
    return synthesized_turns(rows, RuleModel(STAND_IN)).groupBy("ok").agg(F.count("*").alias("turns"), F.sum("calls").alias("calls"), F.sum("facts").alias("facts"))


def event_time_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by day of receipt as a stream with a watermark, closed days only."""
    rows = stream_table(spark, sf_dir, "messages").withColumn("at", F.col("received_at").cast("timestamp"))
    days = rows.withWatermark("at", "2 days").groupBy(F.window("at", "1 day")).agg(F.count("*").alias("n"))
    return run_to_table(days.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n"))


QUERIES = {"stream_keyed_state": stream_keyed_state, "synthesized_reads": synthesized_reads, "stream_event_time_counts": event_time_counts}
_STAND_IN_NAMES = "|".join(sorted(STAND_IN))
_REST = "c"
for _phrase in sorted(CHATTER, key=lambda p: (-len(p), p)):
    _REST = f"replace({_REST}, '{_phrase}', '')"
ORACLE_SQL = {
    "synthesized_reads": f"""WITH turns AS (SELECT dialogue_id, turn_id, coalesce(arg_max({{'u': patient_utterance}}, processed_at).u, '') AS u FROM turn_rows GROUP BY ALL), bare AS (
  SELECT *, regexp_replace(u, '[。！？!?，,、~～.\\s\\p{{Z}}]', '', 'g') AS c FROM turns
), told AS (SELECT *, c <> '' AND (c IN ({", ".join(f"'{w}'" for w in CHATTER)}) OR ({_REST} = '' AND NOT regexp_matches(c, '{"|".join(MEDICAL_SIGNALS)}'))) AS courtesy FROM bare)
SELECT TRUE AS ok, count(*) AS turns, count(*) FILTER (NOT courtesy) AS calls, CAST(sum(CASE WHEN courtesy THEN 0 ELSE len(regexp_extract_all(u, '{_STAND_IN_NAMES}')) END) AS BIGINT) AS facts FROM told""",
    "stream_event_time_counts": """
SELECT strftime(date_trunc('day', received_at), '%Y-%m-%d') AS day, count(*) AS n FROM messages
WHERE date_trunc('day', received_at) + INTERVAL 1 DAY <= (SELECT max(received_at) - INTERVAL 2 DAY FROM messages) GROUP BY 1"""
}

"""The state of a dialogue: one reducer, folded over sorted rows in batch and over arriving rows in a stream.

``StateFold`` is plain Python: it takes the facts of a turn and keeps what is known. A fact of an entity that is known
already is merged into it; a fact of the opposite status replaces it; attributes go to the one entity they name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dialoom.functions.lexicon import ATTRIBUTE_CUES, BUCKETS, FORBIDDEN_KEYS, STATE_KEYS, UNKNOWN_TARGETS
from dialoom.operators.facts import distinct_facts, latest_turns
from dialoom.session import table

ITEM_DDL = (
    "struct<name:string,normalized_name:string,type:string,status:string,subject:string,standard_code:string,terminology:string,aliases:array<string>,time:string,body_part:string,"
    "attributes:map<string,string>,evidence:array<struct<turn_id:int,text:string>>,first_turn_id:int,last_turn_id:int>"
)
ALL_BUCKETS = [*BUCKETS[:2], "uncertain_findings", *BUCKETS[2:]]
STATE_DDL = "struct<dialogue_id:string,chief_complaint:string," + ",".join(f"{b}:array<{ITEM_DDL}>" for b in ALL_BUCKETS) + ">"

#: Where a fact of a type goes if it is present and no problem.
HOME = {"medicine": "medications", "examination": "examinations", "history": "histories", "lifestyle": "lifestyle"}


def parts_of(value: object) -> list[str]:
    """Distinct, trimmed parts of a value that is a list or a text joined by ``；``."""
    raw = value if isinstance(value, list) else [] if value in (None, "") else [value]
    return list(dict.fromkeys(p for v in raw for p in map(str.strip, str(v).split("；")) if p))


def _text(value: object) -> str:
    return str(value or "").strip()


@dataclass
class Item:
    """An entity of the state."""

    name: str | None
    normalized_name: str | None
    type: str | None
    status: str | None
    subject: str | None
    standard_code: str | None = None
    terminology: str | None = None
    aliases: list[str] = field(default_factory=list)
    time: str | None = None
    body_part: str | None = None
    attributes: dict[str, str] = field(default_factory=dict)
    evidence: list[dict] = field(default_factory=list)
    first_turn_id: int | None = None
    last_turn_id: int | None = None

    @classmethod
    def of(cls, fact: dict, turn: int | None) -> Item:
        raw = fact.get("attribute") or {}
        kept = {str(k): "；".join(parts_of(v)) for k, v in raw.items() if k not in FORBIDDEN_KEYS and v not in (None, "")}
        said = [{"turn_id": turn, "text": fact["evidence"]}] if fact.get("evidence") else []
        given = {k: fact.get(k) for k in ("name", "type", "status", "subject", "standard_code", "terminology", "time", "body_part")}
        return cls(normalized_name=fact.get("normalized_name") or fact.get("name"), attributes=kept, evidence=said, first_turn_id=turn, last_turn_id=turn, **given)

    @classmethod
    def load(cls, row: dict) -> Item:
        row = dict(row)
        row["attributes"] = dict(row.get("attributes") or {})
        row["aliases"] = list(row.get("aliases") or [])
        row["evidence"] = [dict(e) for e in row.get("evidence") or []]
        return cls(**row)

    @property
    def names(self) -> set[str]:
        return {n for n in map(_text, (self.name, self.normalized_name, *self.aliases)) if n}

    @property
    def code(self) -> tuple[str, str] | None:
        return (self.terminology, self.standard_code) if self.terminology and self.standard_code else None

    def same_entity(self, other: Item) -> bool:
        """Same code if either has one, else a common name; and same type and subject."""
        alike = self.code == other.code if self.code or other.code else bool(self.names & other.names)
        return alike and (self.type, self.subject) == (other.type, other.subject)

    def set_attribute(self, key: str, value: object) -> None:
        if new := parts_of(value):
            self.attributes[key] = "；".join(dict.fromkeys([*parts_of(self.attributes.get(key)), *new]))

    def add_evidence(self, evidence: list[dict]) -> None:
        self.evidence += [e for e in evidence if e not in self.evidence]

    def absorb(self, new: Item) -> Item:
        """Takes over what ``new`` adds."""
        self.last_turn_id = new.last_turn_id
        for name in ("standard_code", "terminology", "time", "body_part"):
            if not getattr(self, name) and getattr(new, name):
                setattr(self, name, getattr(new, name))
        known = {_text(self.name), _text(self.normalized_name), *self.aliases}
        for alias in map(_text, (*new.aliases, new.name, new.normalized_name)):
            if alias and alias not in known:
                self.aliases.append(alias)
                known.add(alias)
        if self.normalized_name == self.name and new.normalized_name:
            self.normalized_name = new.normalized_name
        for key, value in new.attributes.items():
            self.set_attribute(key, value)
        self.add_evidence(new.evidence)
        return self

    def continued_by(self, new: Item) -> bool:
        """Whether ``new`` only describes this problem further."""
        if not new.attributes:
            return False
        return any(a in b or b in a or (a.endswith("痛") and b.endswith("痛") and len(b) <= 3) for a in self.names for b in new.names)


class StateFold:
    """What is known of one dialogue."""

    def __init__(self, dialogue_id: str | None, state: dict | None = None) -> None:
        self.dialogue_id = dialogue_id
        self.chief_complaint: str | None = (state or {}).get("chief_complaint")
        self.buckets: dict[str, list[Item]] = {b: [Item.load(i) for i in (state or {}).get(b) or []] for b in ALL_BUCKETS}

    def as_dict(self) -> dict:
        items = {b: [vars(i) | {"aliases": list(i.aliases), "attributes": dict(i.attributes), "evidence": [dict(e) for e in i.evidence]} for i in own] for b, own in self.buckets.items()}
        return {"dialogue_id": self.dialogue_id, "chief_complaint": self.chief_complaint} | items

    def active_target(self, question: str | None) -> str | None:
        """The only problem of the latest turn, if the question asks for an attribute."""
        problems = self.buckets["problems"]
        if not problems or not any(cue in (question or "") for cue in ATTRIBUTE_CUES):
            return None
        latest = max(p.last_turn_id or -1 for p in problems)
        near = [p for p in problems if (p.last_turn_id or -1) == latest]
        return (_text(near[0].normalized_name or near[0].name) or None) if len(near) == 1 else None

    def attribute_home(self, target: str) -> Item | None:
        """The one entity that ``target`` names: exactly, else as part of a name or the other way round."""
        if target in UNKNOWN_TARGETS:
            return None
        items = [i for b in ("problems", "medications", "examinations") for i in self.buckets[b]]
        exact = [i for i in items if target in i.names]
        found = exact or [i for i in items if any(target in n or n in target for n in i.names)]
        return found[0] if len(found) == 1 else None

    def _merge_into(self, bucket: str, item: Item) -> Item:
        for known in self.buckets[bucket]:
            if known.same_entity(item) and known.status == item.status:
                return known.absorb(item)
        self.buckets[bucket].append(item)
        return item

    def _take_attribute(self, fact: dict, item: Item, turn: int | None) -> None:
        given = fact.get("attribute") or {}
        home = self.attribute_home(_text(given.get("target")))
        if home is None:  # kept on its own, one item per target
            target = _text(item.attributes.get("target"))
            for known in self.buckets["other_facts"]:
                if known.type == "attribute" and _text(known.attributes.get("target")) == target and (known.status, known.subject) == (item.status, item.subject):
                    known.absorb(item)
                    return
            self.buckets["other_facts"].append(item)
            return
        label = str(fact.get("normalized_name") or fact.get("name") or "")
        if (value := given.get("value")) is not None:
            key = STATE_KEYS.get(label, label or "attribute")
            home.set_attribute(key, value)
            if key == "course_duration" and not home.time:
                home.time = value
        for key, other in given.items():
            if key not in ("target", "value"):
                home.set_attribute(STATE_KEYS.get(str(key), str(key)), other)
        for name in ("time", "body_part"):
            if fact.get(name) and not getattr(home, name):
                setattr(home, name, fact[name])
        home.add_evidence(item.evidence)
        home.last_turn_id = turn

    def _take_problem(self, item: Item, active: str | None) -> Item:
        problems = self.buckets["problems"]
        for known in problems:
            if known.same_entity(item):
                return known.absorb(item)
        named = [p for p in problems if active and active in p.names]
        if len(named) == 1 and named[0].continued_by(item):
            return named[0].absorb(item)
        problems.append(item)
        return item

    def take(self, fact: dict, turn: int | None, active: str | None = None) -> None:
        """Adds one fact."""
        if not _text(fact.get("normalized_name") or fact.get("name")):
            return
        item = Item.of(fact, turn)
        if item.type == "attribute":
            self._take_attribute(fact, item, turn)
            return
        for bucket in BUCKETS:  # the opposite status no longer holds
            self.buckets[bucket] = [k for k in self.buckets[bucket] if k.status == item.status or not k.same_entity(item)]
        if item.type in ("symptom", "disease") and item.status == "present":
            problem = self._take_problem(item, active)
            if self.chief_complaint is None and item.type == "symptom":
                self.chief_complaint = problem.normalized_name
        elif item.status == "absent":
            self._merge_into("negative_findings", item)
        elif item.status == "uncertain" and item.type in ("symptom", "disease", "other"):
            self._merge_into("uncertain_findings", item)
        else:
            self._merge_into(HOME.get(item.type, "other_facts"), item)

    def take_turn(self, facts: Iterable[dict], turn: int | None, question: str | None = None) -> None:
        """Adds the facts of a turn; ``question`` is what the doctor asked before it."""
        active = self.active_target(question)
        for fact in facts:
            self.take(fact, turn, active)


def _fold(batches: Iterator[pa.RecordBatch], schema: pa.Schema, last_only: bool) -> Iterator[pa.RecordBatch]:
    fold: StateFold | None = None
    pending: tuple | None = None

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"dialogue_id": d, "turn_id": t, "state": s} for d, t, s in rows], schema=schema)

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if fold is None or fold.dialogue_id != row["dialogue_id"]:
                if pending and last_only:
                    out.append(pending)
                fold, pending = StateFold(row["dialogue_id"]), None
            facts = [f | {"attribute": dict(f["attribute"] or {})} for f in row["facts"] or []]
            fold.take_turn(facts, row["turn_id"], row["question"])
            if last_only:
                pending = (row["dialogue_id"], row["turn_id"], fold)
                continue
            out.append((row["dialogue_id"], row["turn_id"], fold.as_dict()))
        if last_only:
            out = [(d, t, s.as_dict() if isinstance(s, StateFold) else s) for d, t, s in out]
        if out:
            yield emit(out)
    if last_only and pending:
        yield emit([(pending[0], pending[1], pending[2].as_dict())])


def fold_states(turns: DataFrame, last_only: bool = False) -> DataFrame:
    """``dialogue_id, turn_id, state`` after every turn (or the last one) of ``turns``.

    ``turns``: ``dialogue_id, turn_id, question, facts ARRAY<fact>``. The fold is a recurrence, so a dialogue's turns
    go through one task in their order; rows stream through it and only the state of the present dialogue is held.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType.fromDDL(f"dialogue_id string, turn_id int, state {STATE_DDL}")
    arrow = to_arrow_schema(schema)
    rows = turns.select("dialogue_id", "turn_id", "question", "facts").repartition("dialogue_id").sortWithinPartitions("dialogue_id", "turn_id")
    return rows.mapInArrow(lambda batches: _fold(batches, arrow, last_only), schema)


def turn_facts(facts: DataFrame, turn_rows: DataFrame | None = None) -> DataFrame:
    """Facts by turn in their order, with the question before the turn."""
    fact = F.struct("fact_pos", *[c for c in facts.columns if c not in ("dialogue_id", "turn_id", "fact_pos")])
    ordered = F.transform(F.array_sort(F.collect_list(fact), lambda a, b: a["fact_pos"] - b["fact_pos"]), lambda f: f.dropFields("fact_pos"))
    turns = facts.groupBy("dialogue_id", "turn_id").agg(ordered.alias("facts"))
    if turn_rows is None:
        return turns.withColumn("question", F.lit(None).cast("string"))
    asked = latest_turns(turn_rows.select("dialogue_id", "turn_id", "previous_doctor_question", "processed_at"))
    return turns.join(asked.select("dialogue_id", "turn_id", F.col("previous_doctor_question").alias("question")), ["dialogue_id", "turn_id"], "left")


def state_full_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last state of every dialogue: its complaint and the entries of each bucket."""
    turns = turn_facts(distinct_facts(table(spark, sf_dir, "facts")), table(spark, sf_dir, "turn_rows"))
    return fold_states(turns, last_only=True).select("dialogue_id", "turn_id", "state.chief_complaint", *(F.size(f"state.{b}").alias(b) for b in ALL_BUCKETS))


def state_coded_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold of :class:`StateFold` over the coded facts: every item of the last state of every dialogue.

    With codes alone it is plain which entity a fact is of, so that SQL can tell the outcome in closed form.
    """
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    coded = facts.where("coalesce(standard_code, '') <> '' and coalesce(terminology, '') <> '' and type <> 'attribute' and status in ('present', 'absent')")
    states = fold_states(turn_facts(coded), last_only=True)
    items = state_items(states, ALL_BUCKETS)
    return items.select("dialogue_id", "bucket", "terminology", "standard_code", "type", "subject", "status", "first_turn_id", "last_turn_id", F.size("evidence").alias("evidence"))


def state_differences(folded: DataFrame, stored: DataFrame) -> DataFrame:
    """``dialogue_id, turn_id, differs``: the parts in which a folded state and the stored one of its turn name other things."""
    old = stored.select("dialogue_id", "turn_id", F.col("state").alias("stored"))
    rows = folded.join(old, ["dialogue_id", "turn_id"])

    def named(state: Column, bucket: str) -> Column:
        items = F.coalesce(state[bucket], F.array().cast(f"array<{ITEM_DDL}>"))
        return F.array_sort(F.transform(items, lambda i: F.concat_ws("/", F.coalesce(i["normalized_name"], i["name"]), i["type"], i["status"])))

    parts = [F.when(~named(F.col("state"), b).eqNullSafe(named(F.col("stored"), b)), b) for b in ALL_BUCKETS]
    chief = F.when(~F.col("state.chief_complaint").eqNullSafe(F.col("stored.chief_complaint")), "chief_complaint")
    return rows.select("dialogue_id", "turn_id", F.filter(F.array(chief, *parts), lambda d: d.isNotNull()).alias("differs"))


def replayed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of all dialogues replayed turn by turn against the stored states: turns, and how many differ in each part."""
    turns = turn_facts(distinct_facts(table(spark, sf_dir, "facts")), table(spark, sf_dir, "turn_rows"))
    rows = state_differences(fold_states(turns), _states(spark, sf_dir))
    counts = [F.count_if(F.array_contains("differs", b)).alias(b) for b in ("chief_complaint", *ALL_BUCKETS)]
    return rows.agg(F.count("*").alias("turns"), F.count_if(F.size("differs") == 0).alias("same"), *counts)


def state_core_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of every dialogue in closed form: last status, first and last turn since it, and its pieces of evidence.

    Runs of one status per entity, by windows over the dialogue's own facts.
    """
    facts = distinct_facts(table(spark, sf_dir, "facts")).where("type <> 'attribute'")
    entity = F.coalesce(F.concat_ws("#", "terminology", "standard_code"), F.lit(""))
    entity = F.when(F.col("standard_code").isNotNull(), entity).otherwise(F.coalesce("normalized_name", "name"))
    rows = facts.withColumn("entity", entity).where("entity is not null and status is not null")
    along = Window.partitionBy("dialogue_id", "type", "subject", "entity").orderBy("turn_id", "fact_pos")
    rows = rows.withColumn("flip", F.when(F.lag("status").over(along) == F.col("status"), 0).otherwise(1)).withColumn("run", F.sum("flip").over(along))
    runs = rows.groupBy("dialogue_id", "type", "subject", "entity", "run").agg(F.first("status").alias("status"), F.min("turn_id").alias("first_turn"), F.max("turn_id").alias("last_turn"), F.count_distinct("turn_id", "evidence").alias("evidence"))
    last = F.max_by(F.struct("status", "first_turn", "last_turn", "evidence"), "run").alias("last")
    return runs.groupBy("dialogue_id", "type", "subject", "entity").agg(last).select("dialogue_id", "type", "subject", "entity", "last.*")


def state_items(states: DataFrame, buckets: list[str] = BUCKETS) -> DataFrame:
    """``dialogue_id, turn_id, bucket, pos`` and the fields of every item of ``states`` (``…, state``)."""

    def typed(bucket: str) -> Column:
        return F.transform(F.coalesce(F.col("state")[bucket], F.array().cast(f"array<{ITEM_DDL}>")), lambda i, p: F.struct(F.lit(bucket).alias("bucket"), p.alias("pos"), i.alias("item")))

    return states.select("dialogue_id", "turn_id", F.inline(F.concat(*map(typed, buckets)))).select("dialogue_id", "turn_id", "bucket", "pos", "item.*")


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_turns(table(spark, sf_dir, "turn_rows").select("dialogue_id", "turn_id", "patient_state_after_turn", "processed_at"))
    return rows.select("dialogue_id", "turn_id", F.col("patient_state_after_turn").alias("state")).where("state is not null")


def state_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as the next question sees them: by name, without codes and evidence; nameless ones left out; counted."""
    items = state_items(_states(spark, sf_dir))
    name = F.coalesce(F.nullif(F.trim("normalized_name"), F.lit("")), F.nullif(F.trim("name"), F.lit("")))
    return items.select("dialogue_id", "bucket", name.alias("name"), "type", "status").where("name is not null").groupBy("bucket", "name", "type", "status").agg(F.count("*").alias("n"), F.count_distinct("dialogue_id").alias("dialogues"))


#: Items of states that the check of a transition must name, beside those of the table, and sound ones.
PLANTED_ITEMS = [
    ("planted", 0, "disease", "patient", "ICD-10-CN", "K29", "severity", "轻"), ("planted", 0, "disease", "patient", "ICD-10-CN", "K29", "time", "夜间；午后"), ("planted", 1, "symptom", "patient", "ICD-10-CN", "R10", "time", "夜间；午后；夜间"),
    ("planted", 2, "disease", "patient", "ICD-10-CN", "K29", "severity", "轻"), ("planted", 2, "disease", "family", "ICD-10-CN", "K29", "severity", "重"),
]


def state_transition_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that a state, of the table or planted, has twice, and attribute values with a part twice."""
    fields = ["dialogue_id", "turn_id", "type", "subject", "terminology", "standard_code", "attributes"]
    planted = spark.createDataFrame(PLANTED_ITEMS, "dialogue_id string, turn_id int, type string, subject string, terminology string, standard_code string, key string, value string")
    planted = planted.withColumn("attributes", F.create_map("key", "value")).select(fields)
    items = state_items(_states(spark, sf_dir)).select(fields).unionByName(planted)
    twice = items.where("standard_code is not null and terminology is not null").groupBy("dialogue_id", "turn_id", "terminology", "standard_code", "type", "subject").agg(F.count("*").alias("n")).where("n > 1")
    codes = twice.select("dialogue_id", "turn_id", F.lit("duplicate code").alias("error"), F.col("standard_code").alias("what"))
    values = items.select("dialogue_id", "turn_id", F.explode("attributes").alias("key", "value"))
    parts = F.split("value", "；")
    values = values.where(F.size(parts) != F.size(F.array_distinct(parts))).select("dialogue_id", "turn_id", F.lit("duplicate part").alias("error"), F.concat("key", F.lit("="), "value").alias("what"))
    return codes.unionByName(values).distinct()


def names_of(item: Column) -> Column:
    """Sorted names and aliases of an item."""
    return F.array_sort(F.array_distinct(F.filter(F.concat(F.array(F.trim(item["name"]), F.trim(item["normalized_name"])), F.coalesce(item["aliases"], F.array().cast("array<string>"))), lambda n: F.coalesce(n != "", F.lit(False)))))


def with_previous(states: DataFrame) -> DataFrame:
    """States with ``before``, the state of the turn before."""
    return states.withColumn("before", F.lag("state").over(Window.partitionBy("dialogue_id").orderBy("turn_id")))


def _flat(state: Column) -> Column:
    return F.concat(*(F.coalesce(state[b], F.array().cast(f"array<{ITEM_DDL}>")) for b in BUCKETS))


def state_new_items_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a state that the state before it hasn't, by names, type, status and subject; counted per turn."""

    def signature(i: Column) -> Column:
        return F.struct(names_of(i).alias("names"), i["type"].alias("type"), i["status"].alias("status"), i["subject"].alias("subject"))

    rows = with_previous(_states(spark, sf_dir))
    new = F.array_except(F.transform(_flat(F.col("state")), signature), F.coalesce(F.transform(_flat(F.col("before")), signature), F.array().cast("array<struct<names:array<string>,type:string,status:string,subject:string>>")))
    return rows.select("dialogue_id", "turn_id", F.size(new).alias("new_items")).where("new_items > 0")


def state_new_attributes_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes that problems got since the state before: dialogue, turn, name and key."""
    items = state_items(_states(spark, sf_dir), ["problems"])
    turns = _states(spark, sf_dir).select("dialogue_id", "turn_id", F.lag("turn_id").over(Window.partitionBy("dialogue_id").orderBy("turn_id")).alias("before_turn"))
    now = items.join(turns.where("before_turn is not null"), ["dialogue_id", "turn_id"])
    one = F.min_by("attributes", "pos").alias("old")
    old = items.groupBy("dialogue_id", F.col("turn_id").alias("before_turn"), "normalized_name", "type", "status", "subject").agg(one)
    both = now.join(old, ["dialogue_id", "before_turn", "normalized_name", "type", "status", "subject"])
    filled = F.map_filter(F.coalesce("attributes", F.create_map().cast("map<string,string>")), lambda k, v: F.coalesce(F.trim(v) != "", F.lit(False)) & (F.coalesce(F.trim(F.col("old")[k]), F.lit("")) == ""))
    return both.select("dialogue_id", "turn_id", "normalized_name", F.explode(F.map_keys(filled)).alias("key")).distinct()


def checkpoint_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last turn of every dialogue and how many problems its state has."""
    rows = _states(spark, sf_dir).groupBy("dialogue_id").agg(F.max("turn_id").alias("completed_turn_id"), F.max_by(F.size("state.problems"), "turn_id").alias("problems"))
    return rows.select("dialogue_id", "completed_turn_id", F.coalesce("problems", F.lit(0)).alias("problems"))


QUERIES = {
    "state_core_fold": state_core_fold, "state_full_fold": state_full_fold, "state_coded_fold": state_coded_fold, "replayed_states": replayed_states, "state_projection": state_projection, "state_transition_errors": state_transition_errors,
    "state_new_items_delta": state_new_items_delta, "state_new_attributes_delta": state_new_attributes_delta, "checkpoint_rows": checkpoint_rows,
}

_STATES = """states AS (
  SELECT dialogue_id, turn_id, s FROM (SELECT dialogue_id, turn_id, arg_max({'s': patient_state_after_turn}, processed_at).s AS s FROM turn_rows GROUP BY ALL) WHERE s IS NOT NULL)"""
_ITEMS = "items AS (\n  " + "\n  UNION ALL ".join(f"SELECT dialogue_id, turn_id, '{b}' AS bucket, unnest(s.{b}) AS i FROM states" for b in BUCKETS) + ")"
_SIGNATURES = "[{'n': list_sort(list_distinct(list_filter(list_concat([trim(i.name, ' '), trim(i.normalized_name, ' ')], coalesce(i.aliases, [])), lambda n: coalesce(n, '') <> ''))), 't': i.type, 's': i.status, 'u': i.subject} FOR i IN flatten([" + ", ".join(f"coalesce(s.{b}, [])" for b in BUCKETS) + "])]"
ORACLE_SQL = {
    "state_core_fold": """WITH facts_once AS (SELECT DISTINCT ON (dialogue_id, turn_id, fact_pos) * FROM facts), rows_ AS (
  SELECT *, CASE WHEN standard_code IS NOT NULL THEN concat_ws('#', terminology, standard_code) ELSE coalesce(normalized_name, name) END AS entity FROM facts_once WHERE type <> 'attribute'
), flips AS (
  SELECT *, CASE WHEN lag(status) OVER w = status THEN 0 ELSE 1 END AS flip FROM rows_ WHERE entity IS NOT NULL AND status IS NOT NULL WINDOW w AS (PARTITION BY dialogue_id, type, subject, entity ORDER BY turn_id, fact_pos)
), runs AS (
  SELECT *, sum(flip) OVER (PARTITION BY dialogue_id, type, subject, entity ORDER BY turn_id, fact_pos) AS run FROM flips
), grouped AS (
  SELECT dialogue_id, type, subject, entity, run, min(status) AS status, min(turn_id) AS first_turn, max(turn_id) AS last_turn, count(DISTINCT (turn_id, evidence)) FILTER (evidence IS NOT NULL) AS evidence FROM runs GROUP BY ALL)
SELECT DISTINCT ON (dialogue_id, type, subject, entity) dialogue_id, type, subject, entity, status, first_turn, last_turn, evidence FROM grouped ORDER BY dialogue_id, type, subject, entity, run DESC""",
    "state_coded_fold": f"""WITH facts_once AS (SELECT DISTINCT ON (dialogue_id, turn_id, fact_pos) * FROM facts), coded AS (
  SELECT * FROM facts_once WHERE coalesce(standard_code, '') <> '' AND coalesce(terminology, '') <> '' AND type <> 'attribute' AND status IN ('present', 'absent') AND trim(coalesce(nullif(normalized_name, ''), name, ''), ' ') <> ''
), flips AS (
  SELECT *, CASE WHEN lag(status) OVER w = status THEN 0 ELSE 1 END AS flip FROM coded WINDOW w AS (PARTITION BY dialogue_id, type, subject, terminology, standard_code ORDER BY turn_id, fact_pos)
), runs AS (
  SELECT *, sum(flip) OVER (PARTITION BY dialogue_id, type, subject, terminology, standard_code ORDER BY turn_id, fact_pos) AS run FROM flips
), grouped AS (
  SELECT dialogue_id, type, subject, terminology, standard_code, run, min(status) AS status, min(turn_id) AS first_turn_id, max(turn_id) AS last_turn_id, count(DISTINCT (turn_id, evidence)) FILTER (coalesce(evidence, '') <> '') AS evidence FROM runs GROUP BY ALL
), last AS (SELECT DISTINCT ON (dialogue_id, type, subject, terminology, standard_code) * FROM grouped ORDER BY dialogue_id, type, subject, terminology, standard_code, run DESC)
SELECT dialogue_id, CASE WHEN status = 'absent' THEN 'negative_findings' WHEN type IN ('symptom', 'disease') THEN 'problems' {" ".join(f"WHEN type = '{k}' THEN '{b}'" for k, b in HOME.items())} ELSE 'other_facts' END AS bucket,
  terminology, standard_code, type, subject, status, first_turn_id, last_turn_id, CAST(evidence AS INTEGER) AS evidence FROM last""",
    "state_projection": f"""WITH {_STATES}, {_ITEMS}, named AS (SELECT dialogue_id, bucket, coalesce(nullif(trim(i.normalized_name, ' '), ''), nullif(trim(i.name, ' '), '')) AS name, i.type AS type, i.status AS status FROM items)
SELECT bucket, name, type, status, count(*) AS n, count(DISTINCT dialogue_id) AS dialogues FROM named WHERE name IS NOT NULL GROUP BY ALL""",
    "state_transition_errors": f"""WITH {_STATES}, {_ITEMS.replace("items AS", "stored AS")}, items AS (
  SELECT dialogue_id, turn_id, {{'type': i.type, 'subject': i.subject, 'terminology': i.terminology, 'standard_code': i.standard_code, 'attributes': i.attributes}} AS i FROM stored
  UNION ALL SELECT d, t, {{'type': kind, 'subject': s, 'terminology': m, 'standard_code': c, 'attributes': MAP {{k: v}}}} FROM (VALUES {", ".join(map(str, PLANTED_ITEMS))}) AS p(d, t, kind, s, m, c, k, v))
SELECT DISTINCT dialogue_id, turn_id, error, what FROM (
  SELECT dialogue_id, turn_id, 'duplicate code' AS error, i.standard_code AS what FROM items WHERE i.standard_code IS NOT NULL AND i.terminology IS NOT NULL GROUP BY dialogue_id, turn_id, i.terminology, i.standard_code, i.type, i.subject HAVING count(*) > 1
  UNION ALL SELECT dialogue_id, turn_id, 'duplicate part', e.key || '=' || e.value FROM (SELECT dialogue_id, turn_id, unnest(map_entries(i.attributes)) AS e FROM items)
  WHERE len(string_split(e.value, '；')) <> len(list_distinct(string_split(e.value, '；'))))""",
    "state_new_items_delta": f"""WITH {_STATES}, signed AS (SELECT dialogue_id, turn_id, {_SIGNATURES} AS g FROM states), looked AS (
  SELECT dialogue_id, turn_id, g, coalesce(lag(g) OVER (PARTITION BY dialogue_id ORDER BY turn_id), []) AS b FROM signed)
SELECT dialogue_id, turn_id, CAST(len(list_filter(list_distinct(g), lambda x: NOT list_contains(b, x))) AS INTEGER) AS new_items FROM looked WHERE len(list_filter(g, lambda x: NOT list_contains(b, x))) > 0""",
    "state_new_attributes_delta": f"""WITH {_STATES}, turns AS (SELECT dialogue_id, turn_id, lag(turn_id) OVER (PARTITION BY dialogue_id ORDER BY turn_id) AS before_turn FROM states), problems AS (SELECT dialogue_id, turn_id, unnest(s.problems) AS i FROM states),
pairs AS (SELECT n.dialogue_id, n.turn_id, n.i.normalized_name AS normalized_name, unnest(map_entries(n.i.attributes)) AS e, o.i.attributes AS old
  FROM problems n JOIN turns t USING (dialogue_id, turn_id) JOIN problems o ON o.dialogue_id = n.dialogue_id AND o.turn_id = t.before_turn AND o.i.normalized_name = n.i.normalized_name AND o.i.type = n.i.type AND o.i.status = n.i.status AND o.i.subject = n.i.subject)
SELECT DISTINCT dialogue_id, turn_id, normalized_name, e.key AS key FROM pairs WHERE coalesce(trim(e.value, ' '), '') <> '' AND coalesce(trim(old[e.key], ' '), '') = ''""",
    "checkpoint_rows": f"WITH {_STATES} SELECT dialogue_id, max(turn_id) AS completed_turn_id, CAST(coalesce(arg_max(len(s.problems), turn_id), 0) AS INTEGER) AS problems FROM states GROUP BY dialogue_id",
}

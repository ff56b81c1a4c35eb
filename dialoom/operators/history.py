"""History of changing attributes: one row per version of an entity, with the period in which it was valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.functions.text import BLANKS, strip
from dialoom.session import cut, table

#: Snapshots of one key that are folded in one array; a longer history is folded in several and joined up.
CHUNK = 256

_ITEMS = "array<struct<item:string,version:string>>"
_VERSIONS = "array<struct<item:string,version:string,valid_from:int,valid_to:int>>"


def version_history(snapshots: DataFrame, key: str, order: str, items: str, latest_by: str, chunk: int = CHUNK) -> DataFrame:
    """Versions of each item of the ``snapshots``: ``key, item, version, valid_from, valid_to``.

    ``snapshots`` has one row per attempt at a snapshot: ``key``, ``order`` (INT), ``latest_by`` and ``items``, an
    array of ``struct(item, version)`` with at most one entry per item, null if the snapshot says nothing. Of several
    rows for one place the one greatest in ``latest_by`` counts, among ties one that says something. ``valid_to`` is
    the next place in the order that shows another version or none, -1 if there is none. Null key or order: no row.
    Extra columns are ignored.

    Copies and earlier attempts of a place collapse before the shuffle, so that any number of them is one row per
    task; places are gathered by key and range of the order, so that a key with any share of all rows is spread over
    tasks. Each range is one sorted array of at most ``chunk`` structs, folded by a higher-order function that appends
    a version only upon change. Of keys of several ranges, the versions at the ends of a range alone are shuffled again,
    to join up neighbouring ranges.
    """
    says = F.col(items).isNotNull()
    rows = snapshots.where(F.col(key).isNotNull() & F.col(order).isNotNull()).select(
        F.col(key).alias("key"),
        F.floor(F.col(order) / F.lit(chunk)).cast("int").alias("part"),
        F.col(order).cast("int").alias("place"),
        F.struct(F.col(latest_by).alias("at"), says.alias("says")).alias("rank"),
        F.col(items).alias("items"),
    )
    last = rows.groupBy("key", "part", "place").agg(F.max_by("items", "rank").alias("items")).where("items is not null")
    shots = last.groupBy("key", "part").agg(F.array_sort(F.collect_list(F.struct("place", "items"))).alias("shots"))

    # a run of one item is open (valid_to null) while the newest place shows it; the fold closes and opens runs
    nothing = F.array().cast(_VERSIONS)

    def step(acc: Column, shot: Column) -> Column:
        place, now = shot["place"], shot["items"]
        kept = F.filter(acc["open"], lambda v: F.exists(now, lambda x: (x["item"] == v["item"]) & (x["version"] == v["version"])))
        ended = F.filter(acc["open"], lambda v: ~F.exists(now, lambda x: (x["item"] == v["item"]) & (x["version"] == v["version"])))
        new = F.filter(now, lambda x: ~F.exists(acc["open"], lambda v: (x["item"] == v["item"]) & (x["version"] == v["version"])))
        begun = F.transform(new, lambda x: F.struct(x["item"].alias("item"), x["version"].alias("version"), place.alias("valid_from"), F.lit(None).cast("int").alias("valid_to")))
        closed = F.transform(ended, lambda v: F.struct(v["item"].alias("item"), v["version"].alias("version"), v["valid_from"].alias("valid_from"), place.alias("valid_to")))
        return F.struct(F.concat(acc["done"], closed).cast(_VERSIONS).alias("done"), F.concat(kept, begun).cast(_VERSIONS).alias("open"))

    folded = F.aggregate("shots", F.struct(nothing.alias("done"), nothing.alias("open")), step, lambda acc: F.concat(acc["done"], acc["open"]))
    # the folded ranges are written once, as they are read for their places and for their versions
    parts = cut(shots.select("key", "part", F.get(F.col("shots"), F.lit(0))["place"].alias("first"), folded.alias("versions")))

    # most keys are one range, whose versions are final; of the others, the places at which ranges begin are put in order
    along = Window.partitionBy("key").orderBy("part")
    ends = parts.select("key", "part", "first").withColumns({"next": F.lead("first").over(along), "before": F.lag("first").over(along)})
    several = ends.where("next is not null or before is not null").select("key", "part", "next")
    single = parts.join(several, ["key", "part"], "left_anti").select("key", F.inline("versions")).select("key", "item", "version", "valid_from", F.coalesce("valid_to", F.lit(-1)).alias("valid_to"))
    flat = parts.join(several, ["key", "part"]).select("key", "first", "next", F.inline("versions"))

    # of several ranges, the versions that lie inside one are final; only those at its ends are shuffled, and those
    # of one version that touch are one
    at_end = F.col("valid_to").isNull() | (F.col("valid_from") == F.col("first"))
    inside = flat.where(~at_end).select("key", "item", "version", "valid_from", "valid_to")
    runs = Window.partitionBy("key", "item").orderBy("valid_from")
    parted = flat.where(at_end).select("key", "item", "version", "valid_from", F.coalesce("valid_to", "next", F.lit(-1)).alias("valid_to"))
    touches = (F.lag("version").over(runs) == F.col("version")) & (F.lag("valid_to").over(runs) == F.col("valid_from"))
    parted = parted.withColumn("starts", F.when(touches, 0).otherwise(1))
    parted = parted.withColumn("run", F.sum("starts").over(runs.rowsBetween(Window.unboundedPreceding, 0)))
    joined = parted.groupBy("key", "item", "run").agg(F.first("version").alias("version"), F.min("valid_from").alias("valid_from"), F.max_by("valid_to", "valid_from").alias("valid_to"))
    return single.unionByName(inside).unionByName(joined.drop("run")).withColumnRenamed("key", key)


def canonical_attributes(attributes: Column) -> Column:
    """A map as text in which the order of keys and of parts joined by ``；`` and blank values have no meaning."""

    def parts(value: Column) -> Column:
        several = F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform(F.split(value, "；"), strip), lambda p: p != ""))), "；")
        return F.when(F.contains(value, F.lit("；")), several).otherwise(strip(value))

    entries = F.transform(F.map_entries(attributes), lambda e: F.struct(strip(e["key"]).alias("key"), parts(e["value"]).alias("value")))
    entries = F.array_sort(F.filter(entries, lambda e: F.coalesce(e["value"] != "", F.lit(False))))
    return F.coalesce(F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("\u0001"), e["value"])), "\u0002"), F.lit(""))


def state_snapshots(turn_rows: DataFrame) -> DataFrame:
    """``dialogue_id, turn_id, processed_at, items`` of turn_rows: the chief complaint and the problems of each state.

    Several problems of one name are one item whose version is all of theirs; nameless ones are left out.
    """
    state = F.col("patient_state_after_turn")
    complaint = strip(state["chief_complaint"])
    chief = F.when(complaint != "", F.array(F.struct(F.lit("chief_complaint").alias("item"), complaint.alias("version")))).otherwise(F.array())
    # taken field by field, so that the scan reads these fields of the problems alone
    needed = "array<struct<normalized_name:string,status:string,attributes:map<string,string>>>"
    read = F.arrays_zip(*(state["problems"][f] for f in ("normalized_name", "status", "attributes"))).cast(needed)
    problems = F.transform(
        F.filter(F.coalesce(read, F.array().cast(needed)), lambda p: F.coalesce(strip(p["normalized_name"]) != "", F.lit(False))),
        lambda p: F.struct(p["normalized_name"].alias("item"), F.concat(F.coalesce(strip(p["status"]), F.lit("")), F.lit("\u0003"), canonical_attributes(p["attributes"])).alias("version")),
    )
    # step by step, as columns, so that nothing is worked out twice
    rows = turn_rows.select("dialogue_id", "turn_id", "processed_at", state.isNotNull().alias("says"), chief.cast(_ITEMS).alias("chief"), problems.cast(_ITEMS).alias("problems"))
    rows = rows.withColumn("names", F.array_distinct(F.col("problems.item")))
    together = F.transform(
        "names", lambda n: F.struct(n.alias("item"), F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter("problems", lambda p: p["item"] == n), lambda p: p["version"]))), "\u0004").alias("version"))
    )
    merged = F.when(F.size("names") == F.size("problems"), F.col("problems")).otherwise(together)
    return rows.select("dialogue_id", "turn_id", "processed_at", F.when(F.col("says"), F.concat("chief", merged)).alias("items"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per version of the chief complaint and of every problem of every dialogue."""
    versions = version_history(state_snapshots(table(spark, sf_dir, "turn_rows")), "dialogue_id", "turn_id", "items", "processed_at")
    return versions.select("dialogue_id", "item", F.col("valid_from").alias("valid_from_turn"), F.col("valid_to").alias("valid_to_turn"))


def p4_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions themselves, as readable text."""
    versions = version_history(state_snapshots(table(spark, sf_dir, "turn_rows")), "dialogue_id", "turn_id", "items", "processed_at")
    text = F.translate("version", "\u0001\u0002\u0003\u0004", "=,:|")
    return versions.select("dialogue_id", "item", text.alias("version"), F.col("valid_from").alias("valid_from_turn"), F.nullif("valid_to", F.lit(-1)).alias("valid_to_turn"))


P4_FOUND_SQL = """
WITH latest AS (
  SELECT dialogue_id, turn_id, patient_state_after_turn AS s,
         row_number() OVER (PARTITION BY dialogue_id, turn_id ORDER BY processed_at DESC, (patient_state_after_turn IS NULL)) AS rn
  FROM turn_rows WHERE dialogue_id IS NOT NULL AND turn_id IS NOT NULL
), shots AS (
  SELECT dialogue_id, turn_id, s, lead(turn_id) OVER (PARTITION BY dialogue_id ORDER BY turn_id) AS next_turn
  FROM latest WHERE rn = 1 AND s IS NOT NULL
), problems AS (
  SELECT dialogue_id, turn_id, next_turn, unnest(s.problems) AS p FROM shots
), entries AS (
  SELECT dialogue_id, turn_id, next_turn, p.normalized_name AS item, coalesce(trim(p.status, '{B}'), '') AS status, p.attributes AS a
  FROM problems WHERE trim(p.normalized_name, '{B}') <> ''
), versions AS (
  SELECT dialogue_id, turn_id, next_turn, item,
         string_agg(DISTINCT version, chr(4) ORDER BY version) AS version
  FROM (
    SELECT dialogue_id, turn_id, next_turn, item,
           status || chr(3) || coalesce(array_to_string(list_sort(list_transform(list_filter(
             list_transform(map_entries(a), lambda e: {'k': trim(e.key, '{B}'),
               'v': array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(e.value, '；'), lambda q: trim(q, '{B}')), lambda q: q <> ''))), '；')}),
             lambda e: e.v <> ''), lambda e: e.k || chr(1) || e.v)), chr(2)), '') AS version
    FROM entries)
  GROUP BY ALL
  UNION ALL
  SELECT dialogue_id, turn_id, next_turn, 'chief_complaint', trim(s.chief_complaint, '{B}') FROM shots WHERE trim(s.chief_complaint, '{B}') <> ''
), runs AS (
  SELECT *, CASE WHEN lag(version) OVER w = version AND lag(next_turn) OVER w = turn_id THEN 0 ELSE 1 END AS starts
  FROM versions WINDOW w AS (PARTITION BY dialogue_id, item ORDER BY turn_id)
), numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY dialogue_id, item ORDER BY turn_id) AS run FROM runs
)
SELECT dialogue_id, item, CAST(min(turn_id) AS INTEGER) AS valid_from_turn, CAST(coalesce(arg_max(coalesce(next_turn, -1), turn_id), -1) AS INTEGER) AS valid_to_turn
FROM numbered GROUP BY dialogue_id, item, run
""".replace("{B}", BLANKS)

P4_HISTORY_SQL = P4_FOUND_SQL.rsplit("SELECT dialogue_id, item,", 1)[0] + """SELECT dialogue_id, item, translate(min(version), chr(1) || chr(2) || chr(3) || chr(4), '=,:|') AS version, CAST(min(turn_id) AS INTEGER) AS valid_from_turn,
  CAST(arg_max({'n': next_turn}, turn_id).n AS INTEGER) AS valid_to_turn FROM numbered GROUP BY dialogue_id, item, run
"""

QUERIES = {"p4_found": p4_found, "p4_history": p4_history}
ORACLE_SQL = {"p4_found": P4_FOUND_SQL, "p4_history": P4_HISTORY_SQL}

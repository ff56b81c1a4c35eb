"""Evaluation of predicted facts against gold facts: bags, keys, fields, greedy pairs and what failures are due to.

Facts carry ``dialogue_id, turn_id`` (the sample) and ``fact_pos`` (their place in it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.jsonx import canonical_fact
from dialoom.functions.text import metric_text, ratio
from dialoom.operators.facts import distinct_facts
from dialoom.session import table

SAMPLE = ["dialogue_id", "turn_id"]


def prf(tp: Column, predicted: Column, gold: Column) -> list[Column]:
    """Precision, recall and F1, 0 where they are undefined."""
    p, r = ratio(tp, predicted), ratio(tp, gold)
    return [F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(ratio(2 * p * r, p + r), 6).alias("f1")]


def bag_matches(predicted: DataFrame, gold: DataFrame, what: list[Column], by: list[str] = ()) -> DataFrame:
    """``by, tp, predicted, gold``: the intersection of bags of each sample's facts, summed.

    One shuffle of counts on each side, combined map-side; equal facts of a sample count as often as both have them.
    """
    keys = [*SAMPLE, *by, "canon"]
    p = predicted.select(*SAMPLE, *by, *what).groupBy(keys).agg(F.count("*").alias("p"))
    g = gold.select(*SAMPLE, *by, *what).groupBy(keys).agg(F.count("*").alias("g"))
    both = p.join(g, keys, "full").select(*by, F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("g", F.lit(0)).alias("g"))
    return both.groupBy(*by).agg(F.sum(F.least("p", "g")).alias("tp"), F.sum("p").alias("predicted"), F.sum("g").alias("gold"))


def names(fact: Column) -> Column:
    """Comparable names of a fact."""
    return F.array_distinct(F.filter(F.array(metric_text(fact["name"]), metric_text(fact["normalized_name"])), lambda n: n != ""))


def components(p: Column, g: Column) -> dict[str, Column]:
    """Which core fields of two facts match."""
    return {"name": F.arrays_overlap(names(p), names(g))} | {f: metric_text(p[f]) == metric_text(g[f]) for f in ("type", "status", "subject")}


def greedy_pairs(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """``dialogue_id, turn_id, p_pos, g_pos``: each prediction in its order takes the first free gold fact that matches it.

    The facts of one turn make one row, which a higher-order function folds; a turn is one utterance.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        fact = F.struct("fact_pos", "name", "normalized_name", "type", "status", "subject")
        return df.groupBy(*SAMPLE).agg(F.array_sort(F.collect_list(fact)).alias(name))

    rows = side(predicted, "ps").join(side(gold, "gs"), SAMPLE)
    start = F.array().cast("array<struct<p_pos:int,g_pos:int>>")

    def step(acc: Column, p: Column) -> Column:
        def fits(g: Column) -> Column:
            c = components(p, g)
            return c["name"] & c["type"] & c["status"] & c["subject"] & ~F.exists(acc, lambda x: x["g_pos"] == g["fact_pos"])

        free = F.filter("gs", fits)
        pair = F.struct(p["fact_pos"].cast("int").alias("p_pos"), F.get(free, F.lit(0))["fact_pos"].cast("int").alias("g_pos"))
        return F.when(F.size(free) > 0, F.concat(acc, F.array(pair))).otherwise(acc)

    return rows.select(*SAMPLE, F.inline(F.aggregate("ps", start, step)))


def failure_components(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """``side, dialogue_id, turn_id, pos, cause, wrong``: unmatched facts by what fails them against the nearest one.

    Unmatched predictions are held against the unmatched gold facts of their sample and the other way round; of
    equally near ones the first counts. ``wrong``: the core fields that differ, null without a near one.
    """
    pairs = greedy_pairs(predicted, gold)
    fact = F.struct("name", "normalized_name", "type", "status", "subject")

    def left_over(df: DataFrame, pos: str) -> DataFrame:
        return df.withColumn(pos, F.col("fact_pos").cast("int")).join(pairs.select(*SAMPLE, pos), [*SAMPLE, pos], "left_anti").select(*SAMPLE, F.col(pos).alias("pos"), fact.alias("f"))

    sides = {"predicted": left_over(predicted, "p_pos"), "gold": left_over(gold, "g_pos")}
    none = F.array().cast("array<struct<pos:int,f:struct<name:string,normalized_name:string,type:string,status:string,subject:string>>>")

    def judged(c: Column) -> Column:
        parts = components(F.col("f"), c["f"])
        score = sum((v.cast("int") for v in parts.values()), F.lit(0))
        return F.struct((-score).alias("lost"), c["pos"].alias("pos"), F.filter(F.array(*(F.when(~v, F.lit(k)) for k, v in parts.items())), lambda x: x.isNotNull()).alias("wrong"))

    out = None
    for side, other in (("predicted", "gold"), ("gold", "predicted")):
        rivals = sides[other].groupBy(*SAMPLE).agg(F.array_sort(F.collect_list(F.struct("pos", "f"))).alias("rivals"))
        rows = sides[side].join(rivals, SAMPLE, "left")
        best = F.array_min(F.transform(F.coalesce("rivals", none), judged))
        near = best.isNotNull() & (best["lost"] < 0)
        wrong = F.when(near, best["wrong"])
        cause = F.when(~near, "no_close_candidate").when(F.size(wrong) == 0, "duplicate_or_pairing").when(F.size(wrong) == 1, F.concat(F.lit("single_"), F.get(wrong, F.lit(0)))).otherwise("multiple_core_fields")
        rows = rows.select(F.lit(side).alias("side"), *SAMPLE, "pos", cause.alias("cause"), wrong.alias("wrong"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Gold: the facts. Predicted: the facts as a faulty extractor would give them, by fixed rules."""
    gold = distinct_facts(table(spark, sf_dir, "facts")).drop("standard_code", "terminology")
    predicted = gold.where("fact_pos % 5 <> 4").withColumns({
        "type": F.when(F.col("fact_pos") % 7 == 3, "other").otherwise(F.col("type")),
        "status": F.when((F.col("turn_id") + F.col("fact_pos")) % 11 == 0, "absent").otherwise(F.col("status")),
        "evidence": F.when(F.col("turn_id") % 3 == 0, F.substr("evidence", F.lit(2))).otherwise(F.col("evidence")),
        "attribute": F.when(F.col("turn_id") % 4 == 0, F.map_filter("attribute", lambda k, v: k != "severity")).otherwise(F.col("attribute")),
    })
    return predicted, gold


_CORE = ["name", "normalized_name", "type", "status", "subject", "evidence"]


def _canon() -> list[Column]:
    parts = [F.coalesce(F.concat(F.lit('"'), F.col(c), F.lit('"')), F.lit("null")) for c in _CORE]
    return [F.concat_ws(",", *parts).alias("canon")]


def strict_bag_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and rates of whole facts that are equal."""
    p, g = _sides(spark, sf_dir)
    counts = bag_matches(p, g, _canon())
    return counts.select("tp", "predicted", "gold", *prf(F.col("tp"), F.col("predicted"), F.col("gold")))


def by_key_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by type."""
    p, g = _sides(spark, sf_dir)
    counts = bag_matches(p, g, _canon(), ["type"])
    return counts.select("type", "tp", "predicted", "gold", *prf(F.col("tp"), F.col("predicted"), F.col("gold")))


def by_status_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by status."""
    p, g = _sides(spark, sf_dir)
    counts = bag_matches(p, g, _canon(), ["status"])
    return counts.select("status", "tp", "predicted", "gold", *prf(F.col("tp"), F.col("predicted"), F.col("gold")))


def core_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and rates of the greedy pairs, by type and by status of the gold fact."""
    p, g = _sides(spark, sf_dir)
    gold_of_pairs = greedy_pairs(p, g).join(g.select(*SAMPLE, F.col("fact_pos").cast("int").alias("g_pos"), "type", "status"), [*SAMPLE, "g_pos"])

    def tagged(df: DataFrame, kind: str) -> DataFrame:
        keys = F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in ("type", "status")))
        return df.select(F.lit(kind).alias("kind"), F.inline(keys))

    rows = tagged(gold_of_pairs, "tp").unionByName(tagged(p, "predicted")).unionByName(tagged(g, "gold"))
    counts = rows.groupBy("key", "value").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in ("tp", "predicted", "gold")))
    return counts.select("key", "value", "tp", "predicted", "gold", *prf(F.col("tp"), F.col("predicted"), F.col("gold")))


def field_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the greedy pairs: how many agree in name, evidence (or overlap in it) and attributes (or share a key of them)."""
    p, g = _sides(spark, sf_dir)
    pairs = greedy_pairs(p, g)
    fields = lambda df, pos: df.select(*SAMPLE, F.col("fact_pos").cast("int").alias(pos), F.struct("normalized_name", "evidence", "attribute").alias(pos[0]))
    both = pairs.join(fields(p, "p_pos"), [*SAMPLE, "p_pos"]).join(fields(g, "g_pos"), [*SAMPLE, "g_pos"])
    a, b = metric_text(F.col("p.evidence")), metric_text(F.col("g.evidence"))
    overlap = (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))
    entries = lambda m: F.array_sort(F.coalesce(F.map_entries(m), F.array().cast("array<struct<key:string,value:string>>")))
    x, y = entries("p.attribute"), entries("g.attribute")
    shared = ((F.size(x) == 0) & (F.size(y) == 0)) | F.arrays_overlap(x["key"], y["key"])
    return both.agg(
        F.count("*").alias("pairs"), F.count_if(metric_text(F.col("p.normalized_name")) == metric_text(F.col("g.normalized_name"))).alias("names"), F.count_if(a == b).alias("evidence"), F.count_if(overlap).alias("evidence_overlap"),
        F.count_if(x == y).alias("attributes"), F.count_if(shared).alias("attribute_keys"),
    )


def greedy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greedy pairs."""
    return greedy_pairs(*_sides(spark, sf_dir))


def error_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmatched facts of either side by cause, and by every field that fails them."""
    rows = failure_components(*_sides(spark, sf_dir))
    causes = rows.select("side", "cause").unionByName(rows.select("side", F.explode("wrong").alias("f")).select("side", F.concat(F.lit("any_"), "f").alias("cause")))
    return causes.groupBy("side", "cause").agg(F.count("*").alias("n"))


def empty_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns by whether gold and prediction have any facts, and how many are exactly equal."""
    p, g = _sides(spark, sf_dir)
    canon = F.array_join(F.array_sort(F.collect_list("canon")), "|").alias("all")
    turns = table(spark, sf_dir, "turn_rows").select(*SAMPLE).distinct()
    sides = [df.select(*SAMPLE, *_canon()).groupBy(*SAMPLE).agg(canon.alias(n)) for df, n in ((p, "pa"), (g, "ga"))]
    rows = turns.join(sides[0], SAMPLE, "left").join(sides[1], SAMPLE, "left")
    return rows.groupBy(F.col("ga").isNull().alias("gold_empty"), F.col("pa").isNull().alias("predicted_empty")).agg(F.count("*").alias("turns"), F.count_if(F.col("ga").eqNullSafe(F.col("pa"))).alias("exact"))


def canonical_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct canonical outputs of turns, counted by how many facts they have."""
    facts = distinct_facts(table(spark, sf_dir, "facts")).select(*SAMPLE, canonical_fact(["name", "type", "status"]).alias("c"))
    rows = facts.groupBy(*SAMPLE).agg(F.array_join(F.array_sort(F.collect_list("c")), ",").alias("output"), F.count("*").alias("facts"))
    return rows.groupBy("facts").agg(F.count("*").alias("turns"), F.count_distinct("output").alias("outputs"))


QUERIES = {
    "strict_bag_match_prf": strict_bag_match, "by_key_prf": by_key_prf, "by_status_prf": by_status_prf, "core_prf": core_prf, "field_accuracy": field_accuracy, "greedy_match": greedy_match, "best_candidate_components": error_impact,
    "empty_detection": empty_detection, "canonical_samples": canonical_samples,
}

_CANON = " || ',' || ".join(f"coalesce('\"' || {c} || '\"', 'null')" for c in _CORE)
_SIDES = f"""gold AS (SELECT DISTINCT ON (dialogue_id, turn_id, fact_pos) dialogue_id, turn_id, fact_pos, name, normalized_name, type, status, subject, evidence, attribute FROM facts), predicted AS (
  SELECT dialogue_id, turn_id, fact_pos, name, normalized_name, CASE WHEN fact_pos % 7 = 3 THEN 'other' ELSE type END AS type, CASE WHEN (turn_id + fact_pos) % 11 = 0 THEN 'absent' ELSE status END AS status, subject,
    CASE WHEN turn_id % 3 = 0 THEN substr(evidence, 2) ELSE evidence END AS evidence,
    CASE WHEN turn_id % 4 = 0 THEN map_from_entries(list_filter(map_entries(attribute), lambda e: e.key <> 'severity')) ELSE attribute END AS attribute FROM gold WHERE fact_pos % 5 <> 4)"""


def _bags(by: str) -> str:
    keys = f"dialogue_id, turn_id, {by}canon"
    return f"""WITH {_SIDES}, p AS (SELECT {keys}, count(*) AS p FROM (SELECT *, {_CANON} AS canon FROM predicted) GROUP BY ALL), g AS (SELECT {keys}, count(*) AS g FROM (SELECT *, {_CANON} AS canon FROM gold) GROUP BY ALL),
counts AS (SELECT {by} CAST(sum(least(coalesce(p, 0), coalesce(g, 0))) AS BIGINT) AS tp, CAST(sum(coalesce(p, 0)) AS BIGINT) AS predicted, CAST(sum(coalesce(g, 0)) AS BIGINT) AS gold FROM p FULL JOIN g USING ({keys}) GROUP BY ALL)
SELECT {by} tp, predicted, gold, round(coalesce(tp / nullif(predicted, 0), 0), 6) AS precision, round(coalesce(tp / nullif(gold, 0), 0), 6) AS recall, round(coalesce(2.0 * tp / nullif(predicted + gold, 0), 0), 6) AS f1 FROM counts"""


def _plain(column: str) -> str:
    return rf"lower(regexp_replace(coalesce({column}, ''), '[\s\p{{Z}}\x{{FEFF}}]+', '', 'g'))"


_MATCHES = {
    "name": f"len(list_filter([{_plain('p.name')}, {_plain('p.normalized_name')}], lambda n: n <> '' AND n IN ({_plain('g.name')}, {_plain('g.normalized_name')}))) > 0",
    **{f: f"{_plain('p.' + f)} = {_plain('g.' + f)}" for f in ("type", "status", "subject")},
}
#: The greedy pairs, prediction by prediction.
_PAIRS = f"""WITH RECURSIVE {_SIDES}, options AS (
  SELECT p.dialogue_id, p.turn_id, p.fact_pos AS p_pos, list(g.fact_pos ORDER BY g.fact_pos) FILTER ({" AND ".join(_MATCHES.values())}) AS fits FROM predicted p JOIN gold g ON g.dialogue_id = p.dialogue_id AND g.turn_id = p.turn_id GROUP BY ALL
), numbered AS (SELECT *, row_number() OVER (PARTITION BY dialogue_id, turn_id ORDER BY p_pos) AS n FROM options), walk AS (
  SELECT DISTINCT dialogue_id, turn_id, CAST(0 AS BIGINT) AS n, CAST([] AS INTEGER[]) AS used, CAST(NULL AS INTEGER) AS p_pos, CAST(NULL AS INTEGER) AS g_pos FROM numbered
  UNION ALL SELECT w.dialogue_id, w.turn_id, o.n, CASE WHEN len(list_filter(o.fits, lambda g: NOT list_contains(w.used, g))) > 0 THEN list_append(w.used, list_filter(o.fits, lambda g: NOT list_contains(w.used, g))[1]) ELSE w.used END,
    o.p_pos, list_filter(o.fits, lambda g: NOT list_contains(w.used, g))[1] FROM walk w JOIN numbered o ON o.dialogue_id = w.dialogue_id AND o.turn_id = w.turn_id AND o.n = w.n + 1
), pairs AS (SELECT dialogue_id, turn_id, p_pos, g_pos FROM walk WHERE g_pos IS NOT NULL)"""
_RATES = "round(coalesce(tp / nullif(predicted, 0), 0), 6) AS precision, round(coalesce(tp / nullif(gold, 0), 0), 6) AS recall, round(coalesce(2.0 * tp / nullif(predicted + gold, 0), 0), 6) AS f1"


def _impact(side: str, p: str, g: str) -> str:
    """Causes of one side's unmatched facts, which are called p here, against the other's."""
    wrong = ", ".join(f"CASE WHEN NOT ({m}) THEN '{f}' END" for f, m in _MATCHES.items())
    return f"""SELECT '{side}' AS side, dialogue_id, turn_id, pos, CASE WHEN best IS NULL OR best.score = 0 THEN NULL ELSE best.wrong END AS wrong FROM (
    SELECT p.dialogue_id, p.turn_id, p.fact_pos AS pos, arg_min({{'score': w.score, 'wrong': w.wrong}}, (-w.score, w.g_pos)) FILTER (w.score IS NOT NULL) AS best FROM {p} p LEFT JOIN LATERAL (
      SELECT g.fact_pos AS g_pos, list_filter([{wrong}], lambda x: x IS NOT NULL) AS wrong, 4 - len(list_filter([{wrong}], lambda x: x IS NOT NULL)) AS score FROM {g} g WHERE g.dialogue_id = p.dialogue_id AND g.turn_id = p.turn_id) w ON TRUE GROUP BY ALL)"""


ORACLE_SQL = {
    "greedy_match": _PAIRS + " SELECT * FROM pairs",
    "core_prf": f"""{_PAIRS}, tagged AS (
  SELECT 'tp' AS kind, g.type, g.status FROM pairs JOIN gold g ON g.dialogue_id = pairs.dialogue_id AND g.turn_id = pairs.turn_id AND g.fact_pos = pairs.g_pos UNION ALL SELECT 'predicted', type, status FROM predicted UNION ALL SELECT 'gold', type, status FROM gold
), keyed AS (SELECT kind, 'type' AS key, type AS value FROM tagged UNION ALL SELECT kind, 'status', status FROM tagged), counts AS (
  SELECT key, value, count(*) FILTER (kind = 'tp') AS tp, count(*) FILTER (kind = 'predicted') AS predicted, count(*) FILTER (kind = 'gold') AS gold FROM keyed GROUP BY ALL)
SELECT key, value, tp, predicted, gold, {_RATES} FROM counts""",
    "field_accuracy": f"""{_PAIRS}, matched AS (
  SELECT {_plain("p.normalized_name")} AS pn, {_plain("g.normalized_name")} AS gn, {_plain("p.evidence")} AS pe, {_plain("g.evidence")} AS ge, list_sort(coalesce(map_entries(p.attribute), [])) AS px, list_sort(coalesce(map_entries(g.attribute), [])) AS gx,
    coalesce(map_keys(p.attribute), []) AS pk, coalesce(map_keys(g.attribute), []) AS gk
  FROM pairs JOIN predicted p ON p.dialogue_id = pairs.dialogue_id AND p.turn_id = pairs.turn_id AND p.fact_pos = p_pos JOIN gold g ON g.dialogue_id = pairs.dialogue_id AND g.turn_id = pairs.turn_id AND g.fact_pos = g_pos)
SELECT count(*) AS pairs, count(*) FILTER (pn = gn) AS names, count(*) FILTER (pe = ge) AS evidence, count(*) FILTER (pe <> '' AND ge <> '' AND (contains(pe, ge) OR contains(ge, pe))) AS evidence_overlap,
  count(*) FILTER (px = gx) AS attributes, count(*) FILTER ((len(pk) = 0 AND len(gk) = 0) OR list_has_any(pk, gk)) AS attribute_keys FROM matched""",
    "best_candidate_components": f"""{_PAIRS}, p_left AS (SELECT * FROM predicted WHERE (dialogue_id, turn_id, fact_pos) NOT IN (SELECT (dialogue_id, turn_id, p_pos) FROM pairs)), g_left AS (
  SELECT * FROM gold WHERE (dialogue_id, turn_id, fact_pos) NOT IN (SELECT (dialogue_id, turn_id, g_pos) FROM pairs)
), judged AS ({_impact("predicted", "p_left", "g_left")} UNION ALL {_impact("gold", "g_left", "p_left")}), causes AS (
  SELECT side, CASE WHEN wrong IS NULL THEN 'no_close_candidate' WHEN len(wrong) = 0 THEN 'duplicate_or_pairing' WHEN len(wrong) = 1 THEN 'single_' || wrong[1] ELSE 'multiple_core_fields' END AS cause FROM judged
  UNION ALL SELECT side, 'any_' || f FROM (SELECT side, unnest(wrong) AS f FROM judged WHERE wrong IS NOT NULL))
SELECT side, cause, count(*) AS n FROM causes GROUP BY ALL""",
    "strict_bag_match_prf": _bags(""),
    "by_key_prf": _bags("type, "),
    "by_status_prf": _bags("status, "),
    "empty_detection": f"""WITH {_SIDES}, turns AS (SELECT DISTINCT dialogue_id, turn_id FROM turn_rows), pa AS (SELECT dialogue_id, turn_id, array_to_string(list_sort(list({_CANON})), '|') AS pa FROM predicted GROUP BY ALL), ga AS (SELECT dialogue_id, turn_id, array_to_string(list_sort(list({_CANON})), '|') AS ga FROM gold GROUP BY ALL)
SELECT ga IS NULL AS gold_empty, pa IS NULL AS predicted_empty, count(*) AS turns, count(*) FILTER (ga IS NOT DISTINCT FROM pa) AS exact FROM turns LEFT JOIN pa USING (dialogue_id, turn_id) LEFT JOIN ga USING (dialogue_id, turn_id) GROUP BY ALL""",
    "canonical_samples": """WITH f AS (SELECT DISTINCT ON (dialogue_id, turn_id, fact_pos) * FROM facts), o AS (
  SELECT dialogue_id, turn_id, count(*) AS facts, list_sort(list({'n': name, 't': type, 's': status, 'a': list_sort(map_entries(coalesce(attribute, MAP {})))})) AS output FROM f GROUP BY ALL)
SELECT facts, count(*) AS turns, count(DISTINCT output) AS outputs FROM o GROUP BY facts""",
}

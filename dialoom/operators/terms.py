"""The terminology: import, ranked lookup tables and the lookups of facts."""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.functions.lexicon import EXPECTED_TERMINOLOGY, GENERIC_EXAMINATIONS
from dialoom.functions.text import is_display_name, split_list, term_key
from dialoom.operators.facts import distinct_facts
from dialoom.session import table

#: Rows of a lookup table that may be broadcast; a larger one is joined by shuffle.
BROADCAST_LOOKUP = 500_000
#: Bytes of the rows, as JSON, that may be broadcast.
BROADCAST_BYTES = 64 << 20
#: Pairs of keys that are compared side by side.
LCS_PAIRS = 10_000
#: Distinct characters of a list that may be broadcast with their counts.
TOKENS = 100_000

# Examinations that are known without a terminology.
BUILTIN_EXAMINATIONS = [
    ("结肠镜检查", "18746-8", "LOINC", ["肠镜", "结肠镜", "结肠镜检查"]),
    ("胃镜检查", "28014-9", "LOINC", ["胃镜", "胃镜检查", "上消化道内镜", "上消化道内镜检查"]),
    ("血常规检查", "58410-2", "LOINC", ["血常规", "血常规检查"]),
    ("幽门螺杆菌检测", None, None, ["幽门螺杆菌", "幽门螺旋杆菌", "幽门螺杆菌检测", "幽门螺旋杆菌检测"]),
]


def small(df: DataFrame, bound: int = BROADCAST_LOOKUP) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``bound`` rows and ``BROADCAST_BYTES`` of text, else as it is."""
    head = df.limit(bound + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("bytes")).agg(F.count("*").alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if head["rows"] <= bound and head["bytes"] <= BROADCAST_BYTES else df


def import_terms(rows: DataFrame) -> DataFrame:
    """``rows`` (``pos, terminology, semantic_type, code, preferred_name, aliases ARRAY, source``) as the terminology.

    One row per alias, the preferred name first; blank keys are skipped, and of one key of a code the first alias
    stays. Rows without a code or a name are left out.
    """
    named = rows.where((F.trim("code") != "") & (F.trim("preferred_name") != ""))
    aliases = F.array_distinct(F.concat(F.array("preferred_name"), F.coalesce("aliases", F.array().cast("array<string>"))))
    flat = named.select("pos", "terminology", "semantic_type", "code", "preferred_name", "source", F.posexplode(aliases).alias("apos", "alias"))
    flat = flat.withColumn("normalized_key", term_key(F.col("alias"))).where("normalized_key <> ''")
    first = F.min_by(F.struct("preferred_name", "alias", "source"), F.struct("pos", "apos")).alias("first")
    return flat.groupBy("terminology", "semantic_type", "code", "normalized_key").agg(first).select("terminology", "semantic_type", "code", "first.preferred_name", "first.alias", "normalized_key", "first.source")


# Columns under which the sources of the terminology name things.
ICD_COLUMNS = {
    "code": ["code", "icd_code", "diagnosis_code", "疾病诊断代码", "编码", "代码"],
    "name": ["preferred_name", "name", "disease", "diagnosis_name", "疾病诊断名称", "疾病名称", "名称", "诊断名称"],
    "synonyms": ["synonyms", "alias", "aliases", "同义词", "别名"],
}
LOINC_COLUMNS = {"code": ["LOINC_NUM", "loinc", "code"], "name": ["LONG_COMMON_NAME", "COMPONENT", "name"]}
LOINC_ZH_COLUMNS = {
    "display": ["LinguisticVariantDisplayName", "DisplayName", "display_name"],
    "short": ["SHORTNAME", "short_name", "短名"],
    "component": ["COMPONENT"],
    "long": ["LONG_COMMON_NAME", "zh_name", "name", "ChineseName", "中文名", "名称"],
}
LOINC_AXES = ["COMPONENT", "PROPERTY", "TIME_ASPCT", "SYSTEM", "SCALE_TYP", "METHOD_TYP"]


def disease_rows(rows: DataFrame, pick: Callable[[DataFrame, list[str]], Column], source: str = "icd") -> DataFrame:
    """A table of coded diseases as rows for :func:`import_terms`; ``pick`` finds a value under one of several columns."""
    named = {k: pick(rows, names) for k, names in ICD_COLUMNS.items()}
    out = rows.select(F.monotonically_increasing_id().alias("pos"), F.lit("ICD-10-CN").alias("terminology"), F.lit("disease").alias("semantic_type"), named["code"].alias("code"), named["name"].alias("preferred_name"), split_list(named["synonyms"]).alias("aliases"), F.lit(source).alias("source"))
    return out.where("code <> '' and preferred_name <> ''")


def examination_rows(table_: DataFrame | None, chinese: DataFrame | None, pick: Callable[[DataFrame, list[str]], Column], source: str = "loinc") -> DataFrame:
    """The two tables of coded examinations, either of which may be missing, as rows for :func:`import_terms`.

    The preferred name of a code is the shortest fit name for display of its Chinese rows, the first of equally short
    ones (display name, short name, component, long name); else its first long name; else its first alias.
    """
    parts = []
    names = "array<string>"
    if table_ is not None:
        code, name = pick(table_, LOINC_COLUMNS["code"]), pick(table_, LOINC_COLUMNS["name"])
        whole = table_.select(F.monotonically_increasing_id().alias("pos"), code.alias("code"), name.alias("fallback"))
        parts.append(whole.where("code <> '' and fallback <> ''").select("pos", "code", "fallback", F.array().cast(names).alias("shown"), F.array("fallback").alias("aliases")))
    if chinese is not None:
        found = {k: pick(chinese, columns) for k, columns in LOINC_ZH_COLUMNS.items()}
        axes = F.filter(F.array(*(pick(chinese, [a]) for a in LOINC_AXES)), lambda x: x != "")
        rows = chinese.select(F.monotonically_increasing_id().alias("pos"), pick(chinese, LOINC_COLUMNS["code"]).alias("code"), F.lit(None).cast("string").alias("fallback"), F.array(*found.values()).alias("shown"), F.concat(F.array(*found.values()), F.array(F.array_join(axes, "."))).alias("aliases"))
        parts.append(rows.where("code <> ''"))
    every = functools.reduce(DataFrame.unionByName, parts)
    fit = F.filter(F.transform("shown", lambda n, i: F.struct(F.length(n).alias("size"), F.col("pos").alias("pos"), i.alias("place"), n.alias("name"))), lambda n: is_display_name(n["name"]))
    per = every.withColumn("best", F.array_min(fit)).groupBy("code").agg(F.min("best").alias("best"), F.min_by("fallback", F.when(F.col("fallback").isNotNull(), F.col("pos"))).alias("fallback"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("aliases")))).alias("aliases"))
    aliases = F.filter("aliases", lambda a: a != "")
    named = F.coalesce("best.name", "fallback", F.get(aliases, F.lit(0)))
    out = per.select(F.lit(0).cast("long").alias("pos"), F.lit("LOINC").alias("terminology"), F.lit("examination").alias("semantic_type"), "code", named.alias("preferred_name"), aliases.alias("aliases"), F.lit(source).alias("source"))
    return out.where("preferred_name is not null")


def term_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a terminology holds: rows, codes and keys of each list and type."""
    rows = table(spark, sf_dir, "terms").withColumn("k", term_key(F.col("alias")))
    return rows.groupBy("terminology", "semantic_type").agg(F.count("*").alias("rows"), F.count_distinct("code").alias("codes"), F.count_distinct("k").alias("keys"), F.count_if(F.col("source").isNull()).alias("without_source"))


def term_dimension(terms: DataFrame) -> DataFrame:
    """The reference list with one row per identity, the smallest id's."""
    one = F.min_by(F.struct("id", "preferred_name", "alias", "source"), "id").alias("one")
    keyed = terms.withColumn("normalized_key", term_key(F.col("alias"))).where("normalized_key <> ''")
    return keyed.groupBy("terminology", "semantic_type", "code", "normalized_key").agg(one).select("one.id", "terminology", "semantic_type", "code", "one.preferred_name", "one.alias", "normalized_key", "one.source")


def _rank() -> Column:
    return F.struct((F.col("preferred_name") != F.col("alias")).alias("other"), "id")


def lookup_in_terminology(terms: DataFrame) -> DataFrame:
    """Best entry for each type, terminology and key: preferred names first, then the smallest id."""
    best = F.min_by(F.struct("code", "preferred_name", "alias"), _rank()).alias("best")
    return term_dimension(terms).groupBy("semantic_type", "terminology", "normalized_key").agg(best).select("semantic_type", "terminology", "normalized_key", "best.*")


def lookup_unambiguous(terms: DataFrame) -> DataFrame:
    """The entry for each type and key that has only one code."""
    best = F.min_by(F.struct("terminology", "code", "preferred_name", "alias"), _rank()).alias("best")
    codes = F.size(F.collect_set(F.struct("terminology", "code"))).alias("codes")
    return term_dimension(terms).groupBy("semantic_type", "normalized_key").agg(best, codes).where("codes = 1").select("semantic_type", "normalized_key", "best.*")


def builtin_examinations(spark: SparkSession) -> DataFrame:
    """The built-in examinations by key."""
    rows = [(alias, name, code, terminology) for name, code, terminology, aliases in BUILTIN_EXAMINATIONS for alias in aliases]
    df = spark.createDataFrame(rows, "alias string, preferred_name string, code string, terminology string")
    return df.withColumn("normalized_key", term_key(F.col("alias")))


def match_facts(facts: DataFrame, terms: DataFrame) -> DataFrame:
    """``facts`` with ``m``: the entry (preferred_name, code, terminology, alias) that the name, or else the normalized
    name, stands for; null if none does.

    For each name: generic words for examinations are skipped, then the built-in examinations, then the expected
    terminology of the type, or an unambiguous entry for types without one. Lookup tables are broadcast up to a bound.
    """
    one = small(lookup_in_terminology(terms).select("semantic_type", "terminology", "normalized_key", F.struct("preferred_name", "code", "terminology", "alias").alias("entry")))
    any_ = small(lookup_unambiguous(terms).select("semantic_type", "normalized_key", F.struct("preferred_name", "code", "terminology", "alias").alias("entry")))
    built = F.broadcast(builtin_examinations(facts.sparkSession).select("normalized_key", F.struct("preferred_name", "code", "terminology", "alias").alias("entry")))
    expected = F.create_map(*(F.lit(x) for pair in EXPECTED_TERMINOLOGY.items() for x in pair))[F.col("type")]
    out = facts.withColumn("expected", expected)
    for name in ("name", "normalized_name"):
        key = term_key(F.col(name))
        key = F.when((key != "") & ~((F.col("type") == "examination") & key.isin(GENERIC_EXAMINATIONS)), key)
        out = out.withColumn(f"key_{name}", key)
        b = built.select(F.col("normalized_key").alias("bk"), F.col("entry").alias(f"b_{name}"))
        out = out.join(b, (F.col("type") == "examination") & (F.col(f"key_{name}") == F.col("bk")), "left").drop("bk")
        t = one.select(F.col("semantic_type").alias("tt"), F.col("terminology").alias("tn"), F.col("normalized_key").alias("tk"), F.col("entry").alias(f"t_{name}"))
        out = out.join(t, (F.col("type") == F.col("tt")) & (F.col("expected") == F.col("tn")) & (F.col(f"key_{name}") == F.col("tk")), "left").drop("tt", "tn", "tk")
        a = any_.select(F.col("semantic_type").alias("at"), F.col("normalized_key").alias("ak"), F.col("entry").alias(f"a_{name}"))
        out = out.join(a, F.col("expected").isNull() & (F.col("type") == F.col("at")) & (F.col(f"key_{name}") == F.col("ak")), "left").drop("at", "ak")
    found = F.coalesce(*(f"{way}_{name}" for name in ("name", "normalized_name") for way in "bta"))
    return out.select(*facts.columns, found.alias("m"))


def standardized(facts: DataFrame, terms: DataFrame) -> DataFrame:
    """``facts`` with name, code and terminology of their entries; without one the name stands for itself."""
    rows = match_facts(facts, terms)
    new = {
        "normalized_name": F.coalesce("m.preferred_name", F.nullif("normalized_name", F.lit("")), "name"),
        "standard_code": F.when(F.col("m").isNotNull(), F.col("m.code")).otherwise(F.col("standard_code")),
        "terminology": F.when(F.col("m").isNotNull(), F.col("m.terminology")).otherwise(F.col("terminology")),
    }
    return rows.withColumns(new).drop("m")


def verified(facts: DataFrame, terms: DataFrame) -> DataFrame:
    """``facts`` with ``verified``: no code at all, or an entry of that type, terminology and code."""
    entries = small(terms.select(F.col("semantic_type").alias("vt"), F.col("terminology").alias("vn"), F.col("code").alias("vc")).distinct().withColumn("there", F.lit(True)))
    rows = facts.join(entries, (F.col("type") == F.col("vt")) & (F.col("terminology") == F.col("vn")) & (F.col("standard_code") == F.col("vc")), "left")
    expected = F.create_map(*(F.lit(x) for pair in EXPECTED_TERMINOLOGY.items() for x in pair))[F.col("type")]
    fits = F.coalesce(expected == F.col("terminology"), F.lit(True)) & F.coalesce("there", F.lit(False))
    none = F.col("standard_code").isNull() & F.col("terminology").isNull()
    return rows.withColumn("verified", none | fits).drop("vt", "vn", "vc", "there")


def common_subsequences(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair; all pairs go through the table side by side, row by row."""

    def codes(texts: list[str], pad: int) -> np.ndarray:
        out = np.full((len(texts), max(map(len, texts), default=0)), pad, dtype=np.int32)
        out[np.arange(out.shape[1]) < np.array([len(t) for t in texts])[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.int32)
        return out

    x, y = codes(a, -1), codes(b, -2)
    row = np.zeros((len(a), y.shape[1] + 1), dtype=np.int32)
    for i in range(x.shape[1]):
        # pads match nothing, so that a row behind the end of a text is as the one before
        taken = np.where(x[:, i : i + 1] == y, row[:, :-1] + 1, 0)
        row[:, 1:] = np.maximum.accumulate(np.maximum(row[:, 1:], taken), axis=1)
    return row[:, -1]


def fuzzy_candidates(queries: DataFrame, terms: DataFrame, least: float = 75.0, k: int = 5) -> DataFrame:
    """Up to ``k`` entries for each query (``type, query``) by insertion-deletion ratio of the keys, ``least`` at least.

    The ratio is 200·LCS/(a+b), so that of a key at least a share of ``r / (2 - r)`` must be in the LCS (``r``: the
    least ratio), as the other key is no shorter than the LCS. Characters, each counted as often as it occurs, are
    put in the order of their frequency in the list; two keys that share so many have a common one among the rarest of
    each, and only these are joined. Pairs that share too few for the least ratio are never compared, and none is
    lost. The LCS of the pairs left runs in Arrow batches.
    """
    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        left, right = a.tolist(), b.tolist()
        parts = [200.0 * common_subsequences(left[n : n + LCS_PAIRS], right[n : n + LCS_PAIRS]) for n in range(0, len(left), LCS_PAIRS)]
        return pd.Series(np.concatenate(parts or [np.zeros(0)]) / (a.str.len() + b.str.len()).to_numpy())

    def chars(key: str) -> Column:
        # the n-th occurrence of a character is a token of its own, so that shared tokens bound the LCS
        each = F.filter(F.split(F.col(key), ""), lambda c: c != "")
        return F.transform(each, lambda c, i: F.concat(c, F.size(F.filter(F.slice(each, 1, i), lambda x: x == c)).cast("string")))

    share = least / 100 / (2 - least / 100)
    q = queries.select("type", "query").distinct().withColumn("qk", term_key(F.col("query"))).where("qk <> ''").withColumn("qc", chars("qk"))
    t = terms.select("id", "terminology", F.col("semantic_type").alias("type"), "code", "preferred_name", "alias").withColumn("tk", term_key(F.col("alias"))).where("tk <> ''").withColumn("tc", chars("tk"))
    counts = small(t.select("type", F.explode("tc").alias("token")).groupBy("type", "token").agg(F.count("*").alias("n")), TOKENS)

    def rarest(df: DataFrame, ids: list[str], tokens: str) -> DataFrame:
        rows = df.select("type", *ids, F.size(tokens).alias("size"), F.explode(tokens).alias("token")).join(counts, ["type", "token"], "left")
        place = F.row_number().over(Window.partitionBy("type", *ids).orderBy(F.coalesce("n", F.lit(0)), "token"))
        kept = F.col("size") - F.ceil(F.col("size") * F.lit(share) - F.lit(1e-9)) + 1
        return rows.withColumn("place", place).where(F.col("place") <= kept).select("type", *ids, "token")

    pairs = rarest(q, ["query"], "qc").join(rarest(t, ["id"], "tc"), ["type", "token"]).select("type", "query", "id").distinct()
    near = pairs.join(q, ["type", "query"]).join(t, ["type", "id"])
    common = F.size(F.array_intersect("qc", "tc"))
    near = near.where(common * 200.0 >= least * (F.length("qk") + F.length("tk")))
    scored = near.withColumn("score", score("qk", "tk")).where(F.col("score") >= least)
    per_code = scored.groupBy("type", "query", "terminology", "code").agg(F.min_by(F.struct("score", "preferred_name", "alias", "id"), "id").alias("first"))
    rank = F.row_number().over(Window.partitionBy("type", "query").orderBy(F.desc("first.score"), F.asc("first.id")))
    return per_code.withColumn("rank", rank).where(F.col("rank") <= k).select("type", "query", "rank", "terminology", "code", "first.preferred_name", "first.alias", F.round("first.score", 6).alias("score"))


def preferred_names(terms: DataFrame) -> DataFrame:
    """Name for display of every code: the shortest fit name, the first of equally short ones, else the first; all aliases."""
    fit = F.when(is_display_name(F.col("alias")), F.struct(F.length("alias"), "id"))
    grouped = terms.groupBy("semantic_type", "code").agg(F.min_by("alias", fit).alias("fit"), F.min_by("alias", "id").alias("first"), F.array_sort(F.collect_set("alias")).alias("aliases"))
    return grouped.select("semantic_type", "code", F.coalesce("fit", "first").alias("name"), "aliases")


def term_dimension_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference list once per identity."""
    return term_dimension(table(spark, sf_dir, "terms")).select("id", "terminology", "semantic_type", "code", "normalized_key", "alias")


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "facts").select("type", "name").distinct()


def term_exact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the distinct names of facts in the terminology of their type."""
    look = small(lookup_in_terminology(table(spark, sf_dir, "terms")))
    names = _names(spark, sf_dir).withColumn("normalized_key", term_key(F.col("name")))
    return names.join(look.withColumnRenamed("semantic_type", "type"), ["type", "normalized_key"]).select("type", "name", "terminology", "code", "alias")


def term_unique_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the distinct names of facts that have one only."""
    look = small(lookup_unambiguous(table(spark, sf_dir, "terms")))
    names = _names(spark, sf_dir).withColumn("normalized_key", term_key(F.col("name")))
    return names.join(look.withColumnRenamed("semantic_type", "type"), ["type", "normalized_key"]).select("type", "name", "terminology", "code", "alias")


def term_coalesced_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fact with the entry that its names stand for."""
    facts = distinct_facts(table(spark, sf_dir, "facts").select("dialogue_id", "turn_id", "fact_pos", "type", "name", "normalized_name"))
    return match_facts(facts, table(spark, sf_dir, "terms")).where("m is not null").select("dialogue_id", "turn_id", "fact_pos", "m.preferred_name", "m.code", "m.terminology")


def term_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts after standardisation, by type: all, and coded ones."""
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    return standardized(facts, table(spark, sf_dir, "terms")).groupBy("type").agg(F.count("*").alias("facts"), F.count("standard_code").alias("coded"), F.count_distinct("normalized_name").alias("names"))


def term_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts by type and whether their codes are verified."""
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    return verified(facts, table(spark, sf_dir, "terms")).groupBy("type", "verified").agg(F.count("*").alias("n"))


def term_fuzzy_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to five near entries for each distinct name of uncoded facts."""
    names = table(spark, sf_dir, "facts").where("standard_code is null").select("type", F.col("name").alias("query"))
    return fuzzy_candidates(names, table(spark, sf_dir, "terms"))


def term_preferred_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for display of all codes."""
    return preferred_names(table(spark, sf_dir, "terms")).select("semantic_type", "code", "name", F.size("aliases").cast("long").alias("aliases"))


def term_alias_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference list read as one row per code with a written list of aliases, and imported."""
    terms = table(spark, sf_dir, "terms")
    written = terms.groupBy("terminology", "semantic_type", "code").agg(F.min("id").alias("pos"), F.min("preferred_name").alias("preferred_name"), F.array_join(F.array_sort(F.collect_set("alias")), "；").alias("synonyms"), F.lit("list").alias("source"))
    rows = import_terms(written.withColumn("aliases", split_list(F.col("synonyms"))))
    return rows.select("terminology", "semantic_type", "code", "normalized_key")


QUERIES = {
    "term_dimension_dedup": term_dimension_dedup, "term_exact_lookup_top1": term_exact_lookup, "term_unique_lookup": term_unique_lookup, "term_coalesced_match": term_coalesced_match,
    "term_standardized": term_standardized, "term_verify_semi": term_verify, "term_fuzzy_topk": term_fuzzy_topk, "term_metadata": term_metadata, "loinc_preferred_name_fold": term_preferred_names, "term_alias_import": term_alias_import,
}


def _key(column: str) -> str:
    return rf"""regexp_replace(regexp_replace(lower(coalesce({column}, '')), '[\s\p{{Z}}\x{{FEFF}}]+', '', 'g'), '[，,。；;：:、（）()【】\[\]{{}}<>《》"''“”‘’]', '', 'g')"""


_DIMENSION = f"""dimension AS (
  SELECT DISTINCT ON (terminology, semantic_type, code, normalized_key) id, terminology, semantic_type, code, preferred_name, alias, normalized_key
  FROM (SELECT id, terminology, semantic_type, code, preferred_name, alias, {_key("alias")} AS normalized_key FROM terms) WHERE normalized_key <> ''
  ORDER BY terminology, semantic_type, code, normalized_key, id
), in_terminology AS (
  SELECT DISTINCT ON (semantic_type, terminology, normalized_key) * FROM dimension ORDER BY semantic_type, terminology, normalized_key, preferred_name <> alias, id
), unambiguous AS (
  SELECT DISTINCT ON (semantic_type, normalized_key) * FROM dimension
  WHERE (semantic_type, normalized_key) IN (SELECT (semantic_type, normalized_key) FROM dimension GROUP BY semantic_type, normalized_key HAVING count(DISTINCT (terminology, code)) = 1)
  ORDER BY semantic_type, normalized_key, preferred_name <> alias, id
)"""
_BUILTIN = "builtin(normalized_key, preferred_name, code, terminology, alias) AS (VALUES " + ", ".join(
    f"('{alias}', '{name}', {code and repr(code) or 'NULL'}, {term and repr(term) or 'NULL'}, '{alias}')" for name, code, term, aliases in BUILTIN_EXAMINATIONS for alias in aliases
) + ")"
MATCH_SQL = f"""WITH {_DIMENSION}, {_BUILTIN}, facts_once AS (SELECT DISTINCT ON (dialogue_id, turn_id, fact_pos) * FROM facts), keyed AS (
  SELECT *, {_key("name")} AS k1, {_key("normalized_name")} AS k2, CASE type WHEN 'disease' THEN 'ICD-10-CN' WHEN 'examination' THEN 'LOINC' END AS expected FROM facts_once
), probed AS (
  SELECT f.*, coalesce(
      CASE WHEN b1.normalized_key IS NOT NULL THEN {{'n': b1.preferred_name, 'c': b1.code, 't': b1.terminology}} END, CASE WHEN t1.code IS NOT NULL THEN {{'n': t1.preferred_name, 'c': t1.code, 't': t1.terminology}} END, CASE WHEN a1.code IS NOT NULL THEN {{'n': a1.preferred_name, 'c': a1.code, 't': a1.terminology}} END,
      CASE WHEN b2.normalized_key IS NOT NULL THEN {{'n': b2.preferred_name, 'c': b2.code, 't': b2.terminology}} END, CASE WHEN t2.code IS NOT NULL THEN {{'n': t2.preferred_name, 'c': t2.code, 't': t2.terminology}} END, CASE WHEN a2.code IS NOT NULL THEN {{'n': a2.preferred_name, 'c': a2.code, 't': a2.terminology}} END) AS m
  FROM (SELECT * REPLACE (CASE WHEN k1 = '' OR type = 'examination' AND k1 IN ({", ".join(f"'{w}'" for w in GENERIC_EXAMINATIONS)}) THEN NULL ELSE k1 END AS k1, CASE WHEN k2 = '' OR type = 'examination' AND k2 IN ({", ".join(f"'{w}'" for w in GENERIC_EXAMINATIONS)}) THEN NULL ELSE k2 END AS k2) FROM keyed) f
  LEFT JOIN builtin b1 ON f.type = 'examination' AND b1.normalized_key = f.k1 LEFT JOIN builtin b2 ON f.type = 'examination' AND b2.normalized_key = f.k2
  LEFT JOIN in_terminology t1 ON t1.semantic_type = f.type AND t1.terminology = f.expected AND t1.normalized_key = f.k1 LEFT JOIN in_terminology t2 ON t2.semantic_type = f.type AND t2.terminology = f.expected AND t2.normalized_key = f.k2
  LEFT JOIN unambiguous a1 ON f.expected IS NULL AND a1.semantic_type = f.type AND a1.normalized_key = f.k1 LEFT JOIN unambiguous a2 ON f.expected IS NULL AND a2.semantic_type = f.type AND a2.normalized_key = f.k2)
"""
ORACLE_SQL = {
    "term_metadata": f"SELECT terminology, semantic_type, count(*) AS rows, count(DISTINCT code) AS codes, count(DISTINCT {_key('alias')}) AS keys, count(*) FILTER (source IS NULL) AS without_source FROM terms GROUP BY ALL",
    "term_dimension_dedup": f"WITH {_DIMENSION} SELECT id, terminology, semantic_type, code, normalized_key, alias FROM dimension",
    "term_exact_lookup_top1": f"WITH {_DIMENSION} SELECT n.type, n.name, t.terminology, t.code, t.alias FROM (SELECT DISTINCT type, name, {_key('name')} AS k FROM facts) n JOIN in_terminology t ON t.semantic_type = n.type AND t.normalized_key = n.k",
    "term_unique_lookup": f"WITH {_DIMENSION} SELECT n.type, n.name, t.terminology, t.code, t.alias FROM (SELECT DISTINCT type, name, {_key('name')} AS k FROM facts) n JOIN unambiguous t ON t.semantic_type = n.type AND t.normalized_key = n.k",
    "term_coalesced_match": MATCH_SQL + "SELECT dialogue_id, turn_id, fact_pos, m.n AS preferred_name, m.c AS code, m.t AS terminology FROM probed WHERE m IS NOT NULL",
    "term_standardized": MATCH_SQL + "SELECT type, count(*) AS facts, count(CASE WHEN m IS NOT NULL THEN m.c ELSE standard_code END) AS coded, count(DISTINCT coalesce(m.n, nullif(normalized_name, ''), name)) AS names FROM probed GROUP BY type",
    "term_verify_semi": """WITH facts_once AS (SELECT DISTINCT ON (dialogue_id, turn_id, fact_pos) * FROM facts), checked AS (
  SELECT type, (standard_code IS NULL AND terminology IS NULL) OR (coalesce(terminology = CASE type WHEN 'disease' THEN 'ICD-10-CN' WHEN 'examination' THEN 'LOINC' END, TRUE)
    AND EXISTS (SELECT 1 FROM terms t WHERE t.semantic_type = f.type AND t.terminology = f.terminology AND t.code = f.standard_code)) AS verified FROM facts_once f)
SELECT type, verified, count(*) AS n FROM checked GROUP BY ALL""",
    "loinc_preferred_name_fold": """SELECT semantic_type, code, coalesce(arg_min(alias, (length(alias), id)) FILTER (length(alias) BETWEEN 1 AND 30 AND NOT regexp_matches(alias, '[.^{}]') AND regexp_matches(alias, '[一-鿿]')), arg_min(alias, id)) AS name,
  count(DISTINCT alias) AS aliases FROM terms GROUP BY ALL""",
    "term_alias_import": f"""WITH written AS (
  SELECT terminology, semantic_type, code, list_append(list(DISTINCT alias), min(preferred_name)) AS names FROM terms WHERE trim(code, ' ') <> '' GROUP BY terminology, semantic_type, code
), parts AS (SELECT terminology, semantic_type, code, unnest(flatten(list_transform(names, lambda n: regexp_split_to_array(coalesce(n, ''), '[|；;、]')))) AS a FROM written)
SELECT DISTINCT terminology, semantic_type, code, {_key("a")} AS normalized_key FROM parts WHERE {_key("a")} <> ''""",
}

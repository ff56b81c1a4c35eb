"""Broken pairs of a message and the question that answers it, each with all of its defects.

Ordered rules, as JVM expressions: emptiness, refusal phrases of several languages, copied messages, script mismatch,
unclosed delimiters and abrupt endings. An ending is abrupt if it is an ellipsis, or if it has no closing mark and is
no ending that closed questions of the same table have; that is counted over all rows. Only pairs with a text in Latin
script, which does not tell the language, go to the classifier of lines.

Defined results: a null or blank question or target is empty; with null or blank messages nothing is a copy or a
mismatch; repeated rows give one row, and different pairs of one id one with the defects of all; very long texts are
compared whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.functions.unicode import CYRILLIC, CYRILLIC_AS, GREEK, GREEK_AS, unified
from dialoom.llm.arrow import bounded
from dialoom.llm.language import LANGUAGES, NaiveBayes, fit
from dialoom.session import cut, table

DEFECTS = ["empty", "refusal", "copy", "language", "truncated"]

#: Words that stand for nothing said.
NOTHING = ["null", "none", "nil", "na", "nan", "undefined", "空", "无", "暂无", "没有", "未填", "略", "なし", "없음"]

# Phrases by which a question is declined, by language.
REFUSALS = [
    r"帮不上忙|无能为力|恕难|恕不|(无法|不能|不便|没办法|没有办法|不宜|难以|拒绝)(就|为您|向您|对|再|继续|提供|回答|回应|处理|协助|完成|满足|讨论|给出|询问)",
    r"(不予|拒绝|谢绝|不便)(回应|回答|提供|置评|讨论)|不(具备|在)[^，。？?]{0,6}(资格|能力|范围)|超出(了)?[^，。？?]{0,6}(能力|范围|权限)|到此为止",
    r"(这项|此项|该|这个|您的)请求[^，。？?]{0,6}(不能|无法)|(我)?(只)?是(一个|一款)?(语言模型|人工智能|ai)",
    r"\b(i (cannot|can not|can t|am unable to|am not able to|won t|must decline)|unable to (help|assist|answer)|as an ai|language model|i m sorry but|can t (help|assist) with)\b",
    r"\b(no puedo (ayudar|responder|continuar|ofrecer)|lo siento pero|modelo de lenguaje|não posso (ajudar|responder|continuar)|sinto muito mas|je ne peux pas|je suis désolée? mais|modèle de langage|ich kann (dabei |ihnen )?(leider )?nicht|tut mir leid|sprachmodell|tôi không thể|rất tiếc|mô hình ngôn ngữ)\b",
    r"(お答えできません|対応できません|お手伝いできません|言語モデル|申し訳ありません|답변할 수 없|도와드릴 수 없|언어 모델|죄송하지만|не могу (помочь|ответить|продолжить)|к сожалению я не|языковая модель)",
]
#: A final particle closes a question; a declined question that asks all the same is none.
PARTICLES = ["吗", "呢", "么"]
#: Before the last particle these make a word that asks for something to follow.
UNFINISHED = ["什", "怎", "多", "这", "那", "要"]
CLOSING = ["?", "？", "。", ".", "!", "！", "｡", "」", "”", '"', "）", ")"]
TRAILING = ["…", ",", "，", "、", ";", "；", ":", "：", "-", "—"]

#: Every phrase of the first three patterns has one of these, every other one a letter of another script.
_DECLINES = "[帮能恕法便宜难拒予绝资范超止求型智]|ai"
_FOREIGN = "[a-z\u00c0-\u024f\u1e00-\u1effぁ-ヺ가-힣\u0400-\u04ff]"
#: A medicine and its dose are of no language.
_DOSE = r"[\p{L}-]+ ?\d+ ?(mg|ml|mcg|ug|g)\b"
#: Log-odds by which a text must speak for its own language, against each other one.
ODDS = 4.0
#: Least n-grams of a text by which the classifier tells its language (about seven letters).
NGRAMS = 20

def plain(text: Column) -> Column:
    """Lower case, without invisible characters, look-alike letters as Latin ones, other white space as blanks."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\p{Cf}︀-️]", "")
    flat = F.translate(flat, *unified())
    return F.trim(F.lower(F.regexp_replace(flat, r"[\s\u0085\p{Z}]+", " ")))


def bare(text: Column) -> Column:
    """Letters and digits of a plain text, look-alikes of Latin letters as these."""
    return F.translate(F.regexp_replace(text, r"(?U)[^\p{L}\p{N}]+", ""), (CYRILLIC + GREEK).lower(), (CYRILLIC_AS + GREEK_AS).lower())


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _scripts(text: Column) -> Column:
    """How much of a plain text is in each script."""
    patterns = {"han": r"[\u2e80-\u2fdf\u3005\u3007\u3021-\u3029\u3400-\u9fff\uf900-\ufaff\x{20000}-\x{3ffff}]", "kana": r"[ぁ-ヺ]", "hangul": r"[가-힣]", "cyrillic": r"[\u0400-\u04ff]", "words": r"[\u0400-\u04ff]{2,}", "latin": r"[a-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u1e00-\u1eff]+"}
    return F.struct(*(_count(text, p).alias(n) for n, p in patterns.items()))


def _script(c: Column) -> Column:
    """zh, ja, ko, ru, or latin; null without a clear script.

    Latin words inside another script (names of medicines, abbreviations) weigh as one letter each, Cyrillic ones as two.
    """
    east = c["han"] + c["kana"]
    best = F.greatest(east, c["hangul"], 2 * c["words"], c["latin"])
    return (
        F.when(best == 0, F.lit(None))
        .when((c["kana"] >= 2) & (c["kana"] * 4 >= c["han"]) & (east >= c["hangul"]), "ja")
        .when((c["hangul"] == best) & (c["hangul"] > 1), "ko")
        .when((2 * c["words"] == best) & (c["cyrillic"] >= 3), "ru")
        .when(east == best, "zh")
        .when(c["latin"] >= 2, "latin")
    )


def with_script(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the script of a plain text under ``out``; a text of one script alone, as most are, is not counted out."""
    counted = df.withColumn("__f", F.col(text).rlike(_FOREIGN))
    counted = counted.withColumn("__c", F.when(F.col("__f"), _scripts(F.col(text))))
    alone = F.when(F.col(text).rlike("[\u2e80-\u2fdf\u3005\u3007\u3021-\u3029\u3400-\u9fff\uf900-\ufaff\\x{20000}-\\x{3ffff}]"), "zh")
    return counted.withColumn(out, F.when(F.col("__f"), _script(F.col("__c"))).otherwise(alone)).drop("__f", "__c")


def _mismatches(batches: Iterator[pa.RecordBatch], model: NaiveBayes) -> Iterator[pa.RecordBatch]:
    for batch in bounded(batches, ["own", "joined"]):
        languages = []
        for text, script in (("own", "mine"), ("joined", "theirs")):
            scores, size = model.line_scores([t.replace("\n", " ") for t in batch.column(text).to_pylist()])
            top = np.sort(scores, axis=1)
            sure = (top[:, -1] - top[:, -2] > ODDS) & (size >= NGRAMS)
            told = np.where(sure, np.array(LANGUAGES, dtype=object)[scores.argmax(axis=1)], None)
            known = np.array(batch.column(script).to_pylist(), dtype=object)
            languages.append(np.where(known == "latin", told, known))
        mine, theirs = languages
        differ = (mine != theirs) & np.not_equal(mine, None) & np.not_equal(theirs, None)
        kept = [c for c in batch.schema.names if c not in ("own", "joined", "mine", "theirs")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(differ.astype(bool))], [*kept, "differ"])


def language_mismatches(texts: DataFrame, model: NaiveBayes) -> DataFrame:
    """``texts`` (``own, joined``, their scripts ``mine, theirs`` and others) with, instead of these, whether they ``differ`` in language.

    A script other than the Latin one tells the language; a text that the classifier isn't sure of differs from none.
    """
    sent = texts.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(f for f in texts.schema.fields if f.name not in ("own", "joined", "mine", "theirs")), T.StructField("differ", T.BooleanType())])
    return texts.mapInArrow(lambda batches: _mismatches(batches, sent.value), schema)


def _close(a: Column, b: Column, least: float = 0.8) -> Column:
    """Whether two bare texts are the same but for a few letters; lengths first, as they settle most pairs."""
    longer, shorter = F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b))
    most = F.floor(longer * F.lit(1 - least)).cast("int")
    return (shorter > 0) & ((longer - shorter) <= most) & ((a == b) | ((longer > 3) & (F.levenshtein(a, b) <= most)))


def _last(text: Column, n: int = 1) -> Column:
    return F.substring(text, -n, n)


def pair_rules(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``empty, refusal, copy, mine, theirs, own, joined, unclosed, closed, particle, ending``: what one row tells.

    ``pairs``: ``block`` (messages, ARRAY<STRING>), ``question``, ``target`` (name of what is asked about) and others.
    ``mine`` and ``theirs`` are the scripts of the question without its quotations (``own``) and of the messages (``joined``).
    """
    rows = pairs.withColumns({"said": plain(F.col("question")), "aim": plain(F.col("target")), "messages": F.transform(F.coalesce("block", F.array().cast("array<string>")), plain)})
    rows = rows.withColumns({"joined": F.array_join("messages", " "), "letters": bare(F.col("said")), "own": F.regexp_replace("said", "[“\"「][^”\"」]*[”\"」]", ""), "foreign": F.col("said").rlike(_FOREIGN), "last": _last(F.col("said"))})
    said, target, last = F.col("said"), F.col("aim"), F.col("last")
    empty = (F.col("letters") == "") | F.col("letters").isin(NOTHING) | (bare(target) == "")
    particle = last.isin(PARTICLES) & ~((last == "么") & _last(said, 2).isin([c + "么" for c in UNFINISHED]))
    asks = last.isin("?", "？") | particle
    spaced = F.regexp_replace("said", "['’]", " ")
    refusal = (said.rlike(_DECLINES) & spaced.rlike("|".join(REFUSALS[:3]))) | (F.col("foreign") & spaced.rlike("(?U)" + "|".join(REFUSALS[3:])))
    # "you said" before the patient's words, and a mark or greeting about them, are no question
    stripped = F.regexp_replace(F.col("letters"), r"^(您说|你说|您刚才说|你刚才说|患者说|yousaid|您好|你好)", "")
    sources = F.array_distinct(F.filter(F.concat(F.transform("messages", bare), F.array(bare(F.col("joined")))), lambda m: m != ""))
    rows = rows.withColumns({"stripped": stripped, "sources": sources})
    rows = with_script(with_script(rows, "own", "mine"), "joined", "theirs")
    copy = F.exists("sources", lambda m: _close(F.col("letters"), m) | _close(F.col("stripped"), m))
    pairs_of_marks = ((r"[(（]", r"[)）]"), ("[“「『]", "[”」』]"), (r"\[|【", r"\]|】"))
    opened = said.rlike("[(（“「『\\[【]") & (sum(((_count(said, a) > _count(said, b)).cast("int") for a, b in pairs_of_marks), F.lit(0)) > 0)
    ellipsis = last.isin(TRAILING) | _last(said, 2).isin("..", "。。")
    masked = F.when(target != "", F.replace(said, target, F.lit("\u0001"))).otherwise(said)
    tail = F.regexp_replace(masked, r"[^\p{L}\p{N}\u0001]+$", "")
    # the last letters; of scripts that write words apart, the last word and its distance from the others is enough
    ending = F.when(said.rlike("[\u3005\u3007\u3400-\u9fff\uf900-\ufaffぁ-ヺ]"), F.substring(tail, -4, 4)).otherwise(F.regexp_extract(tail, r"(?U)(\S+)$", 1))
    return rows.withColumns(
        {
            "empty": empty, "refusal": refusal & ~(asks & said.rlike(r"^(对不起|抱歉|不好意思|仅凭|如果|这个问题)")), "copy": F.coalesce(copy, F.lit(False)),
            "unclosed": opened | ellipsis, "closed": last.isin(CLOSING) & ~ellipsis, "particle": particle, "ending": ending,
        }
    ).drop("messages", "letters", "said", "aim", "stripped", "sources", "foreign", "last")


def defective_pairs(pairs: DataFrame, ids: list[str], model: NaiveBayes, share: float = 1e-5) -> DataFrame:
    """``ids, defects``: every pair with a defect, with all of its defects in the order of ``DEFECTS``.

    ``model`` tells the languages of Latin script apart. ``share``: an ending counts as one of whole questions if more
    than this share of the closed ones have it. The rows of the rules are written once; the endings of all closed
    questions are counted with map-side combination and joined to the few questions that are left open, and so are the
    verdicts of the classifier on the few pairs that it is asked about.
    """
    rows = pairs.select(*ids, "block", "question", "target").distinct().withColumn("__pair", F.xxhash64("block", "question", "target"))
    keys = [*ids, "__pair"]
    latin = (F.col("mine") == "latin") | (F.col("theirs") == "latin")
    undosed = lambda c: F.regexp_replace(c, _DOSE, " ")
    seen = pair_rules(rows).withColumns({"asked": F.coalesce(latin, F.lit(False)), "language": F.coalesce(F.col("mine") != F.col("theirs"), F.lit(False))})
    texts = {c: F.when(F.col("asked") & F.col("theirs").isNotNull() & F.col("mine").isNotNull(), undosed(c)) for c in ("own", "joined")}
    rules = cut(seen.withColumns(texts).select(*keys, "empty", "refusal", "copy", "language", "asked", "own", "joined", "mine", "theirs", "unclosed", "closed", "particle", "ending"))
    sound = ~(F.col("empty") | F.col("refusal") | F.col("copy"))
    endings = rules.where(sound & F.col("closed") & ~F.col("unclosed")).groupBy("ending").agg(F.count("*").alias("seen"))
    whole = endings.select(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]
    open_ = ~F.col("closed") & ~F.col("unclosed") & ~F.col("particle") & ~F.col("empty")
    abrupt = rules.where(open_).join(endings.where(F.col("seen") > share * whole), "ending", "left_anti").select(*keys, F.lit("truncated").alias("defect"))
    differ = language_mismatches(rules.where(F.col("asked") & F.col("own").isNotNull()).select(*keys, "own", "joined", "mine", "theirs"), model).where("differ").select(*keys, F.lit("language").alias("defect"))
    told = F.filter(
        F.array(*(F.when(F.col(d), d) for d in ("empty", "refusal", "copy")), F.when(F.col("language") & ~F.col("asked"), "language"), F.when(F.col("unclosed") & ~F.col("empty"), "truncated")), lambda d: d.isNotNull()
    )
    every = rules.select(*keys, F.explode(told).alias("defect")).unionByName(abrupt).unionByName(differ)
    # all defects of one id, however many pairs it has, are five at most
    sets = every.groupBy(*ids).agg(F.collect_set("defect").alias("found"))
    return sets.select(*ids, F.filter(F.array(*map(F.lit, DEFECTS)), lambda d: F.array_contains("found", d)).alias("defects"))


def asked_pairs(rows: DataFrame) -> DataFrame:
    """The ``ask`` rows of interviewer_rows as pairs."""
    asked = rows.where("action = 'ask'")
    return asked.select("dialogue_id", "block_id", F.col("patient_block").alias("block"), F.col("utterance").alias("question"), F.col("next_question_target.name").alias("target"))


def _defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defective_pairs(asked_pairs(table(spark, sf_dir, "interviewer_rows")), ["dialogue_id", "block_id"], fit(table(spark, sf_dir, "documents")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective questions with the first of their defects."""
    return _defects(spark, sf_dir).select("dialogue_id", "block_id", F.col("defects")[0].alias("defect"))


def p3_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective questions with all of their defects."""
    return _defects(spark, sf_dir).withColumn("defects", F.array_join("defects", ","))


QUERIES = {"p3_found": p3_found, "p3_defects": p3_defects}
ORACLE_SQL: dict[str, str] = {}

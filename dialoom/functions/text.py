"""Text expressions as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.functions.lexicon import CHATTER, MEDICAL_SIGNALS, SHORT_ANSWERS

#: White space of any script and characters that show nothing.
BLANKS = " " + "".join(
    map(chr, (*range(0x09, 0x0E), 0x85, 0xA0, 0xAD, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, *range(0x2060, 0x2065), 0x3000, *range(0xFE00, 0xFE10), 0xFEFF))
)


def strip(text: Column | str) -> Column:
    """``text`` without white space and invisible characters at its ends; null stays null."""
    return F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(BLANKS))


def is_visible(text: Column | str) -> Column:
    """Whether ``text`` has visible text; false for null."""
    own = F.col(text) if isinstance(text, str) else text
    return F.coalesce(own.rlike(r"(?U)[^\s\p{Z}\p{C}\u034f\u115f\u1160\u3164\ufe00-\ufe0f\uffa0]"), F.lit(False))


# The normalisers below differ on purpose and are not interchangeable.

_SPACE = r"(?U)[\s﻿]+"


def term_key(text: Column) -> Column:
    """Lookup key of a terminology: trimmed, lower case, without white space and most punctuation."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _SPACE, ""), "[，,。；;：:、（）()【】\\[\\]{}<>《》\"'“”‘’]", "")


def metric_text(text: Column) -> Column:
    """For comparisons of metrics: without white space, lower case."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, ""))


def question_text(text: Column) -> Column:
    """For questions and names: without white space and sentence punctuation, lower case."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\s，。！？、；：,.!?;:]", ""))


def block_text(text: Column) -> Column:
    """For blocks: as question_text, without tildes."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\s，。！？、；：,.!?;:~～]+", ""))


def chatter_text(text: Column) -> Column:
    """For chatter: without white space and some punctuation, case kept."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[。！？!?，,、~～.\s]", "")


def clause_text(text: Column) -> Column:
    """For clauses of evidence: without white space, punctuation and brackets."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\s，。！？!?、；;：:（）()]+", "")


def without_format(text: Column) -> Column:
    """Without characters of the Unicode category Cf."""
    return F.regexp_replace(text, r"\p{Cf}", "")


def is_short_answer(text: Column) -> Column:
    """Whether a message only makes sense with its question."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[。！？!?，,\s]", "")
    return bare.isin(SHORT_ANSWERS) | F.length(bare).between(1, 4)


def is_chatter(text: Column) -> Column:
    """Whether a message is courtesy and nothing else."""
    bare = chatter_text(text)
    rest = bare
    for phrase in sorted(CHATTER, key=lambda p: (-len(p), p)):
        rest = F.replace(rest, F.lit(phrase), F.lit(""))
    return (bare != "") & (bare.isin(CHATTER) | (~bare.rlike("|".join(MEDICAL_SIGNALS)) & (rest == "")))


def has_hedge(text: Column) -> Column:
    """Whether a text hedges anywhere."""
    return F.coalesce(text.rlike("好像|可能|也许|似乎|应该|大概|估计|不确定"), F.lit(False))


def is_hedged_evidence(text: Column) -> Column:
    """Whether an evidence is a hedge and no statement."""
    clause = clause_text(text)
    return clause.rlike("^(?:好像|可能|也许|似乎|应该)(?:没有|没|有|有点|有些|是|不是).{0,12}$") | clause.rlike("^(?:好像|可能|也许|似乎|应该).{0,24}(?:不适|异常|问题)$")


def is_display_name(text: Column) -> Column:
    """Whether a name is fit for display: 1 to 30 characters, no mark of a composite name, some Chinese."""
    return F.coalesce(F.length(text).between(1, 30) & ~text.rlike(r"[.^{}]") & text.rlike(r"[一-鿿]"), F.lit(False))


def chinese_runs(text: Column) -> Column:
    """Runs of Chinese characters of a question text."""
    return F.regexp_extract_all(question_text(text), F.lit(r"[一-鿿]+"), F.lit(0))


def lexically_related(a: Column, b: Column) -> Column:
    """Whether one text holds the other, or both have a pair of neighbouring Chinese characters."""
    x, y = question_text(a), question_text(b)

    def pairs(runs: Column) -> Column:
        return F.flatten(F.transform(F.filter(runs, lambda r: F.length(r) > 1), lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substr(r, i, F.lit(2)))))

    return (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x) | F.arrays_overlap(pairs(chinese_runs(a)), pairs(chinese_runs(b))))


def split_list(text: Column) -> Column:
    """A list written with separators as an array of its trimmed, non-blank parts."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "[|；;、]"), lambda p: F.trim(p)), lambda p: p != "")


def ratio(n: Column, d: Column) -> Column:
    """``n / d``, 0 for no ``d``."""
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))

"""Unicode tables shared by the text operators, built from rules of the Unicode database and of ICU."""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np

# Letters of other scripts that have the shape of a Latin letter, punctuation that has the shape of another.
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυχϲϳ"
GREEK_AS = "ABEZHIKMNOPTYXaiKvopuxcj"
CYRILLIC = "АВЕЅЗІЈКМНОРСТУХЬаегѕіјкорсухһԁԛԝ"
CYRILLIC_AS = "ABES3IJKMHOPCTYXbaersijKopcyxhdqw"
OTHERS = "ɑɡսոհցօԼՏՕᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ"
OTHERS_AS = "agunhgoLSOABCDEHJKLMPRSTVWZ"
MARKS = "‐‑‒–—―−﹘‘’‛′“”‟″・•‧∙⋅〜∼"
MARKS_AS = "--------''''\"\"\"\"·····~~"

#: Characters that show nothing: format characters, variation selectors, joiners and fillers.
INVISIBLE = r"\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff9-\ufffb\U000e0000-\U000e0fff"
INVISIBLE_RE = re.compile(f"[{INVISIBLE}]")


@functools.cache
def lookalikes() -> dict[str, str]:
    """One code point to the one that it looks like; accented letters follow their base letter."""
    base = dict(zip(GREEK, GREEK_AS, strict=True)) | dict(zip(CYRILLIC, CYRILLIC_AS, strict=True)) | dict(zip(OTHERS, OTHERS_AS, strict=True)) | dict(zip(MARKS, MARKS_AS, strict=True))
    out = dict(base)
    for code in (*range(0x370, 0x530), *range(0x1F00, 0x2000)):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0] in base:
            composed = unicodedata.normalize("NFC", base[parts[0]] + parts[1:])
            if len(composed) == 1:
                out[chr(code)] = composed
    return out


def shape(char: str) -> str:
    """What one character reads as: compatibility form taken apart, look-alikes mapped; "" if it is invisible."""
    if INVISIBLE_RE.match(char):
        return ""
    table = lookalikes()
    return "".join(table.get(c, c) for c in unicodedata.normalize("NFKC", char))


@functools.cache
def _table() -> dict[int, str]:
    return {ord(a): b for a, b in lookalikes().items()}


def fold(text: str | None) -> str:
    """The one form of a text in which all that reads the same is the same; "" for null."""
    if not text:
        return ""
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKC", INVISIBLE_RE.sub("", text)).translate(_table()))


class _Single:
    """Characters whose form is one character whatever stands beside them, as a table filled as they occur."""

    def __init__(self) -> None:
        self.known = np.zeros(0x110000, dtype=bool)
        self.alone = np.zeros(0x110000, dtype=bool)
        self.form = np.arange(0x110000, dtype=np.uint32)

    def learn(self, points: np.ndarray) -> None:
        for point in np.unique(points[~self.known[points]]).tolist():
            char = chr(point)
            to = fold(char)
            # marks and the later letters of a syllable may join with what is before them
            joins = any(unicodedata.category(c)[0] == "M" or "\u1160" <= c <= "\u11ff" for c in char + to)
            self.known[point] = True
            self.alone[point] = len(to) == 1 and not joins
            if self.alone[point]:
                self.form[point] = ord(to)


_SINGLE: list[_Single] = []


def fold_joined(joined: str, between: str) -> str:
    """:func:`fold` of texts joined by a character that none of them has and that no form changes.

    Most texts have only characters that are mapped one by one, which is done for all of them in columns.
    """
    if joined.isascii():
        return joined
    if not _SINGLE:
        _SINGLE.append(_Single())
    table = _SINGLE[0]
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    table.learn(points)
    mapped = table.form[points].tobytes().decode("utf-32-le", "surrogatepass")
    hard = np.flatnonzero(~table.alone[points])
    if not len(hard):
        return mapped
    ends = np.r_[np.flatnonzero(points == ord(between)), len(points)]
    out, done = [], 0
    for k in np.unique(np.searchsorted(ends, hard)).tolist():
        a, b = (int(ends[k - 1]) + 1 if k else 0), int(ends[k])
        out += [mapped[done:a], fold(joined[a:b])]
        done = b
    return "".join([*out, mapped[done:]])


@functools.cache
def unified() -> tuple[str, str]:
    """Characters with another single character as compatibility form (radicals, ideographs, full and half width), and these."""
    ranges = (range(0x2E80, 0x2FD6), range(0xF900, 0xFB00), range(0xFF01, 0xFFEF))
    pairs = [(chr(c), unicodedata.normalize("NFKC", chr(c))) for r in ranges for c in r]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def simplified(spark) -> dict[int, str]:
    """Traditional to simplified Chinese, one character to one, as ICU's transliterator in Spark's own JVM has it."""
    chars = "".join(map(chr, (*range(0x3400, 0x4DC0), *range(0x4E00, 0xA000))))
    jvm = spark.sparkContext._jvm
    to = jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified")
    out = {}
    for at in range(0, len(chars), 2000):
        part = chars[at : at + 2000]
        for a, b in zip(part, to.transliterate("\n".join(part)).split("\n"), strict=True):
            if a != b and len(b) == 1:
                out[ord(a)] = b
    return out

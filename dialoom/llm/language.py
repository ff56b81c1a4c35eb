"""Languages of documents and of their lines: multinomial naive Bayes over hashed character n-grams.

The classifier is fitted on a bounded sample of labelled rows (``SAMPLE`` documents a language), of which some labels
are wrong: it is fitted, labels the sample's lines itself, and is fitted again. The matrix of log-probabilities is
sent to the tasks, where whole batches of lines are scored in numpy.

Defined results: null and blank texts have no line; a line without letters takes its document's language; repeated
rows are labelled alike; texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.unicode import INVISIBLE, fold_joined
from dialoom.llm.arrow import bounded
from dialoom.session import table

LANGUAGES = ["zh", "en", "ja", "ko", "es", "pt", "fr", "de", "ru", "vi"]
#: Labelled documents of each language that the classifier is fitted on, about, and bytes of their texts at most, about.
SAMPLE = 400
SAMPLE_BYTES = 3_000_000
#: Hash buckets of the n-grams of 1 to N characters.
BUCKETS = 1 << 17
N = 3
ROUNDS = 3
#: Log-odds by which a line must speak against its document's main language.
MARGIN = 4.0

# Codes and names by which labels may name a language (in lower case; regional parts are cut off).
NAMES = {
    "zh": "zh zho chi cmn chinese mandarin 中文 汉语 漢語 简体中文 繁體中文 繁体中文 普通话 华语 yue hans hant",
    "en": "en eng english 英语 英文",
    "ja": "ja jpn jp japanese 日本語 日语 日文",
    "ko": "ko kor kr korean 한국어 韩语 韩文",
    "es": "es spa spanish español espanol castellano 西班牙语",
    "pt": "pt por portuguese português portugues 葡萄牙语",
    "fr": "fr fra fre french français francais 法语",
    "de": "de deu ger german deutsch 德语",
    "ru": "ru rus russian русский 俄语",
    "vi": "vi vie vietnamese tiếng 越南语 việt",
}

_DIGITS = re.compile(r"\d+")
_SPACES = re.compile(r"(?:[^\w\x00]|_)+")
_EDGES = re.compile(r" ?\x00 ?")
_INVISIBLE = re.compile(rf"[\s{INVISIBLE}]+")


def label_language(label: Column) -> Column:
    """The language that a label names, by code, regional code or name; null if it names none."""
    known = F.create_map(*(F.lit(x) for code, names in NAMES.items() for name in names.split() for x in (name, code)))
    return F.try_element_at(known, F.regexp_extract(F.lower(F.trim(label)), r"^([^-_\s(]+)", 1))


def features(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all lines one after the other, and where each line's begin (and the end).

    All lines are brought to one form in one go, each in blanks, with a character between them that no n-gram holds.
    """
    joined = "\x00".join(x.replace("\x00", " ") for x in lines)
    flat = _SPACES.sub(" ", _DIGITS.sub("", fold_joined(joined, "\x00").lower()))
    flat = " " + _EDGES.sub("\x00", flat).strip(" ").replace("\x00", " \x00 ") + " \x00" if lines else ""
    text = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    inside = text != 0
    buckets = np.zeros((len(text), N), dtype=np.int32)
    there = np.zeros((len(text), N), dtype=bool)
    h, whole = np.zeros(len(text), dtype=np.uint64), inside.copy()
    with np.errstate(over="ignore"):
        for n in range(1, min(N, len(text)) + 1):
            # the n-gram that begins at each place, from the one before and one character more
            whole = whole[: len(text) - n + 1] & inside[n - 1 :]
            h = h[: len(whole)] * np.uint64(0x100000001B3) + text[n - 1 :]
            mixed = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            buckets[: len(whole), n - 1] = (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS
            there[: len(whole), n - 1] = whole & (text[: len(whole)] != 32) if n == 1 else whole
    upto = np.r_[0, np.cumsum(there.sum(axis=1))]
    ends = np.flatnonzero(~inside)
    return buckets[there], np.r_[0, upto[ends]]


@dataclass
class NaiveBayes:
    """Log-probabilities of the buckets by language."""

    log_p: np.ndarray

    @classmethod
    def fit(cls, bucket: np.ndarray, starts: np.ndarray, label: np.ndarray) -> NaiveBayes:
        """Fitted on lines with labels (-1: left out); every language weighs the same."""
        owner = np.repeat(label, np.diff(starts))
        counts = np.zeros((len(LANGUAGES), BUCKETS))
        for k in range(len(LANGUAGES)):
            counts[k] = np.bincount(bucket[owner == k], minlength=BUCKETS)
        total = counts.sum(axis=1, keepdims=True)
        counts = counts / np.maximum(total, 1) * 1e5 + 0.02
        log_p = np.log(counts / counts.sum(axis=1, keepdims=True))
        log_p[total[:, 0] == 0] = -100.0  # a language without a sample is never the likeliest
        return cls(log_p.astype(np.float32))

    def scores(self, bucket: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log-likelihood of each line in each language."""
        out = np.zeros((len(starts) - 1, len(LANGUAGES)))
        if len(bucket):
            some = np.flatnonzero(np.diff(starts))
            for k in range(len(LANGUAGES)):
                out[some, k] = np.add.reduceat(self.log_p[k][bucket].astype(np.float64), starts[some])
        return out

    def line_scores(self, lines: list[str], step: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
        """Scores of lines and their numbers of n-grams, worked out in parts of about ``step`` characters."""
        cuts = np.cumsum([len(x) for x in lines]) // step
        starts = np.flatnonzero(np.r_[True, cuts[1:] != cuts[:-1]])
        scores, sizes = [], []
        for a, b in zip(starts, [*starts[1:], len(lines)], strict=True):
            bucket, ends = features(lines[a:b])
            scores.append(self.scores(bucket, ends))
            sizes.append(np.diff(ends))
        return np.concatenate(scores), np.concatenate(sizes)


def visible_lines(text: str | None) -> list[str]:
    """Lines with visible text, split at the newline character."""
    return [x for x in (text or "").split("\n") if _INVISIBLE.sub("", x)]


def sample_of(documents: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_BYTES) -> DataFrame:
    """``lang, text`` of about ``sample`` documents of each language that the labels name, fewer if they are long.

    The share of a language is the same everywhere in the table: documents are drawn by a hash of their id.
    """
    labelled = documents.select(label_language(F.col("lang")).alias("lang"), "text", F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)).alias("h")).where("text is not null")
    sizes = labelled.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()
    if not sizes:
        return labelled.where(F.lit(False)).select("lang", "text")
    shares = [(r["lang"], int(1_000_000 * min(1.0, sample / r["n"], chars / max(r["bytes"], 1)))) for r in sizes]
    share = F.try_element_at(F.create_map(*(F.lit(x) for pair in shares for x in pair)), F.col("lang"))
    return labelled.where(F.col("h") < share).select("lang", "text")


def fit(documents: DataFrame, sample: int = SAMPLE) -> NaiveBayes:
    """Fitted on up to about ``sample`` documents of each language that the labels name."""
    lines, labels = [], []
    for row in sample_of(documents, sample).collect():
        own = visible_lines(row["text"])
        lines += own
        labels += [LANGUAGES.index(row["lang"])] * len(own)
    bucket, starts = features(lines)
    given = label = np.array(labels, dtype=np.int64)
    model = NaiveBayes.fit(bucket, starts, label)
    for _ in range(ROUNDS):
        scores = model.scores(bucket, starts)
        top = np.sort(scores, axis=1)[:, -2:]
        size = np.diff(starts)
        # a line teaches the language that it reads as, if it clearly does
        label = np.where((size > 0) & (top[:, 1] - top[:, 0] > MARGIN) if len(lines) else given >= 0, scores.argmax(axis=1), -1)
        model = NaiveBayes.fit(bucket, starts, label)
    return model


_LINES = "doc_id long, label string, seg int, lang string, confidence double"


def _label(batches: Iterator[pa.RecordBatch], model: NaiveBayes) -> Iterator[pa.RecordBatch]:
    for batch in bounded(batches, ["text"]):
        lines, sizes = [], []
        for text in batch.column("text").to_pylist():
            own = visible_lines(text)
            lines += own
            sizes.append(len(own))
        if not lines:
            continue
        scores, size = model.line_scores(lines)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        first = np.searchsorted(doc, np.arange(len(sizes) + 1))
        # main language of a document: most characters by each line's own choice
        weight = np.zeros((len(sizes), len(LANGUAGES)))
        np.add.at(weight, (doc, scores.argmax(axis=1)), size + 1e-9)
        main = weight.argmax(axis=1)
        scores[np.arange(len(lines)), main[doc]] += MARGIN
        best = scores.argmax(axis=1)
        # every character is in N n-grams, which say much the same: their evidence counts once
        odds = np.exp((scores - scores.max(axis=1, keepdims=True)) / N)
        out = pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(doc)),
                batch.column("label").take(pa.array(doc)),
                pa.array((np.arange(len(lines)) - first[doc]).astype(np.int32)),
                pa.array(np.array(LANGUAGES, dtype=object)[best], pa.string()),
                pa.array(1 / odds.sum(axis=1)),
            ],
            ["doc_id", "label", "seg", "lang", "confidence"],
        )
        yield out


def line_languages(documents: DataFrame, model: NaiveBayes) -> DataFrame:
    """``doc_id, label, seg, lang, confidence`` of every line with visible text; ``label`` is what ``lang`` names.

    No shuffle: a document's lines are labelled together, in its own row's task.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), label_language(F.col("lang")).alias("label"), "text").where("text is not null")
    return rows.mapInArrow(lambda batches: _label(batches, sent.value), _LINES)


def document_languages(lines: DataFrame) -> DataFrame:
    """``doc_id, label, lang, confidence, languages``: the language of most lines of each document and how many it has."""
    per = lines.groupBy("doc_id", "lang").agg(F.first("label").alias("label"), F.count("*").alias("n"), F.avg("confidence").alias("confidence"))
    most = F.struct("n", "lang")
    return per.groupBy("doc_id").agg(F.first("label").alias("label"), F.max_by("lang", most).alias("lang"), F.max_by("confidence", most).alias("confidence"), F.count("*").cast("int").alias("languages"))


def _wanted(batches: Iterator[pa.RecordBatch], model: NaiveBayes) -> Iterator[pa.RecordBatch]:
    """Lines of documents whose label is missing, wrong, or not the only language; all lines of a document are in one batch."""
    for batch in _label(batches, model):
        doc, label, lang = (np.array(batch.column(c).to_pylist(), dtype=object) for c in ("doc_id", "label", "lang"))
        seg = batch.column("seg").to_numpy()
        starts = np.flatnonzero(seg == 0)
        keep = np.zeros(len(doc), dtype=bool)
        for a, b in zip(starts, [*starts[1:], len(doc)], strict=True):
            languages = set(lang[a:b])
            keep[a:b] = label[a] is None or languages != {label[a]}
        yield batch.filter(pa.array(keep))


def mislabelled_lines(documents: DataFrame, model: NaiveBayes) -> DataFrame:
    """The lines of :func:`line_languages` of documents whose label names no language, another one, or not all."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), label_language(F.col("lang")).alias("label"), "text").where("text is not null")
    return rows.mapInArrow(lambda batches: _wanted(batches, sent.value), _LINES)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their languages, of documents with a missing or wrong label or with several languages."""
    documents = table(spark, sf_dir, "documents")
    return mislabelled_lines(documents, fit(documents)).select("doc_id", "seg", "lang").distinct()


def p9_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every document."""
    documents = table(spark, sf_dir, "documents")
    return document_languages(line_languages(documents, fit(documents)))


QUERIES = {"p9_found": p9_found, "p9_documents": p9_documents}
ORACLE_SQL: dict[str, str] = {}

"""Reading and writing: JSON lines, delimited tables, shards, ledgers, training sets, reports."""

from __future__ import annotations

import csv
import functools
import io as io_
import itertools
import json
import logging
import re
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dialoom.operators.facts import distinct_facts
from dialoom.operators.splits import split_of
from dialoom.session import checkpoint_dir, table

ENCODINGS = ["utf-8-sig", "utf-8", "gb18030"]


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType, fail_fast: bool = True) -> DataFrame:
    """One JSON object per line by an explicit schema; blank lines are skipped.

    With ``fail_fast`` a bad line ends the job; else it is kept in ``_corrupt_record`` and the fields are null.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
    if not fail_fast:
        kind = StructType([*kind.fields]).add("_corrupt_record", "string")
    return reader.schema(kind).json(path)


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line`` of the lines that are no JSON object."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    ok = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]"))).isNotNull() & F.col("value").rlike(r"^\s*\{")
    return lines.where(~ok).select(F.input_file_name().alias("file"), F.col("value").alias("line"))


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One compact JSON object per line with its nulls, through Spark's commit protocol."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_jsonl_ordered(df: DataFrame, path: str, order: list[str], mode: str = "overwrite") -> None:
    """As :func:`write_jsonl`, the files in the order of the rows; range partitioning, no single task."""
    write_jsonl(df.repartitionByRange(*order).sortWithinPartitions(*order), path, mode)


def _head(spark: SparkSession, path: str, size: int = 1 << 16) -> bytes:
    """The first bytes of a file on any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def sniff(spark: SparkSession, path: str) -> tuple[str, str]:
    """Encoding and delimiter of a delimited file, from its head."""
    head = _head(spark, path)
    for encoding in ENCODINGS:
        try:
            text = head.decode(encoding, errors="strict" if len(head) < 1 << 16 else "ignore")
            break
        except UnicodeDecodeError:
            continue
    else:
        raise ValueError(f"{path}: encoding unknown")
    if path.endswith((".tsv", ".txt")):
        return encoding, "\t"
    try:
        return encoding, csv.Sniffer().sniff(text[:4096], ",;\t|").delimiter
    except csv.Error:
        return encoding, ","


def _from_rows(spark: SparkSession, path: str, header: list[str], rows: Callable[[bytes], Iterator[list]]) -> DataFrame:
    """A file that is read as a whole, in one task, as a table of text columns; a reference list is of that size."""
    names = [str(c or "").strip() for c in header]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                body = [([None if v is None else str(v) for v in row] + [None] * len(names))[: len(names)] for row in rows(bytes(content)) if any(v not in (None, "") for v in row)]
                yield pd.DataFrame({f"c{n}": [r[n] for r in body] for n in range(len(names))}, dtype=object)

    fields = ", ".join(f"c{n} string" for n in range(len(names)))
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, fields).toDF(*names)


def _delimited_rows(content: bytes, encoding: str, delimiter: str) -> Iterator[list]:
    """The records behind the header; a quoted field may hold delimiters and line breaks."""
    return itertools.islice(csv.reader(io_.StringIO(content.decode(encoding), newline=""), delimiter=delimiter), 1, None)


def _sheet_rows(content: bytes) -> Iterator[list]:
    """The rows of the first sheet of an XLSX workbook, read from its XML; absent cells are None."""
    main = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io_.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in item.iter(f"{main}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{main}si")]
        sheet = min(n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))
        for row in ElementTree.fromstring(book.read(sheet)).iter(f"{main}row"):
            out: list = []
            for cell in row.iter(f"{main}c"):
                letters = re.match("[A-Z]*", cell.get("r", "")).group(0)
                place = functools.reduce(lambda n, c: 26 * n + ord(c) - 64, letters, 0) - 1 if letters else len(out)
                out += [None] * (place + 1 - len(out))
                value = cell.find(f"{main}v")
                if cell.get("t") == "inlineStr":
                    out[place] = "".join(t.text or "" for t in cell.iter(f"{main}t"))
                elif value is not None:
                    out[place] = shared[int(value.text)] if cell.get("t") == "s" else value.text
            yield out


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """A csv, tsv or txt table with a header, all columns as text; another suffix is an error."""
    if not path.endswith((".csv", ".tsv", ".txt")):
        raise ValueError(f"{path}: unknown kind of table")
    encoding, delimiter = sniff(spark, path)
    if encoding == "gb18030":  # no encoding of Spark's reader
        header = next(csv.reader([_head(spark, path).decode(encoding, "ignore").splitlines()[0]], delimiter=delimiter))
        return _from_rows(spark, path, header, lambda content: _delimited_rows(content, encoding, delimiter))
    df = spark.read.option("header", True).option("sep", delimiter).option("multiLine", True).option("escape", '"').csv(path)
    return df.toDF(*(c.lstrip("\ufeff") for c in df.columns))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A delimited table or the first sheet of an XLSX workbook, with a header, all columns as text."""
    if not path.endswith((".xlsx", ".xlsm")):
        return read_delimited(spark, path)
    content = spark.read.format("binaryFile").load(path).select("content").first()[0]
    header = next(_sheet_rows(bytes(content)), [])
    return _from_rows(spark, path, header, lambda data: itertools.islice(_sheet_rows(data), 1, None))


def pick(df: DataFrame, names: list[str]) -> Column:
    """The first non-blank value of the columns that are named so, in the order of ``names``; "" if there is none."""
    known = {c.strip().lower(): c for c in df.columns}
    found = [F.col(f"`{known[n.strip().lower()]}`") for n in names if n.strip().lower() in known]
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in found), F.lit("")) if found else F.lit("")


def read_shards(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of one JSON object per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_shards(df: DataFrame, path: str, key: str) -> None:
    """Rows as JSON lines in one folder per key, named by its hash; the write of all is the commit."""
    df.withColumn("shard", shard_name(F.col(key))).repartition("shard").write.mode("overwrite").partitionBy("shard").option("ignoreNullFields", "false").json(path)


def shard_name(key: Column) -> Column:
    """Name of a key's shard."""
    return F.substring(F.sha2(key, 256), 1, 24)


def write_ledger(df: DataFrame, path: str) -> bool:
    """The ledger in the order of its keys; an empty one removes what is there. Says whether there is one."""
    spark = df.sparkSession
    if df.isEmpty():
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
        return False
    write_jsonl_ordered(df, path, ["dialogue_id"])
    return True


def write_splits(df: DataFrame, path: str) -> None:
    """A training set as one folder per split."""
    df.write.mode("overwrite").partitionBy("split").option("ignoreNullFields", "false").json(path)


def check_training_set(df: DataFrame) -> DataFrame:
    """Rows without one of the four fields, and rows in all."""
    missing = F.count_if(F.col("instruction").isNull() | F.col("input").isNull() | F.col("output").isNull())
    return df.agg(F.count("*").alias("rows"), missing.alias("missing"))


def write_report(report: dict, path: str) -> None:
    """A report of few numbers as a JSON file, written aside and renamed."""
    import os

    aside = f"{path}.{uuid.uuid4().hex}"
    with open(aside, "w", encoding="utf-8") as f:
        json.dump(report, f, ensure_ascii=False, indent=2, sort_keys=True)
    os.replace(aside, path)


def read_report(path: str) -> dict:
    """A report that :func:`write_report` wrote; without one, an empty report."""
    return json.loads(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else {}


def merged_report(paths: dict[str, str]) -> dict:
    """Reports of several stages as one, each under its name; a stage without a report is left out."""
    return {name: report for name, path in paths.items() if (report := read_report(path))}


def backup(spark: SparkSession, paths: list[str], run_dir: str) -> list[str]:
    """Copies of those ``paths`` that exist, in a folder of ``run_dir`` named by the time; what was copied."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    aside = f"{run_dir}/backup-{time.strftime('%Y%m%d-%H%M%S')}-{uuid.uuid4().hex[:6]}"
    done = []
    for path in paths:
        source = jvm.org.apache.hadoop.fs.Path(path)
        files = source.getFileSystem(conf)
        if files.exists(source):
            target = jvm.org.apache.hadoop.fs.Path(f"{aside}/{source.getName()}")
            jvm.org.apache.hadoop.fs.FileUtil.copy(files, source, target.getFileSystem(conf), target, False, conf)
            done.append(target.toString())
    return done


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a stage wrote ``path`` to the end: Spark's commit leaves its mark there."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``file, bytes, sha256`` of every file of a path."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def registry_errors(registry: dict, names: list[str], root: str) -> list[str]:
    """What is wrong with a registry of training sets (name to ``file_name``): names that it lacks, twice, or without a file."""
    errors = [f"{n}: named twice" for n in sorted({n for n in names if names.count(n) > 1})]
    for name in dict.fromkeys(names):
        entry = registry.get(name)
        if not isinstance(entry, dict) or not entry.get("file_name"):
            errors.append(f"{name}: not in the registry")
        elif not Path(root, entry["file_name"]).exists():
            errors.append(f"{name}: no file {entry['file_name']}")
    return errors


def dataset_names(value: str | list[str] | None) -> list[str]:
    """The names of training sets of a setting: a list, or a text with commas."""
    parts = value if isinstance(value, list) else (value or "").split(",")
    return [p.strip() for p in parts if p.strip()]


class Redacting(logging.Filter):
    """Takes keys and tokens out of what is logged."""

    SECRET = re.compile(r"(?i)((?:api[-_]?key|token|secret|authorization)[\"']?\s*[=: ]\s*[\"']?)([^\s\"',]+)")

    def filter(self, record: logging.LogRecord) -> bool:
        record.msg = self.SECRET.sub(r"\1***", record.getMessage())
        record.args = ()
        return True


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts written as JSON lines with their nulls and read again."""
    facts = distinct_facts(table(spark, sf_dir, "facts"))
    path = f"{checkpoint_dir(spark)}/jsonl/{uuid.uuid4().hex}"
    write_jsonl(facts, path)
    return read_jsonl(spark, path, facts.schema).select("dialogue_id", "turn_id", "fact_pos", "name", "normalized_name", "standard_code", "evidence", F.size("attribute").alias("attributes"))


def split_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances written by split and read again, counted."""
    rows = table(spark, sf_dir, "turn_rows").select("dialogue_id", "turn_id", "patient_utterance").distinct().withColumn("split", split_of(F.col("dialogue_id")))
    path = f"{checkpoint_dir(spark)}/splits/{uuid.uuid4().hex}"
    write_splits(rows, path)
    return spark.read.schema("dialogue_id string, turn_id int, patient_utterance string, split string").json(path).groupBy("split").agg(F.count("*").alias("rows"), F.count("patient_utterance").alias("utterances"))


def shard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of the dialogues."""
    return table(spark, sf_dir, "messages").select("dialogue_id").distinct().where("dialogue_id is not null").select("dialogue_id", shard_name(F.col("dialogue_id")).alias("shard"))


QUERIES = {"jsonl_roundtrip": jsonl_roundtrip, "split_export": split_export, "shard_names": shard_names}
_SPLIT = "CASE WHEN CAST('0x' || substr(md5('42:' || dialogue_id), 1, 8) AS BIGINT) / 4294967296.0 < 0.9 THEN 'train' WHEN CAST('0x' || substr(md5('42:' || dialogue_id), 1, 8) AS BIGINT) / 4294967296.0 < 0.95 THEN 'valid' ELSE 'test' END"
ORACLE_SQL = {
    "jsonl_roundtrip": "SELECT DISTINCT ON (dialogue_id, turn_id, fact_pos) dialogue_id, turn_id, fact_pos, name, normalized_name, standard_code, evidence, CAST(len(map_keys(attribute)) AS INTEGER) AS attributes FROM facts",
    "split_export": f"SELECT {_SPLIT} AS split, count(*) AS rows, count(patient_utterance) AS utterances FROM (SELECT DISTINCT dialogue_id, turn_id, patient_utterance FROM turn_rows) GROUP BY 1",
    "shard_names": "SELECT DISTINCT dialogue_id, substr(sha256(dialogue_id), 1, 24) AS shard FROM messages WHERE dialogue_id IS NOT NULL",
}

"""One form for texts that look the same, by DuckDB expressions run inside Arrow partitions.

Defined results: null stays null, an empty text stays empty, a text of invisible characters alone becomes empty;
very long texts, repeated rows and extra columns pass through unchanged but for the added columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.functions.unicode import INVISIBLE_RE, lookalikes, shape
from dialoom.llm.arrow import bounded
from dialoom.session import table


def _name(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Most replacements in one expression; more go into further layers, as DuckDB bounds the depth of an expression.
LAYER = 200


def form_layers(column: str, chars: str) -> list[str]:
    """DuckDB expressions over ``column``, one after the other, that bring it to its one form, given the characters in it.

    The tables come from the Unicode database; the expressions hold the entries of the characters that are there,
    which leaves the result as with the whole tables and spares their cost.
    """
    one_from, one_to, many = [], [], []
    for char in chars:
        to = shape(char)
        if to != char and not INVISIBLE_RE.match(char):
            if len(to) == 1:
                one_from.append(char)
                one_to.append(to)
            else:
                many.append((char, to))
    unseen = "".join(f"\\x{{{ord(c):X}}}" for c in chars if INVISIBLE_RE.match(c))
    layers = [f"regexp_replace({column}, '[{unseen}]', '', 'g')"] if unseen else []
    for at in range(0, len(many), LAYER):
        expr = column
        for char, to in many[at : at + LAYER]:
            expr = f"replace({expr}, {_literal(char)}, {_literal(to)})"
        layers.append(expr)
    if one_from:
        layers.append(f"translate({column}, {_literal(''.join(one_from))}, {_literal(''.join(one_to))})")
    # composing may put an accent on a mapped letter, and a composed letter may itself have a look-alike
    layers.append(f"nfc_normalize({column})")
    later = {c: x for c, x in lookalikes().items() if ord(c) > 0x2FF}
    if any("\u0300" <= c <= "\u036f" for c in chars):
        layers.append(f"translate({column}, {_literal(''.join(later))}, {_literal(''.join(later.values()))})")
    return layers


def form_sql(column: str, chars: str) -> str:
    """The layers of :func:`form_layers` as one expression."""
    expr = column
    for layer in form_layers("{}", chars):
        expr = layer.replace("{}", expr, 1)
    return expr


def _characters(column: pa.Array) -> str:
    text = "".join(x for x in column.to_pylist() if x)
    points = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
    return "".join(chr(p) for p in points if p > 0x7F and not 0xD800 <= p < 0xE000)


def _run(batches: Iterator[pa.RecordBatch], columns: dict[str, str], where: str) -> Iterator[pa.RecordBatch]:
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
    for batch in bounded(batches, list(columns)):
        rows = pa.Table.from_batches([batch])
        con.register("batch", rows)
        sql = f"SELECT *, {', '.join(f'{_name(old)} AS {_name(new)}' for old, new in columns.items())} FROM batch"
        for old, new in columns.items():
            for layer in form_layers(_name(new), _characters(rows.column(old).combine_chunks())):
                sql = f"SELECT * REPLACE ({layer} AS {_name(new)}) FROM ({sql})"
        out = con.sql(f"SELECT * FROM ({sql}) WHERE {where}").to_arrow_table()
        con.unregister("batch")
        names = [*rows.column_names, *columns.values()]
        out = out.select(names).cast(pa.schema([*rows.schema, *(pa.field(n, pa.string()) for n in columns.values())]))
        yield from out.to_batches()


def one_form(df: DataFrame, columns: dict[str, str], where: str = "TRUE") -> DataFrame:
    """``df`` with, for each text column of ``columns``, its one form under the new name; ``where`` is an SQL filter over both.

    No shuffle: every Arrow batch is one DuckDB query.
    """
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.StringType()) for n in columns.values())])
    return df.mapInArrow(lambda batches: _run(batches, columns, where), schema)


def same_reading(texts: DataFrame, pieces: DataFrame, keys: list[str], text: str, piece: str) -> DataFrame:
    """``pieces`` that stand in the ``text`` of the same ``keys`` only when what looks alike counts as the same.

    Null keys, texts and pieces give no row. Pieces that stand there as stored are settled in the JVM; the others
    reach DuckDB. One shuffle of each side by ``keys``; several texts of one key are each compared.
    """
    own = texts.where(F.col(text).isNotNull()).select(*keys, F.col(text).alias("__text"))
    joined = pieces.where(F.col(piece).isNotNull()).withColumn("__piece", F.col(piece)).join(own, keys)
    open_ = joined.where(~F.contains(F.col("__text"), F.col("__piece")))
    forms = one_form(open_, {"__text": "__text_form", "__piece": "__piece_form"}, 'contains("__text_form", "__piece_form")')
    return forms.drop("__text", "__piece", "__text_form", "__piece_form")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts whose evidence is in the utterance only in the one form of both."""
    turns = table(spark, sf_dir, "turn_rows").groupBy("dialogue_id", "turn_id").agg(F.max_by("patient_utterance", "processed_at").alias("patient_utterance"))
    # copies collapse before the shuffle; the groups are those of the join
    facts = table(spark, sf_dir, "facts").where("evidence is not null").groupBy("dialogue_id", "turn_id").agg(F.collect_set(F.struct("fact_pos", "evidence")).alias("facts")).select("dialogue_id", "turn_id", F.inline("facts"))
    found = same_reading(turns, facts, ["dialogue_id", "turn_id"], "patient_utterance", "evidence")
    return found.select("dialogue_id", "turn_id", "fact_pos").distinct()


def p2_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every evidence and utterance that its one form differs from, with that form."""
    facts = table(spark, sf_dir, "facts").select(F.lit("evidence").alias("field"), F.col("evidence").alias("text"))
    turns = table(spark, sf_dir, "turn_rows").select(F.lit("patient_utterance").alias("field"), F.col("patient_utterance").alias("text"))
    return one_form(facts.unionByName(turns), {"text": "form"}, '"text" <> "form"').groupBy("field", "text", "form").agg(F.count("*").alias("n"))


def _whole_table() -> str:
    """The characters of the scripts and symbols of the tables, for the form as one fixed SQL expression."""
    blocks = (range(0xA0, 0x590), range(0x13A0, 0x1400), range(0x1F00, 0x2070), range(0x2E80, 0x2FD6), range(0x3000, 0x3040), range(0x3380, 0x33E0), range(0xF900, 0xFB00), range(0xFE00, 0xFE10), range(0xFEFF, 0xFFF0))
    return "".join(c for c in (chr(p) for r in blocks for p in r) if shape(c) != c)


def sql_form(column: str) -> str:
    """The form of a column as one DuckDB expression over all characters of :func:`_whole_table`."""
    return form_sql(column, _whole_table())


QUERIES = {"p2_found": p2_found, "p2_forms": p2_forms}
ORACLE_SQL = {
    "p2_found": f"""
WITH utterances AS (SELECT dialogue_id, turn_id, arg_max(patient_utterance, processed_at) AS u FROM turn_rows GROUP BY ALL), open_facts AS (
  SELECT DISTINCT dialogue_id, turn_id, fact_pos, u, evidence AS e FROM facts JOIN utterances USING (dialogue_id, turn_id) WHERE NOT contains(u, evidence)
)
SELECT DISTINCT dialogue_id, turn_id, fact_pos FROM open_facts WHERE contains({sql_form("u")}, {sql_form("e")})""",
    "p2_forms": f"""
WITH texts AS (SELECT 'evidence' AS field, evidence AS text FROM facts UNION ALL SELECT 'patient_utterance', patient_utterance FROM turn_rows), forms AS (
  SELECT field, text, {sql_form("text")} AS form FROM texts
)
SELECT field, text, form, count(*) AS n FROM forms WHERE text <> form GROUP BY ALL""",
}

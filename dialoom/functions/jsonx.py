"""Tolerant reading and canonical writing of JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_object_text(text: Column) -> Column:
    """The text of the JSON object in an answer: code fence off, else from the first to the last brace; null if none parses."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```(?i:json)?\s*", ""), r"\s*```$", ""))
    inner = F.regexp_extract(clean, r"(?s)\{.*\}", 0)

    def is_object(t: Column) -> Column:
        # in brackets, as the parser does not mind what follows an object
        return t.rlike(r"(?s)^\s*\{.*\}\s*$") & F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))).isNotNull()

    return F.when(is_object(clean), clean).when((inner != "") & is_object(inner), inner)


def canonical_map(entries: Column) -> Column:
    """A map as compact JSON with sorted keys."""
    pairs = F.array_sort(F.map_entries(entries))

    def quoted(t: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))

    parts = F.transform(pairs, lambda e: F.concat(quoted(e["key"]), F.lit(":"), F.coalesce(quoted(e["value"]), F.lit("null"))))
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def canonical_fact(fields: list[str], attribute: str = "attribute") -> Column:
    """A fact as one text in which the order of fields and of map keys has no meaning; nulls are written."""
    parts = []
    for name in sorted([*fields, attribute]):
        value = canonical_map(F.coalesce(F.col(attribute), F.create_map().cast("map<string,string>"))) if name == attribute else F.coalesce(F.concat(F.lit('"'), F.col(name), F.lit('"')), F.lit("null"))
        parts.append(F.concat(F.lit(f'"{name}":'), value))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

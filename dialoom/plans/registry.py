"""All queries of the core and their SQL."""

from __future__ import annotations

from dialoom.operators import answers, dialogue, facts, history, interview, ledger, metrics, projection, prompts, splits, state, terms
from dialoom.sources import io
from dialoom.streaming import sessions

MODULES = [dialogue, facts, terms, state, projection, interview, answers, prompts, ledger, splits, metrics, history, sessions, io]


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}

"""The queries of the operators for training text, and their SQL where SQL can express them."""

from __future__ import annotations

from dialoom.llm import canonical, conversations, frequency, language, leakage, lookalike, packing, pairs

MODULES = [conversations, lookalike, pairs, frequency, canonical, packing, leakage, language]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}

"""All queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from importlib import import_module

#: Modules that hold QUERIES and SQL.
MODULES = ["licenses", "line_dedup", "mixing", "quality_model", "toxicity", "secrets", "bpe", "near_dedup", "exact_dedup", "quality_rules"]

QUERIES, SQL = {}, {}
for _name in MODULES:
    _module = import_module(f"roadloom.llm.{_name}")
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL

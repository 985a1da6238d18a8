"""All queries over the driver tables, gathered from the plan modules."""

from __future__ import annotations

from importlib import import_module

#: Modules that hold QUERIES and SQL.
MODULES: list[str] = ["series", "networks", "graphs", "spatial", "algorithms", "signals", "sources", "traversal", "rules"]

QUERIES, SQL = {}, {}
for _name in MODULES:
    _module = import_module(f"roadloom.plans.{_name}")
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL

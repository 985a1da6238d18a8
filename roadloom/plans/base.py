"""How plan modules register their queries."""

from __future__ import annotations

from collections.abc import Callable

from .views import sql


def book() -> tuple[dict, dict, Callable]:
    """(QUERIES, SQL, decorator): the decorator takes the DuckDB SQL, if there is any."""
    queries, texts = {}, {}

    def query(text: str | None = None):
        def keep(f):
            queries[f.__name__] = f
            if text:
                texts[f.__name__] = sql(text)
            return f

        return keep

    return queries, texts, query

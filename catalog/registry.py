"""Registry of queries and of the SQL text they are compared with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.views import Views
from catalog.views_sql import VIEWS_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of :class:`Views` under a name, with its SQL if any."""

    def register(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def with_views(sql: str) -> str:
    """The statement preceded by the view definitions it mentions, in order."""
    used: set[str] = set()

    def note(text: str) -> None:
        for name in VIEWS_SQL:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                note(VIEWS_SQL[name])

    note(sql)
    parts = [f"{n} AS ({VIEWS_SQL[n]})" for n in VIEWS_SQL if n in used]
    if not parts:
        return sql
    head = f"WITH RECURSIVE {', '.join(parts)}"
    own = re.match(r"\s*WITH\b", sql)
    return f"{head},{sql[own.end() :]}" if own else f"{head}\n{sql}"

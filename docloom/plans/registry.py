"""Query registry and SQL building blocks."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the body of its twin, which may use the views of ``SQL_VIEWS``."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def expand(sql: str, views: dict[str, str]) -> str:
    """Put the views that ``sql`` uses, directly or through others, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in views:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(views[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    head = ",\n".join(f"{name} AS ({views[name]})" for name in needed)
    body = sql.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start):
            return f"{start}{head},\n{body[len(start):]}"
    return f"WITH {head}\n{body}"


def uuid_sql(*parts: str) -> str:
    """SQL twin of ``derived_id``."""
    def marked(part: str) -> str:
        return f"coalesce(replace(replace(CAST({part} AS VARCHAR), '\\', '\\\\'), '|', '\\|'), '\\0')"

    digest = f"sha256(concat_ws('|', {', '.join(map(marked, parts))}))"
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return "(" + " || '-' || ".join(f"substr({digest}, {a}, {n})" for a, n in cuts) + ")"

"""Registered queries over the given tables, each with its SQL twin."""

from __future__ import annotations


def _load() -> None:
    from docloom.plans import (  # noqa: F401
        content, delivery, governance, ingest, search, streams,
    )


def all_queries():
    from docloom.plans.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from docloom.plans.registry import ORACLES, expand
    from docloom.plans.views import SQL_VIEWS

    _load()
    return {name: expand(sql, SQL_VIEWS) for name, sql in ORACLES.items()}

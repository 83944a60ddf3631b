"""Collects queries and their reference SQL."""

from __future__ import annotations

import re

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def query(name: str, sql: str | None = None, same: str | None = None):
    """Register a query, with the SQL that gives the same rows, or the query whose rows are the ``same``."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        elif same is not None:
            ORACLES[name] = ORACLES[same]
        return fn

    return add


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name in re.findall(r"\bfx_\w+", sql):
        if name in VIEWS and name not in seen:
            _needed(VIEWS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def with_views(sql: str) -> str:
    """Put the views a statement uses in front of it."""
    names = _needed(sql, [])
    if not names:
        return sql
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in names]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body

"""All core queries by name."""

from __future__ import annotations

from graphloom.plans import documents, entities, integrity, pipeline, quality

_MODULES = [documents, entities, integrity, pipeline, quality]


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in _MODULES for k, s in m.SQL.items()}

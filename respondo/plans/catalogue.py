"""All named queries of the engine's core."""

from __future__ import annotations

from . import accounting, analysis, evaluation, graphs, questions, responses

_PARTS = [questions, responses, analysis, accounting, evaluation, graphs]


def queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.catalogue.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.catalogue.sql.items()}

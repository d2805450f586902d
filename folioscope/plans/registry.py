"""Collects the queries and their SQL from the plan modules."""

from __future__ import annotations

from .base import QUERIES, SQL, Query


def _load() -> None:
    from . import capture, evidence, layout, paged, publication, reconciliation, routing, scalars, stream, tables, validation  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)

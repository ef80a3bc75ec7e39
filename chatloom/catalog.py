"""Names every query of the engine, with its DuckDB equivalent where SQL expresses it."""

from __future__ import annotations

from .plans import file_queries as _files  # noqa: F401  adds its queries
from .plans import queries as _plans


def queries() -> dict:
    return dict(_plans.QUERIES)


def oracle_sql() -> dict:
    return dict(_plans.ORACLES)
